"""The registered queries of the operators and the SQL that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers as vocabularies
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.llm import (bpe, collocations, minhash, mixing, multiindex, pii, pitman_yor, quality, spelling, substrings,
                          tokenfiles, toxicity, warc)
from foldwise.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score(pitman_yor.fit(table(spark, sf_dir, "documents")))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return warc.fetch(pages, warc.build_index(warc.write(pages)))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op6_tokenfiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.read(tokenfiles.write(table(spark, sf_dir, "documents"),
                                            vocabularies.path("byte_bpe_50k.json")))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op8_multiindex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiindex.search(table(spark, sf_dir, "embeddings"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"),
                          vocabularies.path("byte_bpe_50k.tiktoken"), vocabularies.PATTERN)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (substrings.deduplicate(table(spark, sf_dir, "documents"))
            .select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_minhash, op2_pitman_yor, op3_pii, op4_warc, op5_toxicity, op6_tokenfiles,
                                    op7_quality, op8_multiindex, op9_bpe, op10_mixing, op11_substrings,
                                    op12_collocations, op13_spelling)}


# The word class and white space of the contract, as DuckDB regular expressions.
_WORD = r"[^\x20\x09-\x0D]+"

OP7_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents
), lines AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '{_WORD}') GROUP BY r
), win AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win) WHERE n > 1
), rep AS (
  SELECT r, count(DISTINCT i + k) AS n_repeat_words
  FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r
), f AS (
  SELECT d.r, doc_id, source, len(w)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         coalesce(n_lines, 0)::BIGINT AS n_lines
  FROM d LEFT JOIN lines USING (r) LEFT JOIN rep USING (r)
), x AS (
  SELECT source, rule, fail FROM (
    SELECT *, n_words < {quality.MIN_WORDS} AS short,
      100 * n_repeat_words > {quality.MAX_REPEAT_PCT} * n_words AS repetitive,
      100 * n_symbols > {quality.MAX_SYMBOL_PCT} * n_words AS symbols,
      100 * n_dup_lines > {quality.MAX_DUP_LINE_PCT} * n_lines AS dup_lines,
      word_chars < {quality.MEAN_WORD_CHARS[0]} * n_words
        OR word_chars > {quality.MEAN_WORD_CHARS[1]} * n_words AS word_length FROM f
    WHERE source IS NOT NULL)
  UNPIVOT (fail FOR rule IN (short, repetitive, symbols, dup_lines, word_length))
), host AS (
  SELECT source, rule, count(*)::DOUBLE AS n, sum(fail::INT)::DOUBLE AS k FROM x GROUP BY ALL
), m AS (
  SELECT rule, count(*) AS h, sum(n) AS n, sum(k) / sum(n) AS p, sum(k * k / n) / sum(n) AS q
  FROM host GROUP BY rule
), v AS (
  SELECT *, q - p * p - p * (1 - p) * h / n AS v FROM m
), prior AS (
  SELECT rule, p, CASE WHEN v > 0 THEN least(greatest(p * (1 - p) / v - 1, 1.0), 1e6)
                       WHEN p > 0 AND p < 1 THEN 1e6 ELSE 1.0 END AS s FROM v
), bad AS (
  SELECT source, bool_or((k + p * s) / (n + s) >= {quality.MAX_RATE}) AS rejected
  FROM host JOIN prior USING (rule) GROUP BY source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
         AND NOT coalesce(rejected, false) AS kept,
       coalesce(rejected, false) AS host_rejected
FROM f LEFT JOIN bad USING (source)
"""

OP10_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size,
         md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '')) AS key FROM documents
), s0 AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS src
  FROM d GROUP BY source
), s1 AS (
  SELECT *, ([5.0, 2.0, 1.0]::DOUBLE[])[src % 3 + 1] AS weight, 3 * source_size AS cap FROM s0
), s2 AS (
  SELECT *, (sum(source_size) OVER ())::BIGINT AS budget,
    ((sum(source_size) OVER ()
      - coalesce(sum(cap) OVER (ORDER BY cap / weight, src
                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
     / sum(weight) OVER (ORDER BY cap / weight, src
                         ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS fill
  FROM s1
), s AS (
  SELECT *, least(cap::DOUBLE, weight * max(CASE WHEN cap / weight >= fill THEN fill END) OVER ())
    AS target FROM s2
), q AS (
  SELECT d.*, src, weight, source_size, target, budget,
         sum(size) OVER (PARTITION BY src ORDER BY key, doc_id, size
                         ROWS UNBOUNDED PRECEDING)::BIGINT AS cum
  FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source
), items AS (
  SELECT src, key, doc_id, size, cum, budget, p,
         (p * source_size + cum)::DOUBLE / weight AS finish
  FROM q, (SELECT unnest([0, 1, 2]) AS p) WHERE size > 0
), fits AS (
  SELECT src, cum, count(*) AS times FROM (
    SELECT *, sum(size) OVER (ORDER BY finish, src, cum, p ROWS UNBOUNDED PRECEDING) AS upto
    FROM items) WHERE upto <= budget GROUP BY src, cum
)
SELECT doc_id, size, source_size, target,
       (CASE WHEN size > 0 THEN size * coalesce(times, 0) ELSE 0 END)::BIGINT AS taken
FROM q LEFT JOIN fits USING (src, cum)
"""


OP11_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w
  FROM documents
), win AS (
  SELECT r, i, array_to_string(w[i:i + {substrings.WINDOW - 1}], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - {substrings.WINDOW - 2})) AS i FROM d)
), rep AS (
  SELECT r, i FROM win WHERE g IN (SELECT g FROM win GROUP BY g HAVING count(*) > 1)
), gone AS (
  SELECT DISTINCT r, i + k AS i FROM rep, (SELECT unnest(range({substrings.WINDOW})) AS k)
), word AS (
  SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d
), kept AS (
  SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t
  FROM word ANTI JOIN gone USING (r, i) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""


OP12_SQL = rf"""
WITH p AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
), total AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY lang
), gram AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS g FROM (
    SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM p, (SELECT unnest([1, 2, 3]) AS m))
), f AS (
  SELECT lang, m, g, count(*)::BIGINT AS a, string_split(g, ' ') AS w FROM gram GROUP BY lang, m, g
), cand AS (
  SELECT * FROM f WHERE m > 1 AND a >= {collocations.MIN_COUNT}
), cuts AS (
  SELECT c.lang, c.m, c.g, c.a, k, x.a AS l, y.a AS r,
         (({collocations.SCALE}::HUGEINT * c.a * c.a) // (x.a::HUGEINT * y.a))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM cand) c
  JOIN f x ON x.lang = c.lang AND x.g = array_to_string(c.w[1:k], ' ')
  JOIN f y ON y.lang = c.lang AND y.g = array_to_string(c.w[k + 1:], ' ')
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
), gone AS (
  SELECT DISTINCT s.lang, s.g FROM (
    SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS g FROM cand WHERE m = 3) t
  JOIN cand s ON s.lang = t.lang AND s.g = t.g WHERE 100 * t.a >= {collocations.COVERED_PCT} * s.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank,
       g AS phrase, a, l, r, n, score
FROM best ANTI JOIN gone USING (lang, g) JOIN total USING (lang)
QUALIFY rank <= {collocations.TOP}
"""


# CRC-32 byte by byte (reflected, polynomial 0xEDB88320); near words by deletion keys: a word and
# one of its deletions, or two words with one deletion at the same place.
OP13_SQL = rf"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(range(8), lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b)
              ORDER BY b) AS t FROM range(256) x(b)
), runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS k
  FROM (SELECT coalesce(doc_id::VARCHAR, '') AS doc_id,
               unnest(regexp_extract_all(coalesce(text, ''), '[{spelling.LETTERS}]+')) AS run FROM documents)
  WHERE length(run) >= {spelling.MIN_LENGTH} GROUP BY ALL
), hashed AS (
  SELECT run, k, xor(list_reduce(
    list_transform(range(len(hx) // 2), lambda i: ('0x' || hx[2 * i + 1:2 * i + 2])::BIGINT),
    lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]), 4294967295), 4294967295) AS h
  FROM (SELECT run, k, hex(encode(doc_id || ':' || run)) AS hx FROM runs), crc
), words AS (
  SELECT word, sum(k)::BIGINT AS n FROM (
    SELECT k, CASE WHEN h % {spelling.DROP_EVERY} = 0
                   THEN run[1:(h % length(run))] || run[(h % length(run)) + 2:] ELSE run END AS word FROM hashed)
  WHERE length(word) >= {spelling.MIN_LENGTH} GROUP BY word HAVING sum(k) >= {spelling.MIN_COUNT}
), del AS (
  SELECT word, n, i, word[1:i - 1] || word[i + 1:] AS cut
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT DISTINCT a.word, b.word AS near FROM del a JOIN del b ON a.i = b.i AND a.cut = b.cut AND a.word <> b.word
  UNION SELECT d.word, w.word FROM del d JOIN words w ON w.word = d.cut
  UNION SELECT w.word, d.word FROM del d JOIN words w ON w.word = d.cut
), best AS (
  SELECT near.word, count(*) AS n_near, arg_min(near, (-w.n, near)) AS form, max(w.n) AS form_n
  FROM near JOIN words w ON w.word = near.near GROUP BY near.word
), judged AS (
  SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN form_n >= {spelling.RATIO} * n THEN form END AS form,
         CASE WHEN form_n >= {spelling.RATIO} * n THEN form_n END AS form_n
  FROM words LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS at FROM judged
  UNION ALL
  SELECT chain.word, judged.form FROM chain JOIN judged ON judged.word = chain.at WHERE judged.form IS NOT NULL
)
SELECT j.word, j.form, c.at AS root, j.n, j.n_near, j.form_n
FROM judged j JOIN chain c ON c.word = j.word JOIN judged e ON e.word = c.at AND e.form IS NULL
"""


def oracle_sql() -> dict[str, str]:
    return {"op7_quality": OP7_SQL, "op10_mixing": OP10_SQL, "op11_substrings": OP11_SQL,
            "op12_collocations": OP12_SQL, "op13_spelling": OP13_SQL}
