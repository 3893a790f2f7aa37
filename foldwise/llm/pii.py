"""Personal data by bootstrapped contextual extraction.

1. Seeds: e-mail addresses, IP addresses, payment cards and phone numbers found
   by strict forms (``base_spans``). Their spans are always reported.
2. Candidates: looser forms of the same kinds that overlap no seed, and, as
   evidence against a context, any other word with a digit.
3. The two words before a seed or candidate are its lexical pattern. Patterns
   and instances (the normalised strings) make a graph whose edges carry
   counts. Spark scores it in turns: a pattern's confidence in a kind is the
   share of what follows it that is of that kind, weighted by the instances'
   scores; an instance's score is the noisy-or of its patterns' confidences.
   Seeds score 1.
4. Patterns with ``MIN_CONFIDENCE`` and ``MIN_FORMS`` different seeds discover
   the candidates that follow them; these spans are added.

The text is scanned once; everything after it works on narrow rows. All scans
are linear in the text, also for long runs of digits or letters.

Defined results: null and empty texts have no spans; rows with a null id are
scanned like others; repeated rows get equal spans; very long texts and words are scanned whole (long
words and instances are told apart by their digest); a place that two kinds explain gets the surer, of
equally sure ones the first of email, ip, card, phone; an empty table gives an empty table; extra columns are ignored by ``find`` and carried by ``masked``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from foldwise.llm.common import arrow_tasks, fresh
from foldwise.session import write_table

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
MIN_CONFIDENCE = 0.8
MIN_FORMS = 3
LONG = 64               # longer words and instances are nodes of the graph by their digest
OTHER = "other"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# A start inside a run of digits can match only if the run's first digit does.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_NUMBER = re.compile(r"\(?[0-9][0-9().\x20-]*[0-9]")
_WORD_DIGIT = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_TRIM = "\"'(),;:.!?<>[]{}"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches: each @ with the longest local part before it and a dotted domain after."""
    out, end = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place in KINDS, end) of the strict forms, sorted."""
    out = [(s, 0, e) for s, e in _emails(text)] if "@" in text else []
    if not _DIGITS.search(text):
        return out
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text)
            if all(len(x.lstrip("0")) < 4 and int(x.lstrip("0") or 0) <= 255
                   for x in m.group().split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text)
                if 9 <= sum(map(len, _DIGITS.findall(m.group()))) <= 15]
    return sorted(out)


def _candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[tuple[str, ...], int, int]]:
    """(kinds, start, end) of looser forms that overlap no strict one. A number of 12 to 15 digits may
    be a card or a phone; its context decides."""
    found: list[tuple[tuple[str, ...], int, int]] = []
    at = text.find("@")
    while at >= 0:  # anything around an @ without white space
        s, e = at, at + 1
        while s and not text[s - 1].isspace() and text[s - 1] != "@":
            s -= 1
        while e < len(text) and not text[e].isspace() and text[e] != "@":
            e += 1
        if s < at and e > at + 1:
            found.append((("email",), s, e))
        at = text.find("@", e)
    for m in _NUMBER.finditer(text):
        x = m.group()
        n = sum(map(len, _DIGITS.findall(x)))
        if x.count(".") == 3 and " " not in x and n >= 4:
            found.append((("ip",), m.start(), m.end()))
        elif 7 <= n <= 19:
            kinds = (("card",) if n >= 12 else ()) + (("phone",) if n <= 15 else ())
            found.append((kinds, m.start(), m.end()))
    found += [((OTHER,), m.start(), m.end()) for m in _WORD_DIGIT.finditer(text)]
    out, busy = [], sorted((s, e) for s, _, e in taken)
    k = 0
    for kinds, s, e in sorted(found, key=lambda x: (x[1], x[0] == (OTHER,))):
        while k < len(busy) and busy[k][1] <= s:
            k += 1
        if (k == len(busy) or busy[k][0] >= e) and not (out and out[-1][2] > s):
            out.append((kinds, s, e))
    return out


def _short(word: str) -> str:
    """A word, or its digest if it is long: whole, but bounded in size."""
    return word if len(word) <= LONG else "#" + hashlib.md5(word.encode()).hexdigest()


def _pattern(word: str) -> str:
    return _short(re.sub("[0-9]", "0", word.strip(_TRIM) or word))


def _contexts(text: str, marks: list[tuple[int, int]]) -> list[str]:
    """For each mark (start, end), in order: the two words before it, lower-cased, digits as 0; a
    text's start is ^. A word that a mark begins inside of counts from the mark before. The text's words
    are found once and each is normalised once, so the work is linear in the text."""
    lower = text.lower()
    if len(lower) != len(text):  # a few characters grow in lower case
        lower = "".join(x if len(x) == 1 else c for c, x in ((c, c.lower()) for c in text))
    words = [(m.start(), m.end()) for m in _WORD.finditer(lower)]
    known: dict[int, str] = {}

    def word(i: int) -> str:
        if i < 0:
            return "^"
        if i not in known:
            known[i] = _pattern(lower[slice(*words[i])])
        return known[i]

    out, k, done = [], 0, 0
    for s, e in marks:
        while k < len(words) and words[k][1] < s:
            k += 1
        own = max(words[k][0], done) if k < len(words) else s
        if own < s:  # the mark begins inside of word k
            out.append(f"{word(k - 1)} {_pattern(lower[own:s])}")
        else:
            out.append(f"{word(k - 2)} {word(k - 1)}")
        done = e
    return out


def spans_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


_ROW = ("doc_id long, tag long, n array<long>, base string, "
        "seen array<struct<seed:boolean,again:boolean,kind:string,s:int,e:int,form:string,ctx:string>>")
# ``again`` marks the further kinds of a place, which count once for its pattern
_SEEN = pa.list_(pa.struct([("seed", pa.bool_()), ("again", pa.bool_()), ("kind", pa.string()), ("s", pa.int32()),
                            ("e", pa.int32()), ("form", pa.string()), ("ctx", pa.string())]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n, base, seen = [], [], []
        for t in b.column(2):
            text = t.as_py() or ""
            spans = base_spans(text)
            n.append([sum(k == i for _, k, _ in spans) for i in range(len(KINDS))])
            base.append(spans_text(spans))
            marks = [(s, e, True, (KINDS[k],)) for s, k, e in spans]
            if "@" in text or _DIGITS.search(text):
                marks += [(s, e, False, kinds) for kinds, s, e in _candidates(text, spans)]
            marks.sort()
            seen.append([{"seed": seed, "again": i > 0, "kind": kind, "s": s, "e": e,
                          "form": _short(text[s:e].strip(_TRIM).lower()), "ctx": ctx}
                         for (s, e, seed, kinds), ctx in zip(marks, _contexts(text, [m[:2] for m in marks]))
                         for i, kind in enumerate(kinds)])
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(n, pa.list_(pa.int64())), pa.array(base, pa.string()),
             pa.array(seen, _SEEN)], names=["doc_id", "tag", "n", "base", "seen"])


def pattern_scores(edges: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Scores of the graph ``ctx, kind, form, w, first, seed`` after some rounds; ``w`` counts an edge's
    places, ``first`` those at which its kind is the place's first.

    Returns ``ctx, kind, confidence, forms`` and ``kind, form, score``.
    """
    total = edges.groupBy("ctx").agg(F.sum("first").alias("total"))
    own = edges.filter("kind <> 'other'")
    inst = own.groupBy("kind", "form").agg(F.max(F.col("seed").cast("double")).alias("score"))
    for _ in range(rounds):
        pats = (own.join(inst, ["kind", "form"]).groupBy("ctx", "kind")
                .agg(F.sum(F.col("w") * F.col("score")).alias("hits"),
                     F.sum(F.col("seed").cast("long")).alias("forms")))
        pats = write_table(pats.join(total, "ctx").select(
            "ctx", "kind", (F.col("hits") / (F.col("total") + 1)).alias("confidence"), "forms"),
            "pii-patterns")
        doubt = F.log(1 - F.least(F.col("confidence"), F.lit(0.999)))
        inst = (own.join(pats, ["ctx", "kind"]).groupBy("kind", "form")
                .agg((1 - F.exp(F.sum(doubt))).alias("score"), F.max("seed").alias("seed"))
                .select("kind", "form", F.when(F.col("seed"), 1.0).otherwise(F.col("score"))
                        .alias("score")))
        inst = write_table(inst, "pii-instances")
    return pats, inst


def _spans(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id, tag, n, base, spans``; ``tag`` is a hash of the text."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("tag"),
                       F.col(text).alias("t"))
    found = write_table(arrow_tasks(rows, _scan, _ROW), "pii-found")
    occ = found.select("doc_id", "tag", F.explode("seen").alias("o")).select("doc_id", "tag", "o.*")
    edges = write_table(occ.groupBy("ctx", "kind", "form")
                        .agg(F.count(F.lit(1)).alias("w"), F.count_if(~F.col("again")).alias("first"),
                             F.max("seed").alias("seed")), "pii-edges")
    pats, inst = pattern_scores(edges)
    sure = pats.filter((F.col("confidence") >= MIN_CONFIDENCE) & (F.col("forms") >= MIN_FORMS))
    names = F.array(*[F.lit(k) for k in KINDS])
    place = F.array_position(names, F.col("kind"))
    added = (occ.filter("not seed and kind <> 'other'").join(sure, ["ctx", "kind"])
             .join(inst.filter(F.col("score") >= MIN_CONFIDENCE), ["kind", "form"])
             # a place gets its surest kind, of equally sure ones the first in order
             .groupBy("doc_id", "tag", "s", "e").agg(F.max(F.struct("confidence", (-place).alias("place"))).alias("m"))
             .withColumn("kind", F.element_at(names, (-F.col("m.place")).cast("int")))
             .groupBy(F.col("doc_id").alias("d"), F.col("tag").alias("g"))
             .agg(F.collect_set(F.concat_ws(":", "kind", "s", "e")).alias("more")))
    on = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tag") == F.col("g"))
    out = found.drop("seen").join(added, on, "left").drop("d", "g")
    parts = F.array_union(F.array_remove(F.split("base", ","), ""),
                          F.coalesce("more", F.array().cast("array<string>")))
    keyed = F.transform(parts, lambda x: F.struct(
        F.split(x, ":")[1].cast("int").alias("s"),
        F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.split(x, ":")[0]).alias("k"),
        x.alias("x")))
    return out.withColumn("spans", F.array_join(F.transform(F.sort_array(keyed),
                                                            lambda y: y["x"]), ","))


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: counts of the strict forms by kind, their digest, all spans."""
    return _spans(docs, doc_id, text).select(
        "doc_id", *[F.col("n")[i].alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


@F.pandas_udf(StringType())
def _mask(text: pd.Series, spans: pd.Series) -> pd.Series:
    out = []
    for t, marks in zip(text, spans):
        if t is None or not marks:
            out.append(t)
            continue
        done, at = [], 0
        for m in marks.split(","):
            kind, s, e = m.split(":")
            s, e = max(int(s), at), int(e)
            if s < e:
                done += [t[at:s], f"[{kind.upper()}]"]
                at = e
        out.append("".join([*done, t[at:]]))
    return pd.Series(out, dtype=object)


def masked(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
           n_chars: str = "n_chars") -> DataFrame:
    """The documents with every span replaced by its kind in brackets; a column of
    lengths, if there is one, follows the new text."""
    spans = (_spans(docs, doc_id, text).filter("spans <> ''")
             .select("doc_id", "tag", "spans").distinct())
    whole, a, b = fresh(docs, "q_row", "q_id", "q_tag")
    rows = docs.select(F.struct("*").alias(whole), F.col(doc_id).cast("long").alias(a),
                       F.xxhash64(text).alias(b))
    on = F.col(a).eqNullSafe(F.col("doc_id")) & (F.col(b) == F.col("tag"))
    out = rows.join(spans, on, "left").select(f"{whole}.*", F.col("spans").alias(a))
    out = out.withColumn(text, F.when(F.col(a).isNull(), F.col(text)).otherwise(_mask(text, a)))
    if n_chars in docs.columns:
        kind = dict(docs.dtypes)[n_chars]
        out = out.withColumn(n_chars, F.when(F.col(a).isNull(), F.col(n_chars))
                             .otherwise(F.length(text)).cast(kind))
    return out.select(*docs.columns)
