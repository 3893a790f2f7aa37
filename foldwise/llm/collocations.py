"""Phrase collocation mining: double-array tries of Apriori-safe candidates, walked with numpy.

Texts are lower-cased (A-Z), cut at ``.,;:!?`` and line ends into pieces and these into words.
Counts are per language. The work is level by level:

1. words: each pack of documents counts its distinct words; sums by (language, word).
2. candidates of two words: pairs whose count may reach ``min_count``, by an upper bound (sums over
   hashes cut to a bucket and 32 bits, see ``packs``), so none is lost.
3. candidates of three words: positions at which two candidates of two words overlap (Apriori), if
   their own upper bound reaches ``min_count``.
4. the distinct candidates are dealt to shards by the hash of their first two words; a task per
   shard builds a double-array trie. Tries are broadcast in waves of at most ``WAVE_BYTES``
   (more candidates make more waves, not larger ones); each pack advances the states of
   all its candidate positions at once, word by word, and counts accepting states; counts are
   summed over the packs. These counts are exact.
5. scores in exact decimal arithmetic, as joins of each phrase with the parts of its cuts.

Defined results: null and empty texts have no words; a null language is ``und``; very long texts are
handled whole; repeated rows and rows with equal or null ids count each (ids are not read); words are
told apart by strings where they are output and by 64-bit hashes of language and word
in the tries; ties in score go to the larger count and then to the smaller phrase in UTF-8 byte order;
an empty table, or one without a phrase often enough, gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldwise.llm.common import _GOLD, _LOWER, _powers, arrow_tasks, byte_chunks, mix64
from foldwise.llm.doublearray import DoubleArray, build
from foldwise.llm.hotkeys import hot_keys, salted_join
from foldwise.llm.packs import Exchange, distinct, read_packs, spread, write_packs
from foldwise.llm.units import _BASES, _CODE, _INVERSES
from foldwise.session import let_workers_import, write_table

MIN_COUNT = 10
TOP = 2000
#: A phrase inside a longer candidate goes if the longer one has at least this share of its count.
COVERED_PCT = 50
SCALE = 1_000_000

#: Candidates of one trie, and bytes of tries that are broadcast at once.
SHARD_PHRASES = 40_000
WAVE_BYTES = 64 << 20
# Fixed values of the definition: bytes that part words, and those that also part pieces.
_BREAK = np.zeros(256, bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_PART = _BREAK.copy()
_PART[[32, 9]] = True


def _lang_code(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


def load(batch: pa.RecordBatch) -> dict:
    """A pack's words: place in the pack's lower-cased bytes, code of language and word, row, and
    whether the next word follows in the same piece."""
    langs = batch.column(0).to_pylist()
    known = {x: _lang_code(x) for x in set(langs)}
    lang_of = np.array([known[x] for x in langs], np.uint64)
    parts = {k: [np.zeros(0, t)] for k, t in
             (("s", np.int64), ("e", np.int64), ("code", np.uint64), ("row", np.int64), ("next", bool))}
    texts, done = [], 0
    for at, data, off in byte_chunks(batch.column(1)):
        n = len(data)
        if not n:
            continue
        data = _LOWER[data]
        texts.append(data.tobytes())
        word = ~_PART[data]
        edge = np.zeros(n + 1, bool)
        edge[off] = True
        s = np.flatnonzero(word & (np.concatenate([[True], ~word[:-1]]) | edge[:n]))
        e = np.flatnonzero(word & (np.concatenate([~word[1:], [True]]) | edge[1:])) + 1
        row = np.searchsorted(off, s, "right") - 1
        breaks = np.concatenate([[0], np.cumsum(_BREAK[data])])
        follows = np.zeros(len(s), bool)
        follows[:-1] = (row[1:] == row[:-1]) & (breaks[s[1:]] == breaks[e[:-1]])
        with np.errstate(over="ignore"):
            run = np.zeros(n + 1, np.uint64)
            np.cumsum(_CODE[data] * _powers("unit0", _BASES[0], n), out=run[1:])
            h = (run[e] - run[s]) * _powers("unit-0", _INVERSES[0], n)[s]
            h = mix64(mix64(h + (e - s).astype(np.uint64) * _GOLD) ^ lang_of[at + row])
        h[h == 0] = 1  # 0 ends a phrase in the tries
        for k, x in (("s", done + s), ("e", done + e), ("code", h), ("row", at + row), ("next", follows)):
            parts[k].append(x)
        done += n
    out = {k: np.concatenate(v) for k, v in parts.items()}
    return out | {"n": len(out["s"]), "langs": langs, "text": b"".join(texts)}


def _pair_hash(code: np.ndarray, at: np.ndarray, words: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = code[at]
        for k in range(1, words):
            h = mix64(h * _BASES[1] + code[at + k])
        return h


def pairs(a: dict, _) -> tuple:
    at = np.flatnonzero(a["next"])
    return at, distinct(_pair_hash(a["code"], at, 2))


def triples(a: dict, survivors: np.ndarray) -> tuple:
    at = np.flatnonzero(survivors[:-1] & survivors[1:])
    return at, distinct(_pair_hash(a["code"], at, 3))


def _strings(a: dict, first: np.ndarray, words: int) -> pa.Array:
    """The phrases of ``words`` words that start at these positions, words joined by a space."""
    if words == 1:
        raw = [a["text"][i:j] for i, j in zip(a["s"][first].tolist(), a["e"][first].tolist())]
    else:
        cols = [_strings(a, first + k, 1).to_pylist() for k in range(words)]
        raw = [b" ".join(x) for x in zip(*cols)]
    return pa.array(raw, pa.binary())


def _langs(a: dict, at: np.ndarray) -> pa.Array:
    return pa.array(a["langs"], pa.string()).take(pa.array(a["row"][at]))


def word_counts(packs: DataFrame, n_packs: int) -> DataFrame:
    """``lang, word, f``, and one row of each language with a null word and the sum of all words."""

    def run(batches):
        for _, batch in read_packs(batches):
            a = load(batch)
            _, first, count = np.unique(a["code"], return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [_langs(a, first), _strings(a, first, 1).cast(pa.string()), pa.array(count.astype(np.int64))],
                ["lang", "word", "f"])
            rows = np.bincount(a["row"], minlength=len(a["langs"]))
            total: dict[str, int] = {}
            for x, k in zip(a["langs"], rows.tolist()):
                total[x] = total.get(x, 0) + k
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.string()), pa.nulls(len(total), pa.string()),
                 pa.array(list(total.values()), pa.int64())], ["lang", "word", "f"])

    return (arrow_tasks(spread(packs, n_packs), run, "lang string, word string, f bigint")
            .groupBy("lang", "word").agg(F.sum("f").alias("f")))


def _candidates(ex: Exchange) -> DataFrame:
    """The distinct candidates: ``lang, phrase, pair`` (hash of the first two words), codes ``c1, c2, c3``
    (0 without a third word). Packs send the strings alone; the codes are made from those that are left."""

    def use(packs_of_task):
        for a, two, three in packs_of_task:
            for words, mask in ((2, two), (3, three)):
                at = np.flatnonzero(mask)
                _, i = np.unique(_pair_hash(a["code"], at, words), return_index=True)
                at = at[i]
                yield pa.RecordBatch.from_arrays([_langs(a, at), _strings(a, at, words).cast(pa.string())],
                                                 ["lang", "phrase"])

    def coded(batches):
        for b in batches:
            if not b.num_rows:
                continue
            a = load(b)
            first = np.searchsorted(a["row"], np.arange(b.num_rows))
            size = np.diff(np.append(first, a["n"]))
            code = [a["code"][first], a["code"][first + 1],
                    np.where(size > 2, a["code"][np.minimum(first + 2, a["n"] - 1)], np.uint64(0))]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(_pair_hash(a["code"], first, 2).view(np.int64)),
                 *(pa.array(c.view(np.int64)) for c in code)], ["lang", "phrase", "pair", "c1", "c2", "c3"])

    return arrow_tasks(ex.finish(use, "lang string, phrase string").distinct(), coded,
                       "lang string, phrase string, pair bigint, c1 bigint, c2 bigint, c3 bigint")


def _shard(pair: np.ndarray, shards: int) -> np.ndarray:
    return ((pair >> np.uint64(33)) % np.uint64(shards)).astype(np.int64)


def _tries(cand: DataFrame) -> DataFrame:
    """One double-array trie a shard: ``shard, phrases, nbytes`` and its four arrays."""

    def made(t: pa.Table) -> pa.Table:
        t = t.sort_by("idx")
        codes = np.column_stack([t.column(c).to_numpy().view(np.uint64) for c in ("c1", "c2", "c3")])
        trie = build(codes)
        return pa.table([pa.array([t.column("shard")[0].as_py()], pa.int32()), pa.array([trie.phrases], pa.int32()),
                         pa.array([trie.nbytes], pa.int64()), *(pa.array([x], pa.binary()) for x in trie.to_bytes())],
                        ["shard", "phrases", "nbytes", "vocabulary", "base", "checks", "accept"])

    let_workers_import(cand.sparkSession)
    return cand.select("shard", "idx", "c1", "c2", "c3").groupBy("shard").applyInArrow(
        made, "shard int, phrases int, nbytes bigint, vocabulary binary, base binary, checks binary, accept binary")


def _walk(trie: DoubleArray, a: dict, at: np.ndarray) -> np.ndarray:
    """How often each phrase of the trie starts at the positions ``at``: all states advance
    together, one word a level."""
    out = np.zeros(trie.phrases, np.int64)
    state = np.zeros(len(at), np.int64)
    for k in range(3):
        state = trie.step(state, trie.symbols(a["code"][at + k]))
        live = state >= 0
        found = trie.accept[state[live]]
        out += np.bincount(found[found >= 0], minlength=trie.phrases)
        live[live] = a["next"][at[live] + k]  # the piece goes on
        at, state = at[live], state[live]
        if not len(at):
            break
    return out


def _counts(ex: Exchange, tries: DataFrame, shards: int) -> DataFrame:
    """``shard, idx, a``: the exact counts of the candidates, wave by wave."""
    spark = tries.sparkSession
    waves, size = [[]], 0
    for r in tries.select("shard", "nbytes").orderBy("shard").toLocalIterator():
        if waves[-1] and size + r["nbytes"] > WAVE_BYTES:
            waves.append([])
            size = 0
        waves[-1].append(r["shard"])
        size += r["nbytes"]
    out = []
    for wave in waves:
        rows = tries.filter(F.col("shard").between(wave[0], wave[-1])).collect() if wave else []
        held = spark.sparkContext.broadcast(
            {r["shard"]: DoubleArray.from_bytes([bytes(r[c]) for c in ("vocabulary", "base", "checks", "accept")],
                                                r["phrases"]) for r in rows})

        def use(packs_of_task, held=held):
            total: dict[int, np.ndarray] = {}
            for a, two, _ in packs_of_task:
                at = np.flatnonzero(two)
                shard = _shard(_pair_hash(a["code"], at, 2), shards)
                order = np.argsort(shard, kind="stable")
                cut = np.searchsorted(shard[order], np.arange(shards + 1))
                for s, trie in held.value.items():
                    i, j = cut[s], cut[s + 1]
                    if i < j:
                        n = _walk(trie, a, np.sort(at[order[i:j]]))
                        total[s] = total[s] + n if s in total else n
            for s, n in total.items():
                idx = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(idx), s, np.int32)), pa.array(idx.astype(np.int32)), pa.array(n[idx])],
                    ["shard", "idx", "a"])

        out.append(write_table(ex.finish(use, "shard int, idx int, a bigint")
                               .groupBy("shard", "idx").agg(F.sum("a").alias("a")), "phrase-counts"))
        held.unpersist()
    whole = out[0]
    for more in out[1:]:
        whole = whole.unionByName(more)
    return whole


def phrases(docs: DataFrame, min_count: int = MIN_COUNT, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """All phrases of two and three words that occur at least ``min_count`` (2 to 255) times:
    ``lang, phrase, words, a, l, r, n, score, covered`` with the lowest-scoring cut's parts;
    ``covered`` if a longer candidate holds the phrase and enough of its count."""
    if not 2 <= min_count <= 255:
        raise ValueError("min_count is from 2 to 255")
    packs = write_packs(docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                                    F.col(text_col).alias("text")), "text")
    ex = Exchange(packs, load, min_count)
    words = write_table(word_counts(packs, ex.n_packs).filter(f"word is null or f >= {min_count}"), "word-counts")
    ex.add(pairs)
    ex.add(triples)
    cand = write_table(_candidates(ex), "phrase-candidates")
    n = cand.count()
    shards = max(1, -(-n // SHARD_PHRASES))
    cand = write_table(
        cand.withColumn("shard", (F.expr("shiftrightunsigned(pair, 33)") % shards).cast("int"))
        .withColumn("idx", F.row_number().over(Window.partitionBy("shard").orderBy("lang", "phrase")) - 1), "phrase-shards")
    counts = _counts(ex, write_table(_tries(cand), "tries"), shards)
    found = write_table(cand.join(counts, ["shard", "idx"]).filter(F.col("a") >= min_count)
                        .select("lang", "phrase", F.size(F.split("phrase", " ")).alias("words"), "a"), "phrases")

    w = F.split("phrase", " ")
    cut = lambda k, side, i, m: F.struct(F.lit(k).alias("k"), F.lit(side).alias("side"),
                                         F.array_join(F.slice(w, i, m), " ").alias("part"))
    sides = found.withColumn("cut", F.explode(
        F.when(F.col("words") == 2, F.array(cut(1, "l", 1, 1), cut(1, "r", 2, 1)))
        .otherwise(F.array(cut(1, "l", 1, 1), cut(1, "r", 2, 2), cut(2, "l", 1, 2), cut(2, "r", 3, 1)))))
    sides = sides.select("lang", "phrase", "words", "a", "cut.*")
    parts = (words.filter("word is not null").select("lang", F.col("word").alias("part"), "f")
             .unionByName(found.filter("words = 2").select("lang", F.col("phrase").alias("part"), F.col("a").alias("f"))))
    whole = F.lit(SCALE).cast("decimal(7,0)")
    wide = lambda c: F.col(c).cast("decimal(16,0)")
    scored = (salted_join(sides, parts, ["lang", "part"], hot_keys(sides, ["lang", "part"], 4 * n), ["phrase", "k", "side"])
              .groupBy("lang", "phrase", "words", "a", "k")
              .agg(F.max(F.expr("case when side = 'l' then f end")).alias("l"),
                   F.max(F.expr("case when side = 'r' then f end")).alias("r"))
              .withColumn("num", (wide("a") * wide("a") * whole).cast("decimal(38,0)"))
              .withColumn("den", wide("l") * wide("r"))
              .withColumn("score", F.expr("num div den"))
              .groupBy("lang", "phrase", "words", "a")
              .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
              .select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score"))
    longer = (found.filter("words = 3")
              .withColumn("phrase", F.explode(F.array(F.array_join(F.slice(w, 1, 2), " "), F.array_join(F.slice(w, 2, 2), " "))))
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    totals = words.filter("word is null").select("lang", F.col("f").alias("n"))
    return (scored.join(longer, ["lang", "phrase"], "left")
            .withColumn("covered", F.coalesce(100 * F.col("longer") >= COVERED_PCT * F.col("a"), F.lit(False)))
            .drop("longer").join(totals, "lang"))


def collocations(docs: DataFrame, top: int = TOP, min_count: int = MIN_COUNT) -> DataFrame:
    """Each language's first ``top`` phrases: ``lang, rank, phrase, a, l, r, n, score``. The first of
    64 or more groups of each language are taken before those of the language."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    groups = max(64, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    left = phrases(docs, min_count).filter("not covered").withColumn("grp", F.pmod(F.xxhash64("phrase"), F.lit(groups)))
    first = left.withColumn("at", F.row_number().over(Window.partitionBy("lang", "grp").orderBy(*order))).filter(F.col("at") <= top)
    return (first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
            .filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
