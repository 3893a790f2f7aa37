"""Near-duplicate documents by min-max hashing.

A document's set is its distinct 5-word shingles. Each of 64 permutations gives
two signature values, the least and the greatest shingle under it, so 128
values cost 64 hash evaluations a shingle. Values agree with probability J
(the Jaccard similarity), least and greatest alike; bands take four values of
one kind, 16 bands of least and 16 of greatest values. A pair at J = 0.75
shares no band with probability 5e-6, at 0.8 with 6e-8.

Links are confirmed on full sets, and no bucket is expanded into all pairs:

1. Documents with equal sets form a class (count and 128-bit sum of the set);
   only its least id goes on.
2. Each bucket has a hub, its member with the most bucket fellows in all: in a
   group of near copies that is one close to their common source. Every member
   is compared with the hub.
3. The links' components are found. Members of a bucket that lie in different
   components are compared across components, so that pairs inside a group of
   near copies, already joined, are never listed.
4. The second links join components, so their own components are found on that small
   graph; every document takes the label of its class.

Members of shared buckets get a finer sketch, two bits of each of 1024 min-max
values, which rules out pairs below J = 0.67 or so before sets are compared (a
pair at J = 0.75 is ruled out with probability 1e-6).

Defined results: null or empty text, or white space only, has an empty set and
is linked with nothing; a text of one to four words has one shingle, the whole
sequence; rows with a null id are linked with nothing and kept; rows that share
an id are one node of the graph; very long texts are hashed whole; ties (of hubs, of equal sets) go
to the least id; an empty table gives an empty table; extra
columns are ignored by ``near_duplicates`` and carried by ``keep_first``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldwise.llm.common import arrow_tasks, byte_chunks, fresh, mix64, word_hashes
from foldwise.llm.components import components
from foldwise.llm.hotkeys import hot_keys, salted_join
from foldwise.llm.packs import read_packs, spread, write_packs
from foldwise.session import write_table

WORDS = 5
PERMUTATIONS = 64
BAND_ROWS = 4
BANDS = 2 * PERMUTATIONS // BAND_ROWS
NUM, DEN = 75, 100        # linked if DEN * intersection >= NUM * union
SKETCH_PERMUTATIONS = 512
SKETCH_LONGS = 4 * SKETCH_PERMUTATIONS // 64  # two bits of least and greatest values
SKETCH_APART_FIRST = 118  # of the first quarter: mean 64, deviation 9
SKETCH_APART = 340        # bits that differ: mean 256, deviation 17.9 at J = 0.75

_G = np.uint64(0x9E3779B97F4A7C15)
with np.errstate(over="ignore"):
    _SEEDS = mix64(np.arange(1, 2 * SKETCH_PERMUTATIONS + 2, dtype=np.uint64) * _G)
    _WORD_MUL = mix64(np.arange(5001, 5001 + WORDS, dtype=np.uint64) * _G) | np.uint64(1)
_XOR = (_SEEDS[:SKETCH_PERMUTATIONS] >> np.uint64(32)).astype(np.uint32)
_MUL = ((_SEEDS[SKETCH_PERMUTATIONS:-1] >> np.uint64(32)).astype(np.uint32)) | np.uint32(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of a chunk, sorted by row and hash, and each row's bounds."""
    n_rows = len(offsets) - 1
    h, row = word_hashes(data, offsets)
    with np.errstate(over="ignore"):
        if len(h) >= WORDS:
            s = h[:len(h) - WORDS + 1] * _WORD_MUL[0]
            for k in range(1, WORDS):
                s = s + h[k:len(h) - WORDS + 1 + k] * _WORD_MUL[k]
            whole = row[:len(s)] == row[WORDS - 1:]
            s, srow = mix64(s[whole]), row[:len(s)][whole]
        else:
            s, srow = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        counts = np.bincount(row, minlength=n_rows)
        short = np.flatnonzero((counts > 0) & (counts < WORDS))
        if len(short):
            at = np.concatenate([[0], np.cumsum(counts)])[short]
            t = counts[short].astype(np.uint64) * _G
            for k in range(WORDS - 1):
                has = counts[short] > k
                t[has] = t[has] + h[at[has] + k] * _WORD_MUL[k]
            s, srow = np.concatenate([s, mix64(t)]), np.concatenate([srow, short])
    order = np.lexsort((s, srow))
    s, srow = s[order], srow[order]
    if len(s):
        first = np.concatenate([[True], (s[1:] != s[:-1]) | (srow[1:] != srow[:-1])])
        s, srow = s[first], srow[first]
    return s, np.searchsorted(srow, np.arange(n_rows + 1))


def _min_max(s: np.ndarray, starts: np.ndarray, permutations: int) -> np.ndarray:
    """Least, then greatest shingle of each set under each permutation (2 * permutations x rows)."""
    out = np.empty((2 * permutations, len(starts)), np.uint32)
    x = (s >> np.uint64(32)).astype(np.uint32)
    with np.errstate(over="ignore"):
        for k in range(permutations):
            y = (x ^ _XOR[k]) * _MUL[k]
            np.minimum.reduceat(y, starts, out=out[k])
            np.maximum.reduceat(y, starts, out=out[permutations + k])
    return out


def _signatures(s: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Set sums (rows x 2) and band keys (rows x BANDS) of non-empty sets."""
    with np.errstate(over="ignore"):
        sums = np.stack([np.add.reduceat(mix64(s), starts),
                         np.add.reduceat(mix64(s ^ _SEEDS[-1]), starts)], axis=1)
        values = _min_max(s, starts, PERMUTATIONS).astype(np.uint64)
        keys = np.empty((len(starts), BANDS), np.uint64)
        for b in range(BANDS):
            k = np.full(len(starts), np.uint64(b + 1) * _G, np.uint64)
            for v in values[b * BAND_ROWS:(b + 1) * BAND_ROWS]:
                k = mix64((k ^ v) * _G + np.uint64(1))
            keys[:, b] = k
    return sums, keys


def _sketches(s: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Two mixed bits of each min-max value (rows x SKETCH_LONGS)."""
    values = _min_max(s, starts, SKETCH_PERMUTATIONS)
    with np.errstate(over="ignore"):
        two = ((values * np.uint32(0x9E3779B1)) ^ (values >> np.uint32(15))) * np.uint32(0x85EBCA77)
    two = (two >> np.uint32(30)).astype(np.uint8).T
    bits = np.stack([two & 1, two >> 1], axis=2).reshape(len(starts), -1)
    return np.packbits(bits, axis=1).view(np.uint64)


def _lists(x: np.ndarray) -> pa.Array:
    x = np.ascontiguousarray(x).view(np.int64)
    off = np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(off, x.reshape(-1))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packs of ``id, t`` -> each row's place, id, set size, set sums and band keys."""
    for place, b in read_packs(batches):
        for at, data, off in byte_chunks(b.column(1)):
            n_rows = len(off) - 1
            s, bounds = shingle_sets(data, off)
            n = np.diff(bounds)
            some = np.flatnonzero(n)
            sums = np.zeros((n_rows, 2), np.uint64)
            keys = np.zeros((n_rows, BANDS), np.uint64)
            if len(some):
                sums[some], keys[some] = _signatures(s, bounds[some])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n_rows, place["pack"])), pa.array(np.arange(at, at + n_rows, dtype=np.int32)),
                 b.column(0).slice(at, n_rows), pa.array(n.astype(np.int64)),
                 pa.array(sums[:, 0].view(np.int64)), pa.array(sums[:, 1].view(np.int64)),
                 _lists(keys)], names=["pack", "row", "id", "n", "f1", "f2", "keys"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The wanted ``rows`` of packs -> their ids, set sizes, sketches and sets."""
    for place, whole in read_packs(batches):
        b = whole.take(pa.array(place["rows"], pa.int32()))
        for at, data, off in byte_chunks(b.column(1)):
            s, bounds = shingle_sets(data, off)
            some = np.flatnonzero(np.diff(bounds))
            if not len(some):
                continue
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(at, len(off) - 1).take(pa.array(some)),
                 pa.array(np.diff(bounds)[some].astype(np.int64)),
                 _lists(_sketches(s, bounds[some])),
                 pa.ListArray.from_arrays(bounds[np.append(some, len(off) - 1)].astype(np.int32),
                                          s.view(np.int64))], names=["id", "n", "sketch", "s"])


def _hub_join(pairs: DataFrame, sets: DataFrame, n_pairs: int) -> DataFrame:
    """``pairs`` with the columns of ``sets`` (which holds ``a``); a hub's pairs are dealt out by ``b``."""
    return salted_join(pairs, sets, ["a"], hot_keys(pairs, ["a"], n_pairs), ["b"])


def _similar(pairs: DataFrame, sets: DataFrame, n_pairs: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets reach the threshold."""
    one = sets.select(F.col("id").alias("a"), F.col("s").alias("sa"))
    two = sets.select(F.col("id").alias("b"), F.col("s").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - both
    return (_hub_join(pairs, one, n_pairs).join(two, "b")
            .filter(DEN * both >= NUM * union).select(F.col("a").alias("u"), F.col("b").alias("v")))


def _near(sketch_a: str, sketch_b: str, n_a: str, n_b: str):
    """A pair's sizes and sketches admit the threshold; a quarter of the sketch is tried first."""
    apart = [F.bit_count(F.col(sketch_a)[k].bitwiseXOR(F.col(sketch_b)[k]))
             for k in range(SKETCH_LONGS)]
    return ((DEN * F.least(n_a, n_b) >= NUM * F.greatest(n_a, n_b))
            & (reduce(add, apart[:SKETCH_LONGS // 4]) <= SKETCH_APART_FIRST)
            & (reduce(add, apart) <= SKETCH_APART))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``."""
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("t"))
    packs = write_packs(texts, "t")
    n_packs = packs.count()
    sig = write_table(arrow_tasks(spread(packs, n_packs), _sign, "pack long, row int, id long, n long, f1 long, f2 long, "
                                                                 "keys array<long>"), "minhash-signatures")
    filled = sig.filter((F.col("n") > 0) & F.col("id").isNotNull())

    # 1. Classes of equal sets; the least id stands for the class.
    content = ["n", "f1", "f2"]
    classes = write_table(filled.groupBy(*content).agg(F.min(F.struct("id", "pack", "row", "keys")).alias("m"))
                          .select(*content, "m.id", "m.pack", "m.row", "m.keys"), "minhash-classes")
    # an id of several texts belongs to several classes and links them
    several = (filled.groupBy("id").agg(F.min(F.struct(*content)).alias("lo"), F.max(F.struct(*content)).alias("hi"))
               .filter("lo <> hi").select("id"))
    twins = (filled.select("id", *content).join(several, "id", "left_semi")
             .join(classes.select(*content, F.col("id").alias("v")), content).select(F.col("id").alias("u"), "v"))

    # 2. Buckets of two classes or more, each member against the hub.
    members = classes.select("id", "pack", "row", F.explode("keys").alias("key"))
    buckets = write_table(members.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi"),
                                                     F.count(F.lit(1)).alias("size"))
                          .filter("lo <> hi").select("key", "size"), "minhash-keys")
    n_members = buckets.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    crowded = hot_keys(buckets, ["key"], n_members, "size")
    shared = write_table(salted_join(members, buckets, ["key"], crowded, ["id"])
                         .withColumn("fellows", F.sum("size").over(Window.partitionBy("id"))), "minhash-buckets")
    # the texts stay where they are: their packs are told which rows are wanted
    wanted = (shared.select("pack", "row").distinct().groupBy("pack").agg(F.sort_array(F.collect_list("row")).alias("rows"))
              .join(packs.select("pack", "uri", "at"), "pack"))
    sets = write_table(arrow_tasks(spread(wanted, n_packs), _sets,
                                   "id long, n long, sketch array<long>, s array<long>"), "minhash-sets")
    left = sets.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("ka"))
    right = sets.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("kb"))
    hubs = (shared.groupBy("key")
            .agg((-F.max(F.struct("fellows", (-F.col("id")).alias("minus")))["minus"]).alias("a")))
    rays = write_table(salted_join(shared.select("key", "id"), hubs, ["key"], crowded, ["id"])
                       .filter("a <> id").select("a", F.col("id").alias("b")).distinct(), "minhash-rays")
    stars = write_table(_hub_join(rays, left, rays.count()).join(right, "b")
                        .filter(_near("ka", "kb", "na", "nb")).select("a", "b"), "minhash-stars")
    links = _similar(stars, sets, stars.count()).unionByName(twins)

    # 3. What is left: members of one bucket in different components.
    comp = components(links)
    placed = (shared.select("key", F.col("id").alias("b")).distinct()
              .join(comp.select(F.col("id").alias("b"), F.col("component_id").alias("at")), "b", "left")
              .withColumn("at", F.coalesce("at", "b")))
    mixed = (placed.groupBy("key").agg(F.min("at").alias("lo"), F.max("at").alias("hi"))
             .filter("lo <> hi").select("key"))
    # Sizes of similar sets differ by a factor of 4/3 at most: compare neighbouring classes.
    cls = F.floor(F.log(F.col("nb")) / F.log(F.lit(DEN / NUM))).cast("int")
    keys = classes.select(F.col("id").alias("b"), F.col("keys").alias("all"))
    rows = write_table(placed.join(mixed, "key").join(right, "b").join(keys, "b")
                       .withColumn("cls", cls), "minhash-mixed")
    mine = rows.select("key", F.col("b").alias("a"), F.col("at").alias("ata"),
                       F.col("nb").alias("na"), F.col("kb").alias("ka"), "cls",
                       F.col("all").alias("mine"))
    theirs = rows.withColumn("cls", F.explode(F.array(F.col("cls") - 1, "cls", F.col("cls") + 1)))
    cross = mine.join(theirs, (mine["key"] == theirs["key"]) & (mine["cls"] == theirs["cls"])
                      & (F.col("a") < F.col("b")) & (F.col("ata") != F.col("at"))
                      & _near("ka", "kb", "na", "nb")
                      # a pair that shares several buckets is listed in the first
                      & (F.array_intersect("mine", "all")[0] == mine["key"])
                      ).select("a", "b").distinct()
    tried = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    cross = write_table(cross.join(tried, ["a", "b"], "left_anti"), "minhash-cross")
    more = _similar(cross, sets, cross.count())

    # 4. The components of the first links are the nodes of the second; every row gets its class's.
    def at(side: str) -> DataFrame:
        return comp.select(F.col("id").alias(side), F.col("component_id").alias(f"c{side}"))

    between = (more.join(at("u"), "u", "left").join(at("v"), "v", "left")
               .select(F.coalesce("cu", "u").alias("u"), F.coalesce("cv", "v").alias("v")))
    joined = components(between)
    label = (classes.select(*content, "id").join(comp.withColumnRenamed("component_id", "c1"), "id", "left")
             .withColumn("c1", F.coalesce("c1", "id"))
             .join(joined.select(F.col("id").alias("c1"), F.col("component_id").alias("c2")), "c1", "left")
             .select(*content, F.coalesce("c2", "c1").alias("component_id")))
    narrow = filled.select("id", *content)
    big = hot_keys(narrow, content, narrow.count())
    found = (salted_join(narrow, label, content, big, ["id"])
             .select("id", F.col("n").alias("n_shingles"), "component_id"))
    alone = (sig.filter("n = 0 OR id IS NULL")
             .select("id", F.col("n").alias("n_shingles"), F.col("id").alias("component_id")))
    out = found.unionByName(alone)
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id",
                      (F.col("id").isNull() | (F.col("component_id") == F.col("id"))).alias("kept"))


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with the least id of their group, all columns as they are.

    Rows of a dropped id go; rows that repeat a kept id all stay.
    """
    gone = near_duplicates(docs, doc_id, text).filter("not kept").select("doc_id").distinct()
    return docs.join(gone.select(F.col("doc_id").alias(doc_id)), doc_id, "left_anti").select(*docs.columns)
