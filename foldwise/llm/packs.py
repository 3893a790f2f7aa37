"""Packs: bounded runs of whole documents that tasks read again and again without a shuffle,
and the exchange of hashes by which packs learn what occurs in the others.

A pack is one record batch of an Arrow file in the shared folder. Only small rows move between
stages: a pack's place, bits for its words, and sorted distinct hashes. An exchange goes

    pack -> (bucket, sorted distinct 32-bit keys) -> sums by key -> bits -> pack

Buckets are equal ranges of the 64-bit hash; a pack sends a hash once, however often it holds
it, so one very common window costs one key a pack. The answers come back in the order of the
question, which the pack computes again instead of storing it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import arrow_tasks
from foldwise.llm.files import attempt_name, reader, writer
from foldwise.session import let_workers_import, temporary_path, write_table

#: Text bytes of a pack (a longer single text makes its own pack).
PACK_BYTES = 8 << 20
#: Key bytes that one partition of an exchange gets at most, on average; buckets a partition.
EXCHANGE_BYTES = 32 << 20
BUCKETS_EACH = 8

_STATE = "pack bigint, uri string, at int, survivors binary, replies array<struct<bucket:int,bits:binary>>"
_MESSAGE = ("bucket int, pack bigint, uri string, at int, survivors binary, repeated bigint, "
            "keys binary, counts binary")
_REPLY = "bucket int, pack bigint, uri string, at int, survivors binary, hits bigint, bits binary"


def write_packs(df: DataFrame, text: str) -> DataFrame:
    """Write ``df`` as packs of about ``PACK_BYTES`` bytes of its column ``text``.

    Returns the table of packs: ``pack`` (a number), ``uri`` and ``at`` (the file and the batch in
    it), ``n_rows``, ``n_bytes``. The files go with the session's temporary tables.
    """
    root = temporary_path(df.sparkSession, "packs")

    def run(batches):
        part, name = attempt_name()
        uri = f"{root}/{name}.arrow"
        out, sink, held, size, places = None, None, [], 0, []

        def flush():
            nonlocal out, sink, held, size
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            if out is None:
                sink = writer(uri)
                out = pa.ipc.new_file(sink, whole.schema, options=pa.ipc.IpcWriteOptions(compression="zstd"))
            out.write_batch(whole)
            places.append(((part << 32) + len(places), uri, len(places), whole.num_rows, size))
            held, size = [], 0

        for b in batches:
            if not b.num_rows:
                continue
            n = pc.fill_null(pc.binary_length(b.column(b.schema.get_field_index(text))), 0)
            ends = np.cumsum(n.to_numpy(zero_copy_only=False).astype(np.int64))
            i = 0
            while i < b.num_rows:
                before = ends[i - 1] if i else 0
                j = max(i + 1, int(np.searchsorted(ends, before + PACK_BYTES - size, "right")))
                j = min(j, b.num_rows)
                held.append(b.slice(i, j - i))
                size += int(ends[j - 1] - before)
                if size >= PACK_BYTES or j < b.num_rows:
                    flush()
                i = j
        if held:
            flush()
        if out is not None:
            out.close()
            sink.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([p[k] for p in places], t) for k, t in enumerate(
                (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64()))],
            ["pack", "uri", "at", "n_rows", "n_bytes"])

    return write_table(arrow_tasks(df, run, "pack bigint, uri string, at int, n_rows bigint, n_bytes bigint"),
                       "pack-table")


def read_packs(batches) -> Iterator[tuple[dict, pa.RecordBatch]]:
    """The rows of a table with ``uri`` and ``at``, each with its pack."""
    uri, source, file = None, None, None
    for b in batches:
        for row in b.to_pylist():
            if row["uri"] != uri:
                if source is not None:
                    source.close()
                uri, source = row["uri"], reader(row["uri"])
                file = pa.ipc.open_file(source)
            yield row, file.get_batch(row["at"])


def spread(packs: DataFrame, n_packs: int) -> DataFrame:
    """Deal the packs out to tasks; their rows are small, so their number is given."""
    conf = int(packs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return packs.repartition(max(conf, n_packs // 8), "pack")


class Hashes(NamedTuple):
    """Sorted distinct hashes of a pack's candidates: how often each, and which a candidate has."""

    first: np.ndarray
    second: np.ndarray | None
    counts: np.ndarray
    of: np.ndarray


def distinct(first: np.ndarray, second: np.ndarray | None = None) -> Hashes:
    """With a second hash the pair is compared, so that the answer is exact to about 100 bits."""
    if second is None:
        u, of, n = np.unique(first, return_inverse=True, return_counts=True)
        return Hashes(u, None, n, of)
    order = np.lexsort((second, first))
    a, b = first[order], second[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    of = np.empty(len(a), np.int64)
    of[order] = np.cumsum(new) - 1
    at = np.flatnonzero(new)
    return Hashes(a[at], b[at], np.diff(np.append(at, len(a))), of)


_EXACT = np.dtype([("a", "<u4"), ("b", "<u8")])


def _slices(h: Hashes, buckets: int) -> np.ndarray:
    """Where the buckets' runs begin and end among the sorted hashes."""
    b = ((h.first >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    return np.searchsorted(b.astype(np.int64), np.arange(buckets + 1))


def _keys(h: Hashes) -> np.ndarray:
    low = h.first.astype(np.uint32)  # the bits below those that choose the bucket
    if h.second is None:
        return low
    out = np.empty(len(low), _EXACT)
    out["a"], out["b"] = low, h.second
    return out


#: Loads a pack's arrays; ``(arrays, survivors of the level before) -> (positions, hashes)``.
Load = Callable[[pa.RecordBatch], dict]
Level = Callable[[dict, "np.ndarray | None"], "tuple[np.ndarray, Hashes]"]


class Exchange:
    """Levels of candidates over packs; a candidate survives a level if its hash occurs at least
    ``threshold`` times (at most 255) in all packs together.

    ``load(batch)`` gives a pack's arrays with ``n``, the number of positions. A level gets them
    and a mask of the positions that survived the level before (None at first) and returns the
    candidates' positions and their ``Hashes``. Single 64-bit hashes are cut to a bucket and 32
    bits on the way: a filter that never loses a candidate and passes about one false one in
    1,000 to 100,000. ``distinct`` with a second hash makes a level exact.
    """

    def __init__(self, packs: DataFrame, load: Load, threshold: int):
        self.load, self.threshold = load, threshold
        total = packs.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("b")).first()
        self.n_packs = total["n"]
        conf = int(packs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        # about one key a word of six bytes or more
        self.buckets = BUCKETS_EACH * max(conf, int(total["b"]) // EXCHANGE_BYTES)
        self.levels: list[Level] = []
        self.state = packs.selectExpr("pack", "uri", "at", "cast(null as binary) as survivors",
                                      "cast(null as array<struct<bucket:int,bits:binary>>) as replies")

    def _survivors(self):
        """The step from a state row to the pack's arrays, the survivors before its last level
        and those of its last level."""
        load, levels, buckets, threshold = self.load, list(self.levels), self.buckets, self.threshold

        def step(row, batch):
            arrays = load(batch)
            if not levels:
                return arrays, None, None
            before = row["survivors"]
            if before is not None:
                before = np.unpackbits(np.frombuffer(before, np.uint8), count=arrays["n"]).astype(bool)
            positions, h = levels[-1](arrays, before)
            cut = _slices(h, buckets)
            flags = h.counts >= threshold
            for r in row["replies"] or ():
                i, j = cut[r["bucket"]], cut[r["bucket"] + 1]
                flags[i:j] |= np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=j - i).astype(bool)
            now = np.zeros(arrays["n"], bool)
            now[positions[flags[h.of]]] = True
            return arrays, before, now

        return step

    def add(self, level: Level) -> int:
        """Run one level; returns how many hashes survived, counted once a pack that holds them."""
        step, buckets, threshold = self._survivors(), self.buckets, self.threshold

        def ask(batches):
            for row, batch in read_packs(batches):
                arrays, _, now = step(row, batch)
                _, h = level(arrays, now)
                cut, keys = _slices(h, buckets), _keys(h)
                counts = np.minimum(h.counts, 255).astype(np.uint8)
                used = np.flatnonzero(cut[1:] > cut[:-1])
                k = len(used)
                # first a row that carries the pack's own state; its bucket is below zero
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.append(-1 - row["pack"] % (1 << 30), used), pa.int32()),
                    pa.array([row["pack"]] * (k + 1), pa.int64()),
                    pa.array([row["uri"]] * (k + 1), pa.string()),
                    pa.array([row["at"]] * (k + 1), pa.int32()),
                    pa.array([None if now is None else np.packbits(now).tobytes(), *[None] * k], pa.binary()),
                    pa.array([int((h.counts >= threshold).sum()), *[0] * k], pa.int64()),
                    pa.array([None, *(keys[cut[b]:cut[b + 1]].tobytes() for b in used)], pa.binary()),
                    pa.array([None, *(counts[cut[b]:cut[b + 1]].tobytes() for b in used)], pa.binary()),
                ], [f.split()[0] for f in _MESSAGE.split(", ")])

        exact = self._is_exact(level)

        def answer(t: pa.Table) -> pa.Table:
            names = [f.split()[0] for f in _REPLY.split(", ")]
            if t.column("bucket")[0].as_py() < 0:
                bits = pa.nulls(t.num_rows, pa.binary())
                return pa.table([*(t.column(c) for c in names[:5]), t.column("repeated"), bits], names)
            raw = t.column("keys").to_pylist()
            keys = np.frombuffer(b"".join(raw), _EXACT if exact else "<u4")
            counts = np.frombuffer(b"".join(t.column("counts").to_pylist()), np.uint8)
            order = np.lexsort((keys["b"], keys["a"])) if exact else np.argsort(keys, kind="stable")
            k = keys[order]
            new = np.ones(len(k), bool)
            new[1:] = k[1:] != k[:-1]
            at = np.flatnonzero(new)
            enough = np.add.reduceat(counts[order].astype(np.int64), at) >= threshold
            flags = np.empty(len(k), bool)
            flags[order] = enough[np.cumsum(new) - 1]
            ends = np.cumsum([len(x) // keys.itemsize for x in raw])
            parts = np.split(flags, ends[:-1])
            return pa.table([*(t.column(c) for c in names[:5]),
                             pa.array([int(p.sum()) for p in parts], pa.int64()),
                             pa.array([np.packbits(p).tobytes() for p in parts], pa.binary())], names)

        asked = arrow_tasks(spread(self.state, self.n_packs), ask, _MESSAGE)
        let_workers_import(asked.sparkSession)
        told = asked.groupBy("bucket").applyInArrow(answer, _REPLY)
        state = write_table(
            told.groupBy("pack").agg(
                F.first("uri").alias("uri"), F.first("at").alias("at"),
                F.first("survivors", ignorenulls=True).alias("survivors"),
                F.collect_list(F.when(F.col("bucket") >= 0, F.struct("bucket", "bits"))).alias("replies"),
                F.sum("hits").alias("hits")), "pack-state")
        self.levels.append(level)
        self.state = state.drop("hits")
        return state.agg(F.coalesce(F.sum("hits"), F.lit(0))).first()[0]

    @staticmethod
    def _is_exact(level: Level) -> bool:
        return bool(getattr(level, "exact", False))

    def each(self):
        """``batches of state rows -> (arrays, survivors before the last level, its survivors)``."""
        step = self._survivors()

        def packs_of(batches):
            for row, batch in read_packs(batches):
                yield step(row, batch)

        return packs_of

    def finish(self, use, schema: str) -> DataFrame:
        """A pass over all packs: ``use`` gets a task's packs as ``each`` gives them and yields
        record batches."""
        each = self.each()

        def run(batches):
            yield from use(each(batches))

        return arrow_tasks(spread(self.state, self.n_packs), run, schema)
