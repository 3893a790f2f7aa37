"""Hierarchical Pitman-Yor language model with Gibbs-sampled seating.

Tokens are lower-cased words and an end token per text. A token's context is the
token before it (the end token before the first), and every context, by its full
64-bit hash, has a restaurant of its own. All context restaurants share one parent,
the unigram restaurant, whose base is uniform over the V + 1 words (the training
words and one for all others). A customer of a context restaurant sits at a table that serves its
word; each table sends one customer to the parent. With c customers and t
tables of a word, C customers and T tables in all, discount d and strength s

    P(w) = (c - d t + (s + d T) P_parent(w)) / (s + C).

Seating enters only through the numbers of tables. One Gibbs step reseats all
customers of a word in a restaurant: given the rest, the weight of t tables is

    prod_{i < t} (s + d (T_rest + i)) * P_parent(w)^t * S(c, t),

S counting the seatings of c customers at t tables. For d = 1/2, used here, the
ratio of neighbouring S has a closed form, so t is drawn from its exact
conditional, whatever c is; the parent is held at its predictive mean. Strengths
are resampled from the restaurants' totals by auxiliary variables (gamma priors).

Distribution: tokens are packed by (word, context, document) and shuffled once,
by ranges of the word's hash, so all customers of a word meet in one bucket and
only restaurant totals are exchanged between rounds. Each bucket adds up its own
customers and tables of a context first. The sums of the ``CONTEXTS`` most common
contexts (found on the sample below; they travel as 16-bit codes) are added slice by
slice and pass the driver as vectors; those of all other contexts, however many,
are shuffled by ranges of the context's hash, added and sent back to the buckets.
Words so frequent that one would unbalance its bucket (at most
``HOT_PER_BUCKET`` times the buckets, found on a hash sample of documents, which
steers the balance only) are spread over all buckets by context; their totals are
exchanged like those of restaurants. Scores average the predictive
probabilities of ``SAMPLES`` sweeps.

Defined results: null and empty texts have the end token alone; rows with a null
id are scored, and train; repeated rows count as often as they occur; without
training tokens every probability is the base's; very long texts are scored whole (a pack holds
at least one text), their parts summed in 64 bits; ties cannot change a result (no step ranks rows); an
empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import arrow_tasks, byte_chunks, mix64, splits, word_hashes
from foldwise.llm.files import attempt_name, mapped, writer
from foldwise.session import drop_table, temporary_path, write_table

CONTEXTS = 65_535         # common contexts, which have a code; the others are known by their hash
OTHER = CONTEXTS          # the code of all others in a pack
DISCOUNT = 0.5            # the closed form below needs this value
ROUNDS = 3                # exchanges of restaurant totals before scoring
SWEEPS = 3                # Gibbs sweeps of a bucket in a round
SAMPLES = 4               # sweeps whose probabilities are averaged
SEED = 20
PACK_BYTES = 8 << 20      # text packed at once in a task
PACK_ROWS = 60_000        # documents of a pack are numbered by 16 bits
BUCKET_BYTES = 12 << 20   # text per bucket
HOT_PER_BUCKET = 4        # a hot word has more than 1 / (4 * buckets) of the tokens
HOT_SAMPLE = 16           # hot words are sought in one of so many documents
SAMPLE_ROWS = 4096        # or in more of them, down to about so many
SLICE = 1024              # numbers of a vector that are added up in one task
PART_BUCKETS = 4          # other contexts are added up in a quarter as many parts as buckets

_G = np.uint64(0x9E3779B97F4A7C15)
END = mix64(np.array([0xE0D], np.uint64))[0]

_PACK = ("bucket int, chunk long, words binary, sizes binary, phi binary, other binary, doc binary, "
         "more_at binary, more binary, train binary")


def trains(doc_id: Column, folds: int = 7, held: int = 2) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds != held


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all rows in order, each row closed by the end token, and their rows."""
    hashes, rows = [], []
    for at, data, off in byte_chunks(texts):
        h, row = word_hashes(data, off)
        n = len(off) - 1
        counts = np.bincount(row, minlength=n)
        tok, trow = np.empty(len(h) + n, np.uint64), np.empty(len(h) + n, np.int64)
        put = np.arange(len(h)) + row
        ends = np.cumsum(counts) + np.arange(n)
        tok[put], trow[put] = h, row + at
        tok[ends], trow[ends] = END, np.arange(n) + at
        hashes.append(tok)
        rows.append(trow)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(rows)


def _packs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array, pa.Array]]:
    """Runs of rows of about ``PACK_BYTES``: ids, texts, training flags."""
    for b in batches:
        text = b.column(1).cast(pa.large_string())
        size = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(text), 0).to_numpy(
            zero_copy_only=False))
        i = 0
        while i < b.num_rows:
            j = int(np.searchsorted(size, (size[i - 1] if i else 0) + PACK_BYTES, "right"))
            j = min(max(j, i + 1), b.num_rows, i + PACK_ROWS)
            yield b.column(0).slice(i, j - i), text.slice(i, j - i), b.column(2).slice(i, j - i)
            i = j


def _squeezed(x: np.ndarray) -> bytes:
    """An array's bytes compressed, after their number."""
    return np.uint64(x.nbytes).tobytes() + pa.compress(x.tobytes(), codec="zstd", asbytes=True) if len(x) else b""


def _loosened(raw, kind: str) -> np.ndarray:
    if not len(raw):
        return np.zeros(0, kind)
    raw = memoryview(raw)
    return np.frombuffer(pa.decompress(pa.py_buffer(raw[8:]), int(np.frombuffer(raw[:8], np.uint64)[0]), "zstd"), kind)


def _entries(words: np.ndarray, phi: np.ndarray, context: np.ndarray, doc: np.ndarray,
             n: np.ndarray) -> list[bytes]:
    """Entries sorted by word as bytes: distinct words, entries of each, the rest in order (a
    context's hash only where it has no code), and the places and values of counts above one."""
    new = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
    return [words[new].tobytes(), np.diff(np.append(new, len(words))).astype(np.uint32).tobytes(),
            _squeezed(phi.astype(np.uint16)), context[phi == OTHER].tobytes(),
            _squeezed(doc.astype(np.uint16)),
            np.flatnonzero(n > 1).astype(np.uint32).tobytes(), n[n > 1].astype(np.uint32).tobytes()]


def _pack(n_buckets: int, hot: np.ndarray, common: np.ndarray):
    """Texts -> for each pack, a row per bucket of its (word, context, document) counts, and one
    row (negative bucket) with the documents' ids and token counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for ids, texts, train in _packs(batches):
            chunk, seq = part << 32 | seq, seq + 1
            tok, row = tokens(texts)
            words, at = np.unique(tok, return_inverse=True)
            # a pack of several documents has 23 bits of words at most, one of a single one has no row bits
            wide = np.uint64(len(words).bit_length())
            low = np.uint64((len(ids) - 1).bit_length())
            before = np.concatenate([[np.searchsorted(words, END)], at[:-1]])
            key = ((at.astype(np.uint64) << wide | before.astype(np.uint64)) << low) | row.astype(np.uint64)
            key, n = np.unique(key, return_counts=True)
            doc = (key & ((np.uint64(1) << low) - np.uint64(1))).astype(np.uint16)
            key >>= low
            at = (key >> wide).astype(np.int64)
            before = (key & ((np.uint64(1) << wide) - np.uint64(1))).astype(np.int64)
            context = words[before]
            code = np.searchsorted(common, words)
            code[code == len(common)] = 0
            code = np.where(common[code] == words, code, OTHER) if len(common) else np.full(len(words), OTHER)
            phi = code[before].astype(np.uint16)
            flags = np.packbits(train.to_numpy(zero_copy_only=False)).tobytes()
            bucket = ((words >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int64)
            spread = np.isin(words, hot)[at]
            by = bucket[at]
            by[spread] = (mix64(words[at[spread]] + context[spread] * _G) % np.uint64(n_buckets)).astype(np.int64)
            if spread.any():  # the others are in order of their buckets already
                order = np.argsort(by, kind="stable")
                at, phi, context, doc, n, by = (x[order] for x in (at, phi, context, doc, n, by))
            cuts = [0, *(np.flatnonzero(np.diff(by)) + 1).tolist(), len(by)]
            rows = [[int(by[i]), chunk, *_entries(words[at[i:j]], phi[i:j], context[i:j], doc[i:j], n[i:j]),
                     flags]
                    for i, j in zip(cuts, cuts[1:]) if j > i]
            valid = ids.is_valid().to_numpy(zero_copy_only=False)
            rows.append([-1 - seq % n_buckets, chunk,
                         ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).tobytes(),
                         np.bincount(row, minlength=len(ids)).astype(np.uint32).tobytes(),
                         np.packbits(valid).tobytes(), b"", b"", b"", b"", flags])
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()),
                 *[pa.array(c, pa.binary()) for c in cols[2:]]],
                names=[x.split()[0] for x in _PACK.split(", ")])
    return run


def _each(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch one by one; binary values stay views of the batch."""
    names = batch.schema.names
    for i in range(batch.num_rows):
        row = {}
        for name, column in zip(names, batch.columns):
            x = column[i]
            row[name] = x.as_buffer() if pa.types.is_binary(x.type) and x.is_valid else x.as_py()
        yield row


_BLOB_ARRAYS = (("words", "<u8"), ("sizes", "<u4"), ("phi", "<u2"), ("other", "<u8"), ("doc", "<u2"),
                ("more_at", "<u4"), ("more", "<u4"), ("train", "u1"))
# A bucket's arrays and their types, as they lie in its file: the cells of each word, and for each
# pack its entries by cell, each cell as the step from the one before; counts other than one have a
# place and a value. All are compressed.
_CELL_ARRAYS = (("words", "<u8"), ("sizes", "<u4"), ("phi", "<u4"), ("c_at", "<u4"), ("c", "<u4"),
                ("other", "<u8"))
_ENTRY_ARRAYS = (("step", "<u4"), ("doc", "<u2"), ("more_at", "<u4"), ("more", "<u4"))


def _write_bucket(file: str, cells: dict, blobs: list[dict]) -> str:
    """Write a bucket's arrays one after the other; returns their places as JSON."""
    at = 0
    with writer(file) as f:
        def put(arrays: dict, kinds: tuple) -> list[list[int]]:
            nonlocal at
            places = []
            for name, kind in kinds:
                raw = _squeezed(np.ascontiguousarray(arrays[name], kind))
                f.write(raw)
                places.append([at, len(raw)])
                at += len(raw)
            return places

        head = put(cells, _CELL_ARRAYS)
        return json.dumps({"cells": head, "blobs": [[b["chunk"], put(b, _ENTRY_ARRAYS)] for b in blobs]})


class _Bucket:
    """A bucket's file, memory-mapped where it is local."""

    def __init__(self, row: dict):
        self.data, self.places = mapped(row["file"], np.uint8), json.loads(row["places"])

    def _read(self, kinds: tuple, places: list[list[int]]) -> dict[str, np.ndarray]:
        return {name: _loosened(self.data[at:at + n], kind)
                for (name, kind), (at, n) in zip(kinds, places)}

    def cells(self) -> Cells:
        x = self._read(_CELL_ARRAYS, self.places["cells"])
        c = np.ones(len(x["phi"]), np.int64)
        c[x["c_at"]] = x["c"]
        at = np.repeat(np.arange(len(x["words"]), dtype=np.int32), x["sizes"])
        return Cells(x["words"], at, x["phi"].astype(np.int64), c, x["other"])

    def blobs(self) -> Iterator[dict]:
        for chunk, p in self.places["blobs"]:
            x = self._read(_ENTRY_ARRAYS, p)
            yield x | {"chunk": chunk, "cell": np.cumsum(x["step"], dtype=np.int64)}


@dataclass
class Cells:
    """A bucket's (word, context) pairs, sorted: the word's place, the context, training count.

    A context is its code or, from ``CONTEXTS`` on, its place among the bucket's other contexts.
    """

    words: np.ndarray
    at: np.ndarray
    phi: np.ndarray
    c: np.ndarray
    other: np.ndarray


def _cells(blobs: list[dict]) -> tuple[Cells, np.ndarray]:
    """The cells of a bucket's blobs and, for every entry in the blobs' order, its cell."""
    words = np.concatenate([b["words"] for b in blobs])
    sizes = np.concatenate([b["sizes"] for b in blobs])
    words, at = np.unique(words, return_inverse=True)
    key = np.repeat(at.astype(np.uint64) << np.uint64(32), sizes)
    phi = np.concatenate([b["phi"] for b in blobs]).astype(np.uint64)
    other, place = np.unique(np.concatenate([b["other"] for b in blobs]), return_inverse=True)
    phi[phi == OTHER] = place.astype(np.uint64) + np.uint64(CONTEXTS)
    key |= phi
    del phi, place
    order = np.argsort(key)
    key = key[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    cell = np.empty(len(key), np.int32)
    cell[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
    del order
    key = key[new]
    c, begin = np.zeros(len(key), np.int64), 0
    for b in blobs:
        own = cell[begin:begin + len(b["doc"])]
        begin += len(own)
        c += np.bincount(own, weights=_counts(b) * np.unpackbits(b["train"])[b["doc"]],
                         minlength=len(key)).astype(np.int64)
    return Cells(words, (key >> np.uint64(32)).astype(np.int32), (key & np.uint64(0xFFFFFFFF)).astype(np.int64),
                 c, other), cell


def _counts(b: dict) -> np.ndarray:
    """How often each entry's word follows its context in its document."""
    n = np.ones(len(b["doc"]), np.uint32)
    n[b["more_at"]] = b["more"]
    return n


_BUCKET = "bucket int, file string, places string, chunk long, ids binary, n binary, valid binary"


def _merge(folder: str):
    """Blobs sorted by bucket -> each bucket's file, and one row per bucket; the documents' rows
    pass through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, name = attempt_name()

        def out(bucket: int, blobs: list[dict]) -> pa.RecordBatch:
            x, cell = _cells(blobs)
            begin = 0
            for blob in blobs:
                own = cell[begin:begin + len(blob["doc"])]
                begin += len(own)
                order = np.argsort(own, kind="stable")
                n = _counts(blob)[order]
                blob |= {"step": np.diff(own[order], prepend=0), "doc": blob["doc"][order],
                         "more_at": np.flatnonzero(n > 1), "more": n[n > 1]}
            file, not_one = f"{folder}/{name}-{bucket}", np.flatnonzero(x.c != 1)
            places = _write_bucket(file, {"words": x.words, "sizes": np.bincount(x.at, minlength=len(x.words)),
                                          "phi": x.phi, "c_at": not_one, "c": x.c[not_one],
                                          "other": x.other}, blobs)
            return row([bucket, file, places, None, None, None, None])

        def row(values: list) -> pa.RecordBatch:
            kinds = [pa.int32(), pa.string(), pa.string(), pa.int64(), *[pa.binary()] * 3]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(values, kinds)],
                names=["bucket", "file", "places", "chunk", "ids", "n", "valid"])

        current, held = None, []
        for b in batches:
            for r in _each(b):
                bucket = r["bucket"]
                if held and bucket != current:
                    yield out(current, held)
                    held = []
                current = bucket
                if bucket < 0:
                    yield row([bucket, None, None, r["chunk"],
                               *(r[c].to_pybytes() for c in ("words", "sizes", "phi"))])
                    continue
                held.append({name: _loosened(r[name], kind) if name in ("phi", "doc")
                             else np.frombuffer(r[name], kind) if r[name].size else np.zeros(0, kind)
                             for name, kind in _BLOB_ARRAYS} | {"chunk": r["chunk"]})
        if held:
            yield out(current, held)
    return run


# --- the sampler ------------------------------------------------------------------------------

def draw_tables(c: np.ndarray, parent: np.ndarray, rest: np.ndarray, strength: float,
                rng: np.random.Generator) -> np.ndarray:
    """Tables of each dish from the exact conditional: c customers, the parent's probability,
    and the restaurant's other tables.

    With d = 1/2 the weights of t + 1 and t tables have the ratio
    2 P (2 s + rest + t) (c - t) / (t (2 c - t - 1)). Weights are summed over the
    range around the mode outside which less than 1e-20 of the mass lies.
    """
    c = c.astype(np.float64)
    a = strength / DISCOUNT + rest
    g = 4 * DISCOUNT * parent
    b = g * (c - a) - (2 * c - 1)
    mode = 2 * g * a * c / (-b + np.sqrt(np.maximum(b * b - 4 * (1 - g) * g * a * c, 0)))
    mode = np.clip(mode, 1, c)
    bend = 1 / mode + 1 / np.maximum(c - mode, 0.5) - 1 / (a + mode) - 1 / np.maximum(2 * c - mode - 1, 0.5)
    reach = 10 / np.sqrt(np.maximum(bend, 1e-12)) + 25
    low = np.maximum(1, np.floor(mode - reach))
    n = (np.minimum(c, np.ceil(mode + reach)) - low + 1).astype(np.int64)
    out = np.empty(len(c))
    begin = 0
    ends = np.cumsum(n)
    while begin < len(c):  # some weights at a time, which bounds the memory
        stop = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + 300_000)))
        s = slice(begin, stop)
        m = n[s]
        first = np.cumsum(m) - m
        own = np.repeat(np.arange(len(m)), m)
        t = np.arange(int(m.sum())) - first[own] + low[s][own]
        prev, cc = t - 1, c[s][own]  # the ratio that leads to t
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.log(g[s][own] * (a[s][own] + prev) * (cc - prev) / (prev * (2 * cc - prev - 1)))
        step[first] = 0.0
        w = np.cumsum(step)
        w -= w[first][own]
        w = np.exp(w - np.maximum.reduceat(w, first)[own])
        run = np.cumsum(w)
        before = run[first] - w[first]
        target = before + rng.random(len(m)) * (run[first + m - 1] - before)
        k = np.searchsorted(run, target, "left")
        out[s] = low[s] + np.clip(k - first, 0, m - 1)
        begin = stop
    return out


@dataclass(frozen=True)
class State:
    """What all buckets share: totals of the restaurants, strengths, hot words' totals."""

    hot: np.ndarray            # hashes of the hot words, sorted
    customers: np.ndarray      # C of each common context
    tables: np.ndarray         # T of each common context
    n: int = 0                 # training tokens
    v: int = 0                 # distinct training words
    other_tables: float = 0.0  # T of all other contexts together
    parent_tables: float = 0.0
    strength: float = 10.0
    parent_strength: float = 10.0
    hot_counts: np.ndarray | None = None   # training tokens of each hot word
    hot_tables: np.ndarray | None = None   # its tables in all contexts: its customers in the parent

    @property
    def base(self) -> float:
        return 1.0 / (self.v + 1)

    def parent(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """The parent's probability of words with these customers and tables."""
        return ((customers - DISCOUNT * tables
                 + (self.parent_strength + DISCOUNT * self.parent_tables) * self.base)
                / (self.parent_strength + self.tables.sum() + self.other_tables))


class Sampler:
    """Gibbs sweeps over the training cells of one bucket."""

    def __init__(self, state: State, words: np.ndarray, at: np.ndarray, phi: np.ndarray,
                 c: np.ndarray, rng: np.random.Generator, other_tables: np.ndarray | None = None,
                 seating: np.ndarray | None = None):
        self.s, self.at, self.phi, self.c, self.rng = state, at, phi, c, rng
        self.tables = state.tables if other_tables is None else np.concatenate([state.tables, other_tables])
        self.n_words = len(words)
        place = np.searchsorted(state.hot, words)
        place[place == len(state.hot)] = 0
        self.is_hot = state.hot[place] == words if len(state.hot) else np.zeros(len(words), bool)
        self.hot_place = place
        self.many = np.flatnonzero(c > 1)
        self.t = np.ones(len(c))
        # the tables of the round before; at first a guess
        self.t[self.many] = (np.minimum(c[self.many], 1 + np.sqrt(c[self.many]) / 2) if seating is None
                             else seating)
        self.up = np.ones(self.n_words)   # the words' tables in the parent

    def customers_above(self) -> np.ndarray:
        """Each word's customers in the parent: its tables here, or everywhere for a hot word."""
        out = np.bincount(self.at, weights=self.t, minlength=self.n_words)
        if self.is_hot.any():
            out[self.is_hot] = self.s.hot_tables[self.hot_place[self.is_hot]]
        return out

    def sweep(self) -> np.ndarray:
        """One sweep; returns the parent's probability of each word."""
        s = self.s
        above = self.customers_above()
        self.up = np.minimum(np.maximum(above, 0), 1)
        some = np.flatnonzero(above > 1)
        if len(some):
            self.up[some] = draw_tables(above[some], np.full(len(some), s.base),
                                        np.maximum(s.parent_tables - np.sqrt(above[some]), 0),
                                        s.parent_strength, self.rng)
        parent = s.parent(above, self.up)
        m = self.many
        if len(m):
            self.t[m] = draw_tables(self.c[m], parent[self.at[m]],
                                    np.maximum(self.tables[self.phi[m]] - self.t[m], 0), s.strength, self.rng)
        return parent


def _rng(round_: int, bucket: int) -> np.random.Generator:
    return np.random.default_rng([SEED, round_, bucket])


def _bucket_arrays(r: dict) -> tuple[np.ndarray, ...]:
    """A bucket's words and training cells."""
    x = _Bucket(r).cells()
    seen = x.c > 0
    return x.words, x.at[seen], x.phi[seen], x.c[seen]


# --- exchange of the restaurants' totals ----------------------------------------------------------

# Sums on their way: slices of vectors (negative part), a bucket's other contexts of one part, or (kind
# ``seat``, with a part of its bucket's own below all slices) where a bucket's seating lies.
_SENT = ("part int, bucket int, kind string, file string, places string, keys binary, c binary, t binary")
_SENT_TYPES = (pa.int32(), pa.int32(), *[pa.string()] * 3, *[pa.binary()] * 3)
_SEATS = -(1 << 30)


def _sent(**values) -> pa.RecordBatch:
    names = [x.split()[0] for x in _SENT.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([values.get(n)], k) for n, k in zip(names, _SENT_TYPES)],
                                      names=names)


def _floats(raw) -> np.ndarray:
    return np.frombuffer(raw, np.float64) if raw is not None and len(raw) else np.zeros(0)


def _part_cuts(other: np.ndarray, n_parts: int) -> list[tuple[int, int, int]]:
    """The parts of sorted hashes: number, first, end."""
    if not len(other):
        return []
    part = ((other >> np.uint64(32)) * np.uint64(n_parts) >> np.uint64(32)).astype(np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
    return [(int(part[i]), i, j) for i, j in zip(cuts, cuts[1:])]


def _with_totals(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, np.ndarray, np.ndarray]]:
    """Rows sorted by bucket and part -> each bucket's row, and C and T of its other contexts."""
    head, c, t = None, [], []

    def out() -> tuple[dict, np.ndarray, np.ndarray]:
        return head, np.concatenate([np.zeros(0), *c]), np.concatenate([np.zeros(0), *t])

    for b in batches:
        for r in _each(b):
            if r["part"] is None:
                if head is not None:
                    yield out()
                head, c, t = r, [], []
            else:
                c.append(_floats(r["c"]))
                t.append(_floats(r["t"]))
    if head is not None:
        yield out()


def _seating(r: dict) -> np.ndarray | None:
    """The tables of a bucket's cells of more than one customer, as the round before left them."""
    return None if r["seat"] is None else _loosened(mapped(r["seat"], np.uint8), "<u4").astype(np.float64)


def _sums(work: Callable, sizes: dict[str, int], n_parts: int, first: bool, folder: str):
    """Buckets -> slices of a task's sums of vectors, each bucket's sums for its other contexts
    (by part; with the hashes and the customers the first time), and the file of its seating."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = {k: np.zeros(n) for k, n in sizes.items()}
        _, name = attempt_name()
        for r, _, totals in _with_totals(batches):
            other = _Bucket(r).cells().other
            c, t, seats = work(r, out, totals, len(other))
            file = f"{folder}/{name}-{r['bucket']}-seats"
            with writer(file) as f:
                f.write(_squeezed(seats.astype("<u4")))
            yield _sent(part=_SEATS - r["bucket"], bucket=r["bucket"], kind="seat", file=file)
            for part, i, j in _part_cuts(other, n_parts):
                keys = {"keys": other[i:j].tobytes(), "c": c[i:j].tobytes()} if first else {}
                yield _sent(part=part, bucket=r["bucket"], t=t[i:j].tobytes(), **keys)
        for k, x in out.items():
            for i in range(0, len(x), SLICE):
                if x[i:i + SLICE].any():
                    yield _sent(part=-1 - i // SLICE, kind=k, t=x[i:i + SLICE].tobytes())
    return run


def _totals(folder: str, round_: int, strength: float, customers: bool):
    """Sums sorted by part and bucket -> the vectors' sums, each part's file (the first time: its
    contexts' customers and where every bucket's contexts lie), its terms of the strength's
    conditional, and the totals for each bucket, with the customers if asked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, name = attempt_name()

        def vectors(part: int, held: list[dict]) -> Iterator[pa.RecordBatch]:
            total: dict[str, np.ndarray] = {}
            for r in held:
                x = _floats(r["t"])
                total[r["kind"]] = total[r["kind"]] + x if r["kind"] in total else x
            for kind, x in total.items():
                yield _sent(part=part, kind=kind, t=x.tobytes())

        def contexts(part: int, held: list[dict]) -> Iterator[pa.RecordBatch]:
            head = held.pop(0) if held[0]["bucket"] is None else None
            if head is None:
                keys, at = np.unique(np.concatenate([np.frombuffer(r["keys"], np.uint64) for r in held]),
                                     return_inverse=True)
                c = np.bincount(at, weights=np.concatenate([_floats(r["c"]) for r in held]),
                                minlength=len(keys))
                file = f"{folder}/{name}-{part}"
                with writer(file) as f:
                    f.write(c.tobytes())
                    f.write(at.astype(np.uint32).tobytes())
                places = json.dumps([len(c), len(at)])
            else:
                file, places = head["file"], head["places"]
                n, m = json.loads(places)
                data = mapped(file, np.uint8)
                c, at = np.frombuffer(data, np.float64, n), np.frombuffer(data, np.uint32, m, 8 * n)
            t = np.bincount(at, weights=np.concatenate([_floats(r["t"]) for r in held]), minlength=len(c))
            yield _sent(part=part, kind="part", file=file, places=places)
            yield _sent(part=part, kind="terms", t=np.array(
                [*strength_terms(strength, c, t, _rng(round_, (1 << 41) + part)), t.sum()]).tobytes())
            begin = 0
            for r in held:
                own = at[begin:begin + len(r["t"]) // 8]
                begin += len(own)
                yield _sent(part=part, bucket=r["bucket"], t=t[own].tobytes(),
                            c=c[own].tobytes() if customers else None)

        current, held = None, []
        for b in batches:
            for r in _each(b):
                if r["kind"] == "seat":
                    yield _sent(**{k: r[k] for k in ("part", "bucket", "kind", "file")})
                    continue
                if held and r["part"] != current:
                    yield from (vectors if current < 0 else contexts)(current, held)
                    held = []
                current = r["part"]
                held.append({k: x.to_pybytes() if isinstance(x, pa.Buffer) else x for k, x in r.items()})
        if held:
            yield from (vectors if current < 0 else contexts)(current, held)
    return run


def _collected(totals: DataFrame, sizes: dict[str, int]) -> dict[str, np.ndarray]:
    """The vectors' sums: as many numbers as common contexts and hot words, at most."""
    out = {k: np.zeros(n) for k, n in sizes.items()}
    for r in totals.filter(f"part < 0 AND part > {_SEATS}").select("part", "kind", "t").collect():
        x, i = _floats(r["t"]), (-1 - r["part"]) * SLICE
        out[r["kind"]][i:i + len(x)] = x
    return out


def _digamma(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, np.float64)
    out = np.zeros_like(x)
    for _ in range(6):
        out -= np.where(x < 6, 1 / x, 0)
        x = np.where(x < 6, x + 1, x)
    return out + np.log(x) - 1 / (2 * x) - 1 / (12 * x**2) + 1 / (120 * x**4)


def strength_terms(strength: float, customers: np.ndarray, tables: np.ndarray,
                   rng: np.random.Generator) -> tuple[float, float, int]:
    """What restaurants add to the strength's conditional: log x, tables opened, restaurants."""
    some = tables > 1
    c, t = customers[some], tables[some]
    if not len(c):
        return 0.0, 0.0, 0
    log_x = np.log(np.maximum(rng.beta(strength + 1, np.maximum(c - 1, 1e-9)), 1e-300)).sum()
    k = strength / DISCOUNT
    return log_x, (k * (_digamma(t + k) - _digamma(np.full(len(t), k + 1)))).sum(), len(c)


def resample_strength(strength: float, customers: np.ndarray, tables: np.ndarray,
                      rng: np.random.Generator, others: tuple[float, float, int] = (0.0, 0.0, 0)) -> float:
    """A draw of the strength given the totals of restaurants (prior gamma(1, 0.001)) and the
    terms of others.

    Auxiliary variables: x ~ beta(s + 1, C - 1) for each restaurant; the count of
    tables opened by the strength's share is taken at its mean.
    """
    log_x, opened, n = (a + b for a, b in zip(strength_terms(strength, customers, tables, rng), others))
    if not n:
        return strength
    return float(max(rng.gamma(1 + opened) / (0.001 - log_x), 1e-3))


@dataclass(frozen=True)
class Model:
    state: State
    buckets: DataFrame
    n_buckets: int
    totals: DataFrame          # C and T of the other contexts, for each bucket
    common: np.ndarray         # hashes of the common contexts, sorted
    changes: tuple[float, ...] = ()  # by round, how much the number of tables moved, as a share of it


def _hot_words(rows: DataFrame) -> tuple[np.ndarray, int, np.ndarray]:
    """Hashes of the hot words, the number of buckets, and hashes of the common contexts."""
    one_of = max(1, min(HOT_SAMPLE, rows.count() // SAMPLE_ROWS))
    some = rows.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(one_of)) == 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts, _ in _packs(batches):
            tok, _ = tokens(texts)
            w, n = np.unique(tok, return_counts=True)
            often = np.argsort(n, kind="stable")[-CONTEXTS:]  # the most frequent of a pack
            size = int(pa.compute.sum(pa.compute.binary_length(texts)).as_py() or 0)
            w, n = np.append(w[often].view(np.int64), 0), np.append(n[often], size)
            kind = np.append(np.ones(len(w) - 1, np.int64), 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(kind), pa.array(w), pa.array(n.astype(np.int64)),
                 pa.array(np.append(np.zeros(len(w) - 1, np.int64), len(tok)))],
                names=["kind", "w", "n", "total"])

    # at most 65,535 words times the packs of one sixteenth of the texts before the sums
    found = (arrow_tasks(some, run, "kind long, w long, n long, total long")
             .groupBy("kind", "w").agg(F.sum("n").alias("n"), F.sum("total").alias("total")))
    found = write_table(found, "lm-frequent")
    size = found.filter("kind = 0").first()
    n_buckets = splits(rows.sparkSession, (size["n"] if size else 0) * one_of, BUCKET_BYTES)
    if size is None:
        return np.zeros(0, np.uint64), n_buckets, np.zeros(0, np.uint64)

    def hashes(of: DataFrame) -> np.ndarray:
        return np.sort(np.array([r["w"] for r in of.select("w").collect()], np.int64).view(np.uint64))

    words = found.filter("kind = 1")
    hot = hashes(words.filter(F.col("n") * HOT_PER_BUCKET * n_buckets > size["total"]))
    least, room = None, CONTEXTS
    for r in words.groupBy("n").count().orderBy(F.desc("n")).limit(CONTEXTS).collect():
        room -= r["count"]
        if room < 0:
            break
        least = r["n"]
    common = hashes(words.filter(F.col("n") >= least)) if least else np.zeros(0, np.uint64)
    return hot, n_buckets, common


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> Model:
    """Pack and shuffle the tokens, then sample ``rounds`` rounds; each goes on from the seating that
    the one before left in the bucket's seats file. ``changes`` of the model tells how the number of
    tables moved in each."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.withColumn("train", trains(F.col("doc_id")))
    hot, n_buckets, common = _hot_words(rows)
    n_parts = -(-n_buckets // PART_BUCKETS)
    packed = arrow_tasks(rows, _pack(n_buckets, hot, common), _PACK)
    folder = temporary_path(docs.sparkSession, "lm-files")
    buckets = write_table(arrow_tasks(packed.repartition(n_buckets, "bucket")
                                      .sortWithinPartitions("bucket", "chunk"), _merge(folder), _BUCKET),
                          "lm-buckets")
    zero = np.zeros(CONTEXTS)
    state = State(hot, zero, zero)

    def exchanged(work: Callable, sizes: dict[str, int], totals: DataFrame | None, k: int) -> DataFrame:
        """All buckets' sums of a round, added up and sent back."""
        sent = arrow_tasks(_bucket_rows(buckets, totals, n_buckets),
                           _sums(work, sizes, n_parts, totals is None, folder), _SENT)
        if totals is not None:
            sent = sent.unionByName(totals.filter("kind = 'part'"))
        out = write_table(arrow_tasks(sent.repartition(n_parts, "part").sortWithinPartitions("part", "bucket"),
                                       _totals(folder, k, state.strength, k == rounds), _SENT),
                          "lm-totals")
        if totals is not None:  # nothing reads the round before any more
            drop_table(totals)
        return out

    def terms(totals: DataFrame) -> tuple[tuple[float, float, int], float]:
        """The other contexts' terms of the strength, and their tables: four numbers a part."""
        x = np.array([_floats(r["t"]) for r in totals.filter("kind = 'terms'").select("t").collect()])
        log_x, opened, n, tables = x.sum(axis=0).tolist() if len(x) else [0.0] * 4
        return (log_x, opened, int(n)), tables

    def put(out: dict[str, np.ndarray], x: Sampler, n_other: int, moved: float) -> tuple[np.ndarray, ...]:
        """Add a bucket's seating to the sums; returns C and T of its other contexts and the seating."""
        c = np.bincount(x.phi, weights=x.c, minlength=CONTEXTS + n_other)
        t = np.bincount(x.phi, weights=x.t, minlength=CONTEXTS + n_other)
        out["tables"] += t[:CONTEXTS]
        np.add.at(out["hot_tables"], x.hot_place[x.is_hot],
                  np.bincount(x.at, weights=x.t, minlength=x.n_words)[x.is_hot])
        if "customers" in out:
            out["customers"] += c[:CONTEXTS]
        out["moved"][0] += moved
        return c[CONTEXTS:], t[CONTEXTS:], x.t[x.many]

    def count(r: dict, out: dict[str, np.ndarray], totals: np.ndarray, n_other: int):
        words, at, phi, c = _bucket_arrays(r)
        x = Sampler(state, words, at, phi, c, _rng(0, r["bucket"]))
        per_word = np.bincount(at, weights=c, minlength=len(words))
        out["v"][0] += ((per_word > 0) & ~x.is_hot).sum()
        out["n"][0] += c.sum()
        np.add.at(out["hot_counts"], x.hot_place[x.is_hot], per_word[x.is_hot])
        return put(out, x, n_other, 0.0)

    sizes = {"customers": CONTEXTS, "tables": CONTEXTS, "v": 1, "n": 1, "hot_counts": len(hot),
             "hot_tables": len(hot), "moved": 1}
    totals = exchanged(count, sizes, None, 0)
    got = _collected(totals, sizes)
    v = int(got["v"][0] + (got["hot_counts"] > 0).sum())
    state = State(hot, got["customers"], got["tables"], int(got["n"][0]), v, terms(totals)[1], float(v),
                  hot_counts=got["hot_counts"], hot_tables=got["hot_tables"])

    sizes = {"tables": CONTEXTS, "up": 1, "hot_tables": len(hot), "moved": 1}
    changes: list[float] = []
    for k in range(1, rounds + 1):
        now = state

        def seat(r: dict, out: dict[str, np.ndarray], totals: np.ndarray, n_other: int):
            words, at, phi, c = _bucket_arrays(r)
            x = Sampler(now, words, at, phi, c, _rng(k, r["bucket"]), totals, _seating(r))
            start = x.t.sum()
            for _ in range(SWEEPS):
                x.sweep()
            out["up"][0] += x.up[~x.is_hot].sum()
            return put(out, x, n_other, x.t.sum() - start)

        totals = exchanged(seat, sizes, totals, k)
        got, (others, other_tables) = _collected(totals, sizes), terms(totals)
        rng = _rng(k, 1 << 40)
        changes.append(abs(float(got["moved"][0])) / max(float(got["tables"].sum()) + other_tables, 1.0))
        hot_up = 0.0
        if len(hot) and (got["hot_tables"] > 1).any():
            above = got["hot_tables"][got["hot_tables"] > 1]
            hot_up = draw_tables(above, np.full(len(above), state.base),
                                 np.full(len(above), state.parent_tables), state.parent_strength, rng).sum()
        up = float(got["up"][0] + hot_up)
        state = replace(
            state, tables=got["tables"], other_tables=other_tables, parent_tables=up,
            hot_tables=got["hot_tables"],
            strength=resample_strength(state.strength, state.customers, got["tables"], rng, others),
            parent_strength=resample_strength(state.parent_strength,
                                              np.array([got["tables"].sum() + other_tables]),
                                              np.array([up]), rng))
    return Model(state, buckets, n_buckets, totals, common, tuple(changes))


def _bucket_rows(buckets: DataFrame, totals: DataFrame | None, n_buckets: int) -> DataFrame:
    """A small row per bucket, followed by its other contexts' totals by part."""
    cells = buckets.filter("bucket >= 0").select(
        "bucket", "file", "places", F.lit(None).cast("int").alias("part"),
        F.lit(None).cast("binary").alias("c"), F.lit(None).cast("binary").alias("t"))
    if totals is None:  # a task takes about one
        return cells.withColumn("seat", F.lit(None).cast("string")).repartition(n_buckets)
    seats = totals.filter("kind = 'seat'").select("bucket", F.col("file").alias("seat"))
    cells = cells.join(seats, "bucket", "left")
    back = totals.filter("part >= 0 AND bucket IS NOT NULL").select(
        *[c for c in cells.columns if c != "seat"], F.lit(None).cast("string").alias("seat"))
    return cells.unionByName(back).repartition(n_buckets, "bucket").sortWithinPartitions("bucket", "part")


def score(model: Model) -> DataFrame:
    """One row per document of the fitted table: ``doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score``."""
    s = model.state
    fine = "chunk long, doc binary, base binary, score binary, known binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, other_customers, other_tables in _with_totals(batches):
            file = _Bucket(r)
            cells, blobs = file.cells(), file.blobs()
            seen = np.flatnonzero(cells.c > 0)
            x = Sampler(s, cells.words, cells.at[seen], cells.phi[seen], cells.c[seen],
                        _rng(1 << 20, r["bucket"]), other_tables, _seating(r))
            total = np.zeros(len(cells.c))
            left = s.strength + DISCOUNT * x.tables
            room = s.strength + np.concatenate([s.customers, other_customers])
            for _ in range(SAMPLES):
                parent = x.sweep()
                own = np.zeros(len(cells.c))
                own[seen] = cells.c[seen] - DISCOUNT * x.t
                total += (own + left[cells.phi] * parent[cells.at]) / room[cells.phi]
            log_p = np.log10(total / SAMPLES)
            count = np.bincount(cells.at, weights=cells.c, minlength=len(cells.words))
            if x.is_hot.any():
                count[x.is_hot] = s.hot_counts[x.hot_place[x.is_hot]]
            base, known = np.log10(count + 1), (count > 0).astype(np.float64)
            for blob in blobs:
                c, n = blob["cell"], _counts(blob)
                docs, at = np.unique(blob["doc"], return_inverse=True)
                sums = [np.bincount(at, weights=n * x_, minlength=len(docs))
                        for x_ in (base[cells.at[c]], log_p[c], known[cells.at[c]])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([blob["chunk"]], pa.int64()),
                     *[pa.array([y.tobytes()], pa.binary()) for y in (
                         docs, sums[0], sums[1], sums[2].astype(np.uint32))]],
                    names=["chunk", "doc", "base", "score", "known"])

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by chunk, the documents' row of each chunk first."""
        norm = np.log10(s.n + s.v + 1)
        ids = None

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, mask=~valid), pa.array(n), pa.array(known.astype(np.int64)),
                 pa.array(np.full(len(ids), s.n)), pa.array(base - n * norm), pa.array(got)],
                names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

        for b in batches:
            for r in _each(b):
                if r["ids"] is not None:
                    if ids is not None:
                        yield out()
                    ids, n = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["n"], np.uint32).astype(np.int64)
                    valid = np.unpackbits(np.frombuffer(r["valid"], np.uint8))[:len(ids)].astype(bool)
                    base, got, known = np.zeros(len(ids)), np.zeros(len(ids)), np.zeros(len(ids))
                else:
                    doc = np.frombuffer(r["doc"], np.uint16)
                    base[doc] += np.frombuffer(r["base"], np.float64)
                    got[doc] += np.frombuffer(r["score"], np.float64)
                    known[doc] += np.frombuffer(r["known"], np.uint32)
        if ids is not None:
            yield out()

    parts = arrow_tasks(_bucket_rows(model.buckets, model.totals, model.n_buckets), run, fine)
    heads = model.buckets.filter("bucket < 0").select("chunk", "ids", "n", "valid")
    both = parts.unionByName(heads, allowMissingColumns=True)
    scored = arrow_tasks(both.repartition("chunk")
                         .sortWithinPartitions("chunk", F.col("ids").isNull()), close,
                         "doc_id long, n_tokens long, n_known long, train_tokens long, "
                         "base_score double, score double")
    return scored.select("doc_id", (~trains(F.col("doc_id"))).alias("held_out"), "n_tokens",
                         "n_known", "train_tokens", "base_score", "score")
