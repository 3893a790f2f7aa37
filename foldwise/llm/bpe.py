"""Byte-level BPE by a hierarchical-bitmap rank queue, with decoding.

Symbols of all new pre-tokens of a batch lie in one linked list over their
bytes (links end at pre-token borders). Every adjacent pair that the vocabulary
merges waits in the bucket of its merge rank, as the position of its left
symbol. A bitmap of three levels marks the buckets that are not empty;
find-first-set from the top gives the next rank. The whole bucket is taken at
once: entries whose pair has changed since are stale and skipped, overlapping
pairs of equal symbols are resolved from the left, and the pairs that the merges
make are pushed to their buckets. A pre-token of n bytes costs n pushes and
merges, so very long ones stay linear.

A pair made by a merge of rank r ranks above r whenever every vocabulary entry
is reachable by merges, as in vocabularies that were trained; then taking a
bucket at once equals taking its entries one by one.

Defined results: null and empty texts have no ids; rows with a null id are encoded like others;
repeated rows are encoded each; very long texts and pre-tokens are encoded whole; equal ranks at
overlapping places go to the left one; an empty table gives an empty table; extra columns, whatever
their names, are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import arrow_tasks, worker_kept
from foldwise.llm.units import SPACE, as_ids, encoded

_NONE = np.int32(2**31 - 1)


def _explicit(pattern: str) -> str:
    r"""The pattern with ``\s`` and ``\S`` spelled out (libraries differ on a few controls)."""
    return (pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\S", f"[^{SPACE}]")
            .replace(r"\s", f"[{SPACE}]"))


class RankQueue:
    """Buckets of positions by rank under a three-level bitmap (64 bits a word).

    Entries above the current span of 4096 ranks (one word of the middle level)
    wait together and are dealt to their buckets when that span is reached.
    """

    SPAN = 4096

    def __init__(self, n_ranks: int):
        self.low = [0] * (n_ranks // 64 + 1)
        self.mid = [0] * (n_ranks // self.SPAN + 1)
        self.top = 0
        self.buckets: dict[int, list[np.ndarray]] = {}
        self.end = self.SPAN
        self.far: list[tuple[np.ndarray, np.ndarray]] = []

    def push(self, positions: np.ndarray, ranks: np.ndarray) -> None:
        """Put each position into the bucket of its rank; ``_NONE`` is no rank."""
        near = ranks < self.end
        n_near = int(np.count_nonzero(near))
        if n_near < len(ranks):
            wait = (ranks >= self.end) & (ranks != _NONE)
            if wait.any():
                self.far.append((positions[wait], ranks[wait]))
            positions, ranks = positions[near], ranks[near]
        if not n_near:
            return
        if len(ranks) > 1:
            order = np.argsort(ranks, kind="stable")
            positions, ranks = positions[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            groups = zip(ranks[np.concatenate([[0], cuts])].tolist(), np.split(positions, cuts))
        else:
            groups = ((int(ranks[0]), positions),)
        for r, at in groups:
            bucket = self.buckets.get(r)
            if bucket is None:
                self.buckets[r] = [at]
                self.low[r >> 6] |= 1 << (r & 63)
                self.mid[r >> 12] |= 1 << ((r >> 6) & 63)
                self.top |= 1 << (r >> 12)
            else:
                bucket.append(at)

    def pop(self) -> tuple[int, np.ndarray] | None:
        """The lowest rank with a bucket, and that bucket's positions in order."""
        while not self.top:
            if not self.far:
                return None
            positions = np.concatenate([p for p, _ in self.far])
            ranks = np.concatenate([r for _, r in self.far])
            self.end = (int(ranks.min()) // self.SPAN + 1) * self.SPAN
            self.far = []
            self.push(positions, ranks)
        a = (self.top & -self.top).bit_length() - 1
        b = a << 6 | (self.mid[a] & -self.mid[a]).bit_length() - 1
        r = b << 6 | (self.low[b] & -self.low[b]).bit_length() - 1
        self.low[b] &= self.low[b] - 1
        if not self.low[b]:
            self.mid[a] &= self.mid[a] - 1
            if not self.mid[a]:
                self.top &= self.top - 1
        bucket = self.buckets.pop(r)
        return r, bucket[0] if len(bucket) == 1 else np.unique(np.concatenate(bucket))


class Bpe:
    """Encoder and decoder of one rank file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.split = regex.compile(_explicit(pattern)).findall
        self.n = max(ranks.values()) + 1
        self.tokens = [b""] * self.n
        for t, r in ranks.items():
            self.tokens[r] = t
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for t, r in ranks.items():
            for i in range(1, len(t)):
                a, b = ranks.get(t[:i]), ranks.get(t[i:])
                if a is not None and b is not None:
                    pairs[a * self.n + b] = r
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int32)

    @staticmethod
    def load(path: str, pattern: str) -> Bpe:
        fs, p = pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)
        with fs.open_input_stream(p) as f:
            lines = f.read().splitlines()
        return Bpe({base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, lines))},
                   pattern)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge ranks of symbol pairs, ``_NONE`` where they do not merge."""
        key = a.astype(np.int64) * self.n + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], _NONE)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece (little-endian unsigned 32-bit)."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = np.cumsum(sizes)
        n = int(ends[-1]) if len(ends) else 0
        if not n:
            return [b""] * len(pieces)
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        ids = self.byte_ids[raw]
        right = np.arange(1, n + 1, dtype=np.int32)
        right[ends[sizes > 0] - 1] = -1
        left = np.arange(-1, n - 1, dtype=np.int32)
        left[(ends - sizes)[sizes > 0]] = -1
        pair = np.full(n, _NONE, np.int32)
        has = np.flatnonzero(right >= 0).astype(np.int32)
        # adjacent bytes: one look-up per pair of byte values
        grid = self.rank(np.repeat(self.byte_ids, 256), np.tile(self.byte_ids, 256)).reshape(256, 256)
        pair[has] = grid[raw[has], raw[has + 1]]
        alive = np.ones(n, bool)
        queue = RankQueue(self.n)
        queue.push(has, pair[has])
        while (got := queue.pop()) is not None:
            r, at = got
            at = at[pair[at] == r]  # others are stale
            if len(at) > 1:
                over = at[1:] == right[at[:-1]]
                if over.any():  # a run of equal symbols: every second pair, from the left
                    k = np.arange(len(at))
                    begins = np.concatenate([[True], ~over])
                    at = at[(k - np.maximum.accumulate(np.where(begins, k, 0))) % 2 == 0]
            if not len(at):
                continue
            gone = right[at]
            after = right[gone]
            ids[at] = r
            right[at] = after
            alive[gone] = False
            pair[gone] = _NONE
            pair[at] = _NONE
            inner = after >= 0
            left[after[inner]] = at[inner]
            before = left[at]
            a = np.concatenate([at[inner], before[before >= 0]])
            if len(a):
                if len(at) > 1:
                    a = np.unique(a)
                new = self.rank(ids[a], ids[right[a]])
                pair[a] = new
                queue.push(a, new)
        left_over = np.flatnonzero(alive)
        flat = ids[left_over].astype("<u4").tobytes()
        cut = (4 * np.searchsorted(left_over, ends)).tolist()
        return [flat[i:j] for i, j in zip([0, *cut[:-1]], cut)]

    def encode(self, units: list[str]) -> list[bytes]:
        """The ids of each unit; a match of the pattern that several units share is merged once."""
        more: dict[int, list[str]] = {}
        index: dict[str, int] = {}
        for k, u in enumerate(units):
            if (u[1:] if u[0] == " " else u).isalpha():  # letters alone are one match
                index.setdefault(u, len(index))
            else:
                more[k] = self.split(u)
                for x in more[k]:
                    index.setdefault(x, len(index))
        got = self.merge([x.encode() for x in index])
        return [b"".join([got[index[x]] for x in more[k]]) if k in more else got[index[u]]
                for k, u in enumerate(units)]

    def decode(self, raw: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, as_ids(raw).tolist()))


def loaded(path: str, pattern: str) -> tuple[Bpe, dict]:
    """This worker's encoder and its table of units."""
    return worker_kept(("bpe", path, pattern), lambda: (Bpe.load(path, pattern), {}))


def encode(docs: DataFrame, ranks: str, pattern: str, doc_id: str = "doc_id",
           text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids`` (ids as little-endian unsigned 32-bit binary)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, kept = loaded(ranks, pattern)
        for b in batches:
            for at, ids in encoded(b.column(1), bpe.encode, kept):
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, len(ids)),
                     pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "n_tokens", "ids"])

    return arrow_tasks(docs.select(F.col(doc_id).cast("long"), text), run,
                       "doc_id long, n_tokens long, ids binary", ("bpe", ranks, pattern))


def decode(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """The text bytes of ``encode``'s rows: ``doc_id, bytes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, _ = loaded(ranks, pattern)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([bpe.decode(x.as_py() or b"") for x in b.column(1)],
                                       pa.binary())], names=["doc_id", "bytes"])

    return arrow_tasks(encoded.select("doc_id", "ids"), run, "doc_id long, bytes binary", ("bpe", ranks, pattern))


def round_trip(docs: DataFrame, ranks: str, pattern: str, doc_id: str = "doc_id",
               text: str = "text", with_ids: bool = False) -> DataFrame:
    """Encode, decode the ids again, and digest both: ``doc_id, n_tokens, ids_sha256,
    decoded_sha256`` and, if asked for, ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, kept = loaded(ranks, pattern)
        for b in batches:
            for at, ids in encoded(b.column(1), bpe.encode, kept):
                n = [len(raw) // 4 for raw in ids]
                sha = [hashlib.sha256(raw).hexdigest() for raw in ids]
                back = [hashlib.sha256(bpe.decode(raw)).hexdigest() for raw in ids]
                cols = [b.column(0).slice(at, len(ids)), pa.array(n, pa.int64()), pa.array(sha),
                        pa.array(back)]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    cols.append(pa.array(ids, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return arrow_tasks(docs.select(F.col(doc_id).cast("long"), text), run,
                       schema + (", ids binary" if with_ids else ""), ("bpe", ranks, pattern))
