"""Helpers shared by the operators: names, row keys, text buffers and word hashes."""

from __future__ import annotations

import contextlib
import ctypes
import itertools
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.session import let_workers_import

# Fixed values of the word definition ``[^\x20\x09-\x0D]+``.
WHITESPACE = " \t\n\x0b\x0c\r"

#: Text bytes handled at once inside a task, so that numpy temporaries stay bounded.
CHUNK_BYTES = 1 << 20


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names close to ``names`` that ``df`` does not use (case-insensitively)."""
    used = {c.lower() for c in df.columns}
    out = []
    for n in names:
        out.append(next(x for x in itertools.chain([n], (f"{n}_{i}" for i in itertools.count(1)))
                        if x.lower() not in used))
        used.add(out[-1].lower())
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """The words of a text column as an array; null text has none."""
    spaced = F.translate(F.coalesce(text, F.lit("")), WHITESPACE, " " * len(WHITESPACE))
    return F.array_remove(F.split(spaced, " ", -1), "")


def n_words_of(text: Column) -> Column:
    """Number of words, as a long."""
    return F.size(words_of(text)).cast("long")


def byte_chunks(col: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Split a string column into runs of rows of about ``CHUNK_BYTES``.

    Yields ``(first_row, bytes, offsets)``; ``bytes`` is a read-only uint8 view
    and ``offsets`` (rows + 1) starts at 0. Null rows have no bytes. One text is
    never split, so a single very long text makes one large chunk.
    """
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
    if isinstance(col, pa.ChunkedArray):  # no rows
        return
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    n = len(col)
    if not n:
        return
    _, off_buf, data_buf = col.buffers()
    off = np.frombuffer(off_buf, np.int64)[col.offset: col.offset + n + 1]
    data = np.frombuffer(data_buf, np.uint8) if data_buf is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + CHUNK_BYTES, "right")) - 1)
        j = min(j, n)
        yield i, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


# Lower-casing A-Z and finding white space are byte tables: every byte of a
# multi-byte code point is above 0x7f, so bytes and code points agree.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)  # splitmix64, fixed values
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD1342543DE82EF95)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POW: dict[str, np.ndarray] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, a bijection on 64-bit integers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
        return x ^ (x >> np.uint64(31))


_BYTE_CODE = mix64((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _GOLD)


def _powers(name: str, base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the next chunk."""
    have = _POW.get(name)
    if have is None or len(have) < n:
        with np.errstate(over="ignore"):
            have = np.cumprod(np.concatenate([np.ones(1, np.uint64),
                                              np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)]))
        if n <= 4 * CHUNK_BYTES:
            _POW[name] = have
    return have[:n]


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True
                ) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of a chunk and the row of each word.

    A polynomial hash of random byte codes read off one running sum over the
    chunk; a word's hash depends on its bytes alone. Words never span rows.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if lower:
        data = _LOWER[data]
    word = ~_SPACE[data]
    starts_row = np.zeros(n + 1, bool)
    starts_row[offsets] = True
    prev = np.concatenate([[False], word[:-1]])
    s = np.flatnonzero(word & (~prev | starts_row[:n]))
    nxt = np.concatenate([word[1:], [False]])
    e = np.flatnonzero(word & (~nxt | starts_row[1:])) + 1
    with np.errstate(over="ignore"):
        run = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_CODE[data] * _powers("up", _BASE, n), out=run[1:])
        h = (run[e] - run[s]) * _powers("down", _BASE_INV, n)[s]
        h = mix64(h + (e - s).astype(np.uint64) * _GOLD)
    return h, np.searchsorted(offsets, s, "right") - 1


def splits(spark: SparkSession, nbytes: int, per_task: int, least: int = 1) -> int:
    """Partitions for ``nbytes`` of data, at least the session's shuffle partitions."""
    conf = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, conf, -(-int(nbytes) // per_task))


_KEPT: dict[tuple, object] = {}


def worker_kept(key: tuple, make: Callable[[], object]) -> object:
    """What this worker keeps from task to task under ``key``, made when it is missing."""
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


def release_others(key: tuple | None) -> None:
    """Drop what this worker keeps under any other key: workers live on after their stage, and the
    next operator's tasks need the memory."""
    others = [k for k in _KEPT if k != key]
    for k in others:
        del _KEPT[k]
    if others:
        release_freed()


def release_freed() -> None:
    """Give freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    # freed blocks stay with the C library otherwise; other libraries than glibc have no such call
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def arrow_tasks(df: DataFrame, fn, schema: str, keeps: tuple | None = None) -> DataFrame:
    """``mapInArrow`` whose function gets tables and yields record batches; ``keeps`` is the key of
    what it takes from :func:`worker_kept`."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_others(keeps)
        yield from fn(batches)
        if keeps:  # the worker stays, with what it keeps, when other stages need the memory
            release_freed()

    let_workers_import(df.sparkSession)
    return df.mapInArrow(run, schema)
