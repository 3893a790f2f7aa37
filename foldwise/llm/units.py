"""Splitting text into pieces that byte-level BPE encodes independently, and caching them.

The public vocabularies' pattern never lets a match cross the border between
white space and other characters, except for one space in front of a word. So a
text falls into *units* (an optional space and a run of other characters, or a
run of white space) whose encodings can be joined. A run of letters ends a match
too, so the punctuation behind one begins a unit of its own. Units repeat much
more often than they are new. A batch's units are cut and hashed as arrays over
the bytes of the text; every distinct one is looked up once in the task's bounded
table (sorted arrays of hashes), new ones are encoded all at once, and the ids of
the texts are gathered.

Units are told apart by two independent 64-bit hashes. Texts with white space
outside ASCII are cut by the regular expression instead; the units are the same.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from foldwise.llm.common import _GOLD, _SPACE, _powers, byte_chunks, mix64

#: Unicode's White_Space characters, fixed by the pattern's ``\s``.
SPACE = "\t-\r \x85\xa0  -     　"
UNIT = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: The same characters' UTF-8 forms, but for ASCII.
_WIDE_SPACE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|"
                         rb"\xe2\x81\x9f|\xe3\x80\x80")

#: Text bytes encoded at once in a task; units whose ids are kept from batch to batch.
BATCH_BYTES = 8 << 20
KEPT_UNITS = 1_200_000

#: Gets new units, returns the ids of each as little-endian unsigned 32-bit bytes.
Encode = Callable[[list[str]], list[bytes]]

_BASES = (np.uint64(0xD1342543DE82EF95), np.uint64(0x9FB21C651E98DF25))  # odd, else arbitrary
_INVERSES = tuple(np.uint64(pow(int(b), -1, 1 << 64)) for b in _BASES)
#: Bytes of punctuation that often follows a word, and of ASCII letters.
_MARK, _LETTER = np.zeros(256, bool), np.zeros(256, bool)
_MARK[list(b",.;:!?")] = True
_LETTER[65:91] = _LETTER[97:123] = True
_CODE = mix64((np.arange(256, dtype=np.uint64) + np.uint64(77)) * _GOLD)


def unit_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the units of a chunk's texts start; they cover the bytes without gaps.

    Only ASCII white space counts as such here.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    white = _SPACE[data]
    edge = np.zeros(n + 1, bool)   # a text starts here
    edge[offsets] = True
    begins = np.concatenate([[True], white[1:] != white[:-1]]) | edge[:n]
    at = np.flatnonzero(begins)
    mark = np.zeros(n, bool)
    mark[at] = True
    # a word takes the space in front of it; other last white space stands alone
    word = at[~white[at] & ~edge[at]]
    mark[word - 1] = True
    mark[word[data[word - 1] == 32]] = False
    return np.flatnonzero(mark)


def _hashes(data: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit hashes of each unit."""
    ends = np.append(starts[1:], len(data))
    out = []
    code = _CODE[data]
    with np.errstate(over="ignore"):
        for k, (base, inverse) in enumerate(zip(_BASES, _INVERSES)):
            run = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(code * _powers(f"unit{k}", base, len(data)), out=run[1:])
            h = (run[ends] - run[starts]) * _powers(f"unit-{k}", inverse, len(data))[starts]
            out.append(mix64(h + (ends - starts).astype(np.uint64) * _GOLD))
    return out


def _marks_apart(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """``starts`` and the marks behind a Latin letter: letters and what follows them are different
    matches of the pattern, and the word without its mark is often known."""
    at = np.flatnonzero(_MARK[data])
    at = at[at > 0]
    last = data[at - 1]
    wide = (data[np.maximum(at - 2, 0)] == 0xC3) & (last >= 0x80) & (last != 0x97) & (last != 0xB7)
    at = at[_LETTER[last] | wide]
    cut = np.zeros(len(data), bool)
    cut[starts] = True
    cut[at] = True
    return np.flatnonzero(cut)


def _looked_up(first: np.ndarray, second: np.ndarray, text_of: Callable[[np.ndarray], list[bytes]], encode: Encode,
               kept: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, and where in them each unit's begin and how many they are, for the units of sorted distinct
    first hashes; the table gets the new ones, and shrinks to these units when it is full."""
    if not kept:
        kept.update(first=first[:0], second=second[:0], begin=np.zeros(0, np.int64), size=np.zeros(0, np.int64),
                    ids=np.zeros(0, "<u4"))
    n = len(kept["first"])
    at = np.searchsorted(kept["first"], first)
    known = np.zeros(len(first), bool)
    if n:
        known = kept["first"][np.minimum(at, n - 1)] == first
    if (kept["second"][at[known]] != second[known]).any():
        raise RuntimeError("two units share a hash")
    begin, size, ids = np.empty(len(first), np.int64), np.empty(len(first), np.int64), kept["ids"]
    begin[known], size[known] = kept["begin"][at[known]], kept["size"][at[known]]
    if known.all():
        return ids, begin, size
    new = np.flatnonzero(~known)
    collects = gc.isenabled()
    gc.disable()  # many small objects and no cycles: collections would only walk them
    try:
        fresh = encode([u.decode() for u in text_of(new)])
        size[new] = np.fromiter(map(len, fresh), np.int64, len(fresh)) // 4
        ids = np.concatenate([ids, np.frombuffer(b"".join(fresh), "<u4")])
    finally:
        if collects:
            gc.enable()
    begin[new] = len(kept["ids"]) + np.cumsum(size[new]) - size[new]
    if n + len(new) > KEPT_UNITS:
        ends = np.cumsum(size)
        kept.update(first=first, second=second, begin=ends - size, size=size, ids=_taken(ids, begin, size))
    else:
        for name, values in (("first", first), ("second", second), ("begin", begin), ("size", size)):
            kept[name] = np.insert(kept[name], at[new], values[new])
        kept["ids"] = ids
    return ids, begin, size


def _taken(ids: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs of ``size`` ids from ``begin`` on, one behind the other."""
    ends = np.cumsum(size)
    return ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - size), size)]


def _plain(text: bytes, encode: Encode, kept: dict[str, np.ndarray]) -> bytes:
    sizes = [len(u.encode()) for u in UNIT.findall(text.decode())]
    data = np.frombuffer(text, np.uint8)
    cut = _marks_apart(data, np.cumsum([0, *sizes[:-1]]))
    return next(_gathered([(data, np.array([0, len(data)]))], [cut], encode, kept))


def _gathered(pieces: list[tuple[np.ndarray, np.ndarray]], cut: list[np.ndarray], encode: Encode,
              kept: dict[str, np.ndarray]) -> Iterator[bytes]:
    """The ids of each text of some chunks (bytes and offsets), whose units start at ``cut``."""
    hashes = [_hashes(data, s) for (data, _), s in zip(pieces, cut)]
    first, second = (np.concatenate([h[k] for h in hashes]) for k in range(2))
    order = np.argsort(first)
    new = np.concatenate([[True], first[order[1:]] != first[order[:-1]]]) if len(order) else np.zeros(0, bool)
    at = np.empty(len(order), np.int64)
    at[order] = np.cumsum(new) - 1
    where = order[new]
    if (second != second[where][at]).any():
        raise RuntimeError("two units share a hash")
    border = np.cumsum([0, *map(len, cut)])

    def text_of(some: np.ndarray) -> list[bytes]:
        places = where[some]
        by_place = np.argsort(places)  # chunk by chunk
        places = places[by_place]
        units: list[bytes] = []
        for k, (data, _) in enumerate(pieces):
            own = places[slice(*np.searchsorted(places, border[k:k + 2]))] - border[k]
            raw, s = data.tobytes(), cut[k]
            ends = np.append(s[1:], len(data))
            units += [raw[i:j] for i, j in zip(s[own].tolist(), ends[own].tolist())]
        back = np.empty(len(some), np.int64)
        back[by_place] = np.arange(len(some))
        return [units[i] for i in back.tolist()]

    ids, begin, size = _looked_up(first[where], second[where], text_of, encode, kept)
    for k, (_, off) in enumerate(pieces):
        t = at[border[k]:border[k + 1]]
        ends = np.concatenate([[0], np.cumsum(size[t])])
        rows = (4 * ends[np.searchsorted(cut[k], off)]).tolist()
        raw = _taken(ids, begin[t], size[t]).tobytes()
        for i, j in zip(rows, rows[1:]):
            yield raw[i:j]


def encoded(texts: pa.Array, encode: Encode, kept: dict[str, np.ndarray]
            ) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of rows: the first row and the ids of each text; null is empty. ``kept`` is the
    task's table of units (at first empty) and is updated."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    start = size = 0

    def out() -> tuple[int, list[bytes]]:
        plain: dict[int, bytes] = {}
        row, pieces = 0, []
        for data, off in held:
            raw = data.tobytes()
            if _WIDE_SPACE.search(raw):
                keep = np.ones(len(data), bool)
                sizes = np.diff(off)
                for i in range(len(sizes)):
                    if _WIDE_SPACE.search(raw, off[i], off[i + 1]):
                        plain[row + i] = _plain(raw[off[i]:off[i + 1]], encode, kept)
                        keep[off[i]:off[i + 1]] = False
                        sizes[i] = 0
                data, off = data[keep], np.concatenate([[0], np.cumsum(sizes)])
            pieces.append((data, off))
            row += len(off) - 1
        cut = [_marks_apart(data, unit_starts(data, off)) for data, off in pieces]
        ids = list(_gathered(pieces, cut, encode, kept))
        for i, x in plain.items():
            ids[i] = x
        return start, ids

    for at, data, off in byte_chunks(texts):
        if held and size + len(data) > BATCH_BYTES:
            yield out()
            held, start, size = [], at, 0
        held.append((data, off))
        size += len(data)
    if held:
        yield out()


def as_ids(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u4")

