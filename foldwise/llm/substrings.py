"""Substring dedup by level-wise doubling: passages repeated word by word are removed.

A window of ``window`` consecutive words of a document is repeated if its word sequence starts
anywhere else, in the same document or another. The operator halves ``window`` until it is short
(35 -> 18 -> 9), asks which windows of the least length occur twice, and then doubles: a window
of the next length is a candidate only if both halves it is made of (its first and its last
words of the length before) are repeated. It stops when no candidate survives or the windows
have their full length. Windows longer than ``window`` need not be asked: all their words are
covered already. Every word under a repeated window is removed; windows are judged on the input.

Windows are compared by hashes of their words' hashes. The short levels are filters that never
lose a repeat; the last compares about 100 bits of two independent hashes.

Defined results: null, empty and white-space texts have no words and keep the empty text; a text
shorter than the window keeps all its words; very long texts are handled whole (a text is never
cut; windows cross the borders of memory chunks); repeated rows, null ids and equal ids are rows of
their own, so a passage in two rows with one id is repeated; overlapping and touching windows merge
to one span; an empty table gives no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import _GOLD, _SPACE, _powers, byte_chunks, mix64
from foldwise.llm.packs import Exchange, distinct, write_packs
from foldwise.llm.units import _BASES, _CODE, _INVERSES

#: Words of a window.
WINDOW = 35
#: The doubling starts at a length of at most so many words.
SEED_WORDS = 12


def lengths(window: int) -> list[int]:
    """The lengths of the levels, each at most twice the one before, the last ``window``."""
    out = [window]
    while out[0] > SEED_WORDS:
        out.insert(0, -(-out[0] // 2))
    return out


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Where the words of a chunk begin and end, and two 64-bit hashes of each."""
    n = len(data)
    word = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    s = np.flatnonzero(word & (np.concatenate([[True], ~word[:-1]]) | edge[:n]))
    e = np.flatnonzero(word & (np.concatenate([~word[1:], [True]]) | edge[1:])) + 1
    codes, hashes = _CODE[data], []
    with np.errstate(over="ignore"):
        for k, (base, inverse) in enumerate(zip(_BASES, _INVERSES)):
            run = np.zeros(n + 1, np.uint64)
            np.cumsum(codes * _powers(f"unit{k}", base, n), out=run[1:])
            h = (run[e] - run[s]) * _powers(f"unit-{k}", inverse, n)[s]
            hashes.append(mix64(h + (e - s).astype(np.uint64) * _GOLD))
    return s, e, hashes


def load(batch: pa.RecordBatch) -> dict:
    """A pack's texts as chunks and its words' places, rows and hashes."""
    chunks, rows, hashes = [], [np.zeros(0, np.int64)], [[np.zeros(0, np.uint64)] for _ in _BASES]
    for at, data, off in byte_chunks(batch.column(1)):
        if len(data):
            s, e, h = _words(data, off)
        else:
            s = e = np.zeros(0, np.int64)
            h = [np.zeros(0, np.uint64)] * len(_BASES)
        chunks.append((data, off, s, e))
        rows.append(at + np.searchsorted(off, s, "right") - 1)
        for k, x in enumerate(h):
            hashes[k].append(x)
    rows = np.concatenate(rows)
    return {"n": len(rows), "ids": batch.column(0), "chunks": chunks, "row": rows,
            "hashes": [np.concatenate(h) for h in hashes]}


def _window_hashes(words: np.ndarray, k: int, at: np.ndarray, length: int) -> np.ndarray:
    n = len(words)
    with np.errstate(over="ignore"):
        run = np.zeros(n + 1, np.uint64)
        np.cumsum(words * _powers(f"unit{k}", _BASES[k], n), out=run[1:])
        return mix64((run[at + length] - run[at]) * _powers(f"unit-{k}", _INVERSES[k], n)[at])


def level(length: int, before: int | None, exact: bool):
    """The candidates of a level: windows of ``length`` words whose first and last ``before``
    words survived."""

    def candidates(a: dict, survivors: np.ndarray | None):
        n = a["n"]
        if survivors is None:
            at = np.arange(max(0, n - length + 1))
        else:
            at = np.flatnonzero(survivors)
            at = at[at + length <= n]
            at = at[survivors[at + length - before]]
        at = at[a["row"][at] == a["row"][at + length - 1]]
        h = [_window_hashes(a["hashes"][k], k, at, length) for k in range(2 if exact else 1)]
        return at, distinct(*h)

    candidates.exact = exact
    return candidates


def _covered(n: int, starts: np.ndarray, length: int) -> np.ndarray:
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + length, -1)
    return np.cumsum(step[:n]) > 0


def _runs(flag: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the runs of set flags, cut where the row changes."""
    if not len(flag):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.concatenate([[True], (flag[1:] != flag[:-1]) | (row[1:] != row[:-1])])
    at = np.flatnonzero(new)
    ends = np.append(at[1:], len(flag))
    return at[flag[at]], ends[flag[at]]


def _kept_texts(a: dict, keep: np.ndarray) -> list[bytes]:
    """Each text's kept words, one space between two."""
    out, first = [], 0
    for data, off, s, e in a["chunks"]:
        k = keep[first:first + len(s)]
        first += len(s)
        size = np.zeros(len(data) + 2, np.int64)
        np.add.at(size, s[k], 1)
        np.add.at(size, e[k] + 1, -1)  # the byte behind a kept word becomes its space
        mask = np.cumsum(size[:len(data) + 1]) > 0
        buf = np.append(data, np.uint8(32))
        buf[e[k]] = 32
        # a word that ends its text has no byte of its own behind it
        last = np.isin(e[k], off)
        own = e[k][last & (e[k] < len(data))]
        starts = np.zeros(len(data) + 1, bool)
        starts[s[k]] = True
        shared = own[starts[own]]  # the next text begins there with a kept word
        buf[shared] = data[shared]
        alone = own[~starts[own]]
        mask[alone] = False
        mask[len(data)] = False
        raw = buf[mask].tobytes()
        ends = np.concatenate([[0], np.cumsum(mask[:len(data)])])[off].tolist()
        out += [raw[i:j].rstrip(b" ") for i, j in zip(ends, ends[1:])]
    return out


def deduplicate(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, ``n_words``, ``n_removed``, ``removed`` (spans of word
    numbers, end exclusive) and ``kept_text`` (the words left, one space between two)."""
    if window < 1:
        raise ValueError("a window has at least one word")
    id_type = dict(docs.dtypes)[id_col]
    packs = write_packs(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text")
    ex = Exchange(packs, load, 2)
    steps = lengths(window)
    left = 1
    for before, length in zip([None, *steps], steps):
        if not left:
            break
        left = ex.add(level(length, before, length == window))
    whole = len(ex.levels) == len(steps)

    def use(packs_of_task):
        for a, _, survivors in packs_of_task:
            row, n_docs = a["row"], len(a["ids"])
            cov = (_covered(a["n"], np.flatnonzero(survivors), window) if whole
                   else np.zeros(a["n"], bool))
            n_words = np.bincount(row, minlength=n_docs)
            first = np.cumsum(n_words) - n_words
            i, j = _runs(cov, row)
            spans = pa.StructArray.from_arrays([pa.array(i - first[row[i]] if len(i) else i),
                                                pa.array(j - first[row[i]] if len(i) else j)], ["start", "end"])
            ends = np.concatenate([[0], np.cumsum(np.bincount(row[i] if len(i) else i, minlength=n_docs))])
            texts = _kept_texts(a, ~cov)
            yield pa.RecordBatch.from_arrays(
                [a["ids"], pa.array(n_words.astype(np.int64)),
                 pa.array(np.bincount(row[cov], minlength=n_docs).astype(np.int64)),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spans),
                 pa.array(texts, pa.binary()).cast(pa.string())],
                [id_col, "n_words", "n_removed", "removed", "kept_text"])

    return ex.finish(use, f"`{id_col}` {id_type}, n_words bigint, n_removed bigint, "
                          "removed array<struct<start:bigint,end:bigint>>, kept_text string")
