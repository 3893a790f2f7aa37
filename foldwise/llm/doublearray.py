"""Double-array tries over integer symbols, built and walked with numpy.

A state is a slot; its child by symbol ``c`` (1 or more) is slot ``base[state] + c`` if ``check`` of
that slot names the state. The root is slot 0. ``accept`` holds the phrase number of an accepting
state, else -1. Symbols are numbers of the trie's own vocabulary of 64-bit word codes.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

#: Places tried at once for a state's children.
TRIES = 256


class DoubleArray(NamedTuple):
    vocabulary: np.ndarray  # sorted uint64 word codes; symbol = place + 1
    base: np.ndarray
    check: np.ndarray
    accept: np.ndarray
    phrases: int

    @property
    def nbytes(self) -> int:
        return sum(x.nbytes for x in self[:4])

    def to_bytes(self) -> list[bytes]:
        return [x.tobytes() for x in self[:4]]

    @staticmethod
    def from_bytes(parts: list[bytes], phrases: int) -> DoubleArray:
        return DoubleArray(*(np.frombuffer(p, t) for p, t in zip(parts, ("<u8", "<i4", "<i4", "<i4"))), phrases)

    def symbols(self, codes: np.ndarray) -> np.ndarray:
        """The symbol of each code, 0 if the vocabulary lacks it."""
        if not len(self.vocabulary):
            return np.zeros(len(codes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, codes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == codes, at + 1, 0)

    def step(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The next state of each, -1 if there is none."""
        to = self.base[states].astype(np.int64) + symbols
        ok = (symbols > 0) & (to > 0) & (to < len(self.check))
        to[~ok] = 0
        ok &= self.check[to] == states
        return np.where(ok, to, -1)


def build(codes: np.ndarray) -> DoubleArray:
    """A trie of the phrases in the rows of ``codes`` (uint64, shape (phrases, longest)); a phrase
    shorter than the longest ends in zeros. Row ``i`` is phrase ``i``."""
    n, depth = codes.shape
    vocabulary = np.unique(codes)
    vocabulary = vocabulary[vocabulary != 0]
    ids = np.where(codes == 0, 0, np.searchsorted(vocabulary, codes) + 1)
    order = np.lexsort(ids.T[::-1])
    ids = ids[order]
    size = max(64, 2 * n * depth + len(vocabulary) + 2)
    base, check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
    accept = np.full(size, -1, np.int32)
    check[0] = -2  # the root's slot is taken and nobody's child
    state = np.zeros(n, np.int64)  # the state of each phrase's prefix

    def grown(need: int) -> None:
        nonlocal base, check, accept
        if need > len(check):
            more = max(need, 2 * len(check)) - len(check)
            base = np.append(base, np.zeros(more, np.int32))
            check = np.append(check, np.full(more, -1, np.int32))
            accept = np.append(accept, np.full(more, -1, np.int32))

    for d in range(depth):
        live = np.flatnonzero(ids[:, d] > 0)
        if not len(live):
            break
        # the distinct children (parent, symbol), phrases with one prefix being neighbours
        p, c = state[live], ids[live, d]
        new = np.ones(len(live), bool)
        new[1:] = (p[1:] != p[:-1]) | (c[1:] != c[:-1])
        child = np.cumsum(new) - 1
        p, c = p[new], c[new]
        slot = np.empty(len(p), np.int64)
        first = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
        count = np.diff(np.append(first, len(p)))
        cursor = 1
        for g in np.argsort(-count, kind="stable"):
            i, k = first[g], count[g]
            if k == 1:
                break
            symbols = c[i:i + k]
            while True:  # first fit, the widest states first
                grown(cursor + TRIES + int(symbols[-1] - symbols[0]) + 2)
                free = cursor + np.flatnonzero(check[cursor:cursor + TRIES] == -1)
                fits = (check[free[:, None] + (symbols - symbols[0])] == -1).all(1)
                if fits.any():
                    at = free[np.argmax(fits)]
                    break
                cursor += TRIES
            slot[i:i + k] = at + (symbols - symbols[0])
            base[p[i]] = at - symbols[0]
            check[slot[i:i + k]] = p[i]
        # single children fill the gaps
        alone = first[count == 1]
        grown(len(alone) + int((check != -1).sum()) + 1)
        free = np.flatnonzero(check == -1)[:len(alone)]
        slot[alone] = free
        base[p[alone]] = free - c[alone]
        check[free] = p[alone]
        state[live] = slot[child]
        ends = live if d == depth - 1 else live[ids[live, d + 1] == 0]
        accept[state[ends]] = order[ends]
    used = int(np.flatnonzero(check != -1)[-1]) + 1
    return DoubleArray(vocabulary, base[:used], check[:used], accept[:used], n)
