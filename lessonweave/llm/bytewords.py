"""Words of many texts at once, as numpy arrays over their UTF-8 bytes.

A word is a run of ``[0-9a-z]`` and non-ASCII characters after A-Z has been lower-cased. All bytes of a
non-ASCII character are 0x80 or above, so runs of bytes are runs of characters.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER_TABLE = _LOWER.tobytes()
_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True
_IS_WORD_TABLE = _IS_WORD.astype(np.uint8).tobytes()

#: An odd base has an inverse modulo 2**64, which makes a hash independent of where a word stands.
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SEGMENT = 1 << 18
#: Powers are kept for a segment and a word that runs on beyond it.
_KEPT = _SEGMENT + 4096
_powers: list[np.ndarray] = []


@dataclass
class Words:
    low: np.ndarray  # lower-cased bytes
    mask: np.ndarray  # whether a byte belongs to a word
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray  # row of each word
    n_docs: int

    def counts(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.n_docs)


def find_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    n = len(data)
    n_docs = len(offsets) - 1
    if n == 0:
        none = np.empty(0, np.int64)
        return Words(np.empty(0, np.uint8), np.empty(0, bool), none, none, none, n_docs)
    low = np.frombuffer(data.tobytes().translate(_LOWER_TABLE), np.uint8)
    mask = np.frombuffer(low.tobytes().translate(_IS_WORD_TABLE), np.uint8).view(bool)
    inner = offsets[(offsets > 0) & (offsets < n)]
    first, last = mask.copy(), mask.copy()
    first[1:] &= ~mask[:-1]
    first[inner] = mask[inner]
    last[:-1] &= ~mask[1:]
    last[inner - 1] = mask[inner - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    doc = np.searchsorted(offsets, start, side="right") - 1
    return Words(low, mask, start, end, doc, n_docs)


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse up to n; those for a segment are kept, longer ones are not."""
    if n <= _KEPT and _powers:
        return _powers
    found = []
    with np.errstate(over="ignore"):
        for base in (_BASE, _INVERSE):
            steps = np.full(max(_KEPT, n) + 1, base, np.uint64)
            steps[0] = 1
            found.append(np.multiply.accumulate(steps))
    if n <= _KEPT:
        _powers[:] = found
    return found


def mix(x: np.ndarray) -> np.ndarray:
    """Spread each bit of 64 over all (finaliser of a public 64-bit mixer)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def hash_words(w: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    out = np.empty(len(w.start), np.uint64)
    lo = 0
    while lo < len(w.start):
        base = int(w.start[lo])
        hi = max(lo + 1, int(np.searchsorted(w.start, base + _SEGMENT)))
        top = int(w.end[hi - 1])
        up, down = _power_tables(top - base + 1)
        with np.errstate(over="ignore"):
            sums = np.zeros(top - base + 1, np.uint64)
            np.cumsum((w.low[base:top].astype(np.uint64) + np.uint64(1)) * up[: top - base], out=sums[1:])
            s, e = w.start[lo:hi] - base, w.end[lo:hi] - base
            out[lo:hi] = (sums[e] - sums[s]) * down[s]
        lo = hi
    return mix(out)


def hash_windows(h: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` word hashes; position i covers words i to i+size-1."""
    n = len(h) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(n, np.uint64)
        for j in range(size):
            out = out * np.uint64(_BASE) + h[j : j + n]
    return mix(out)
