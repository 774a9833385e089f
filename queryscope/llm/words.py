"""Words and word shingles of whole batches of texts, as 64-bit hashes in numpy.

A word is a run of bytes other than space and \\x09-\\x0D, with A-Z taken
as a-z.  Word hashes are polynomial, from one running sum over the bytes of
a batch, and do not depend on where the word stands.
"""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
_lower = np.arange(256, dtype=np.uint64)
_lower[65:91] += 32
LOWER = _lower + np.uint64(1)
IS_WORD = np.ones(256, dtype=bool)
IS_WORD[[32, *range(9, 14)]] = False
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse modulo 2**64, for i < n."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 21)
        for k, b in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            p = np.full(size, b, dtype=np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every bit over the word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Words of a list of texts: ``hash``, byte ``start`` and ``end`` (in the joined bytes), ``first`` word of each text."""

    def __init__(self, texts: list[str]):
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        self.data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        self.offsets = np.zeros(len(raw) + 1, dtype=np.int64)
        np.cumsum([len(r) for r in raw], out=self.offsets[1:])
        n = len(self.data)
        if n == 0:
            self.start = self.end = np.zeros(0, dtype=np.int64)
            self.hash = np.zeros(0, dtype=np.uint64)
            self.first = np.zeros(len(raw) + 1, dtype=np.int64)
            return
        word = IS_WORD[self.data]
        begins, ends = word.copy(), word.copy()
        begins[1:] &= ~word[:-1]
        ends[:-1] &= ~word[1:]
        full = np.flatnonzero(np.diff(self.offsets))
        at = self.offsets[:-1][full]
        begins[at] = word[at]
        at = self.offsets[1:][full] - 1
        ends[at] = word[at]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        p, inv = powers(n)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(LOWER[self.data] * p, out=total[1:])
        self.hash = mix((total[self.end] - total[self.start]) * inv[self.start])
        self.first = np.searchsorted(self.start, self.offsets)


def joined(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position on (k - 1 positions fewer)."""
    m = max(0, len(h) - k + 1)
    s = np.full(m, np.uint64(k * 0x2545F4914F6CDD1D & (1 << 64) - 1))
    for i in range(k):
        s = s * np.uint64(BASE) + h[i:i + m]
    return mix(s)


def shingles(w: Words, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """k-word shingle hashes in text order, and the first of each text.

    A text of fewer words has its whole sequence as one; one of none has none.
    """
    n = np.diff(w.first)
    size = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    first = np.zeros(len(n) + 1, dtype=np.int64)
    np.cumsum(size, out=first[1:])
    # word index of each shingle
    at = np.arange(first[-1]) - np.repeat(first[:-1], size) + np.repeat(w.first[:-1], size)
    short = np.repeat(n < k, size)
    out = np.zeros(first[-1], dtype=np.uint64)
    out[~short] = joined(w.hash, k)[at[~short]]
    for m in range(1, k):
        these = np.repeat(n == m, size)
        if these.any():
            out[these] = joined(w.hash, m)[at[these]]
    return out, first


def sets(w: Words, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text in ascending order, and the first of each text."""
    s, first = shingles(w, k)
    for a, b in zip(first[:-1], first[1:]):
        s[a:b].sort()
    keep = np.ones(len(s), dtype=bool)
    keep[1:] = s[1:] != s[:-1]
    keep[first[:-1][np.diff(first) > 0]] = True
    kept = np.zeros(len(s) + 1, dtype=np.int64)
    np.cumsum(keep, out=kept[1:])
    return s[keep], kept[first]
