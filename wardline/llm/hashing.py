"""Vectorised 64-bit polynomial hashes of byte spans, words and word shingles (numpy)."""

from __future__ import annotations

import numpy as np
import xxhash

_BASE = np.uint64(0x9E3779B97F4A7C55)
_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_STEP = 0xD6E8FEB86659FD93
_PART = 1 << 18
_SHORT = 32
_pow: np.ndarray = np.ones(1, np.uint64)
_inv: np.ndarray = np.ones(1, np.uint64)
_chars: dict[int, np.ndarray] = {}
_PRIME = np.uint64((1 << 31) - 1)
_bases: dict[int, "_Base"] = {}

#: Bytes that separate words: ASCII white space.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _pow, _inv
    if len(_pow) < n:
        size = 1 << (n - 1).bit_length()
        for base, name in ((_BASE, "_pow"), (_INV, "_inv")):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            globals()[name] = np.cumprod(steps)
    return _pow, _inv


def prefix(buf: np.ndarray, family: int = 0) -> np.ndarray:
    """Running hash sums modulo 2^64 of a buffer; ``spans`` reads any span's hash off them.

    Fast, but weak on long spans of a self-similar pattern, whatever the base: for words of a few
    bytes, and for filters that only have to agree on equal spans.
    """
    if family not in _chars:
        _chars[family] = np.random.default_rng(1000 + family).integers(0, 1 << 64, 256, np.uint64, endpoint=False)
    power, _ = _powers(len(buf) + 1)
    out = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_chars[family][buf] * power[: len(buf)], out=out[1:])
    return out


def spans(pre: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the spans [start, end); equal bytes have equal hashes wherever they lie."""
    _, inv = _powers(len(pre))
    return mix((pre[end] - pre[start]) * inv[start])


def _fold(x: np.ndarray) -> np.ndarray:
    """Values modulo the prime 2^31 - 1, for values below 2^63."""
    x = (x & _PRIME) + (x >> np.uint64(31))
    x = (x & _PRIME) + (x >> np.uint64(31))
    return np.where(x >= _PRIME, x - _PRIME, x)


class _Base:
    """A random base modulo 2^31 - 1 with its powers, and a random number for each byte."""

    def __init__(self, seed: int):
        r = np.random.default_rng(seed)
        self.base = int(r.integers(1 << 20, int(_PRIME) - 1))
        self.chars = r.integers(1, int(_PRIME), 256).astype(np.uint64)
        self.power = self.inverse = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        """Powers up to n, by doubling: those beyond m are the first m times base^m."""
        if len(self.power) >= n:
            return
        p = int(_PRIME)
        for name, base in (("power", self.base), ("inverse", pow(self.base, -1, p))):
            have = getattr(self, name)
            while len(have) < n:
                have = np.concatenate([have, _fold(have * np.uint64(pow(base, len(have), p)))])
            setattr(self, name, have)


def strong_prefix(buf: np.ndarray, family: int = 0) -> tuple[int, np.ndarray, np.ndarray]:
    """As ``prefix``, for ``strong_spans``, on whose hashes results may rest.

    A hash is a polynomial modulo the prime 2^31 - 1 in two random bases, with random numbers for the bytes: two
    different spans of n bytes share it with a probability of about (n / 2^31)^2, whatever they hold.  Families
    have bases and numbers of their own, so their hashes fail independently.
    """
    out = []
    for k in (2 * family, 2 * family + 1):
        if k not in _bases:
            _bases[k] = _Base(5000 + k)
        own = _bases[k]
        own.reach(len(buf) + 1)
        total = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(_fold(own.chars[buf] * own.power[: len(buf)]), out=total[1:])  # below 2^63 for any buffer in memory
        out.append(total)
    return family, *out


def strong_spans(pre: tuple[int, np.ndarray, np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the spans [start, end), of 62 bits."""
    family, *sums = pre
    a, b = (_fold(_fold(total[end] - total[start]) * _bases[2 * family + k].inverse[start]) for k, total in enumerate(sums))
    return mix(a << np.uint64(31) | b)


def words(buf: np.ndarray, offsets: np.ndarray, is_word: np.ndarray | None = None,
          family: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(hash, segment) of each word: a run of bytes that are no white space (or that
    ``is_word`` marks) within a segment [offsets[i], offsets[i+1])."""
    mark = ~SPACE[buf] if is_word is None else is_word[buf]
    start, end = runs(mark, offsets)
    return word_hashes(buf, start, end, family), np.searchsorted(offsets, start, "right") - 1


def word_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, family: int = 0) -> np.ndarray:
    """Hashes of the words [start, end), taken from running sums over ``_PART`` bytes, so that a
    very long text needs no 8-byte arrays of its length.

    Running sums modulo 2^64 are weak on long words of a self-similar pattern, where most low
    bits vanish whatever the base; words of more than ``_SHORT`` bytes get a hash of their own."""
    out = np.zeros(len(start), np.uint64)
    long = end - start > _SHORT
    for k in np.flatnonzero(long).tolist():
        out[k] = xxhash.xxh3_64_intdigest(buf[start[k]:end[k]].data, family + 1)
    at_short = np.flatnonzero(~long)
    start, end = start[at_short], end[at_short]
    k = 0
    while k < len(start):
        until = max(int(np.searchsorted(end, start[k] + _PART, "right")), k + 1)
        at = start[k]
        out[at_short[k:until]] = spans(prefix(buf[at:end[until - 1]], family), start[k:until] - at, end[k:until] - at)
        k = until
    return out


def runs(mark: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values; runs end at segment borders too."""
    n = len(mark)
    inner = offsets[(offsets > 0) & (offsets < n)]
    first = mark.copy()
    first[1:] &= ~mark[:-1]
    first[inner] = mark[inner]
    last = mark.copy()
    last[:-1] &= ~mark[1:]
    last[inner - 1] = mark[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def shingles(word: np.ndarray, seg: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash, segment) of each run of ``size`` words in a segment.  A segment with fewer
    words has one shingle of all its words; one without words has none."""
    n = len(word)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    count = np.zeros(n, np.int64)
    for k in range(min(size, n)):
        step = np.uint64(pow(_STEP, k + 1, 1 << 64))
        same = np.zeros(n, bool)
        same[: n - k] = seg[k:] == seg[: n - k]
        total[same] += word[k:][same[: n - k]] * step
        count += same
    start = np.ones(n, bool)
    start[1:] = seg[1:] != seg[:-1]
    keep = (count == size) | start
    return mix(total[keep] + count[keep].astype(np.uint64)), seg[keep]


def sorted_sets(h: np.ndarray, seg: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (segment, hash) pairs in order, with their counts."""
    order = np.lexsort((h, seg))
    h, seg = h[order], seg[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (seg[1:] != seg[:-1])
    at = np.flatnonzero(new)
    return h[at], seg[at], np.diff(np.append(at, len(h)))
