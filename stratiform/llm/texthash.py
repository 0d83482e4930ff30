"""Word and shingle hashes of many texts at once, in numpy.

Words are maximal runs of bytes other than blank and 0x09-0x0D, with A-Z lower-cased.
A word's hash is a polynomial over a fixed random value per byte, taken from prefix
sums; a shingle mixes the hashes of its words in order.  All hashes are 64 bits wide.
"""

from __future__ import annotations

import numpy as np

_rng = np.random.default_rng(20_240_601)  # fixed: hashes must agree between tasks and runs
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15 & ~7 | 3
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}
CHUNK = 1 << 18  # bytes of text hashed at once: a dozen arrays of 8 bytes each stand beside them


def _power(base: int, n: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        values = np.full(max(n, CHUNK + 1), base, dtype=np.uint64)
        values[0] = 1
        known = np.cumprod(values, dtype=np.uint64)
        if len(known) <= 4 * CHUNK:
            _powers[base] = known
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the number of words before each text (one more than texts)."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    size = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    word = ~_BLANK[data]
    edge = np.flatnonzero(np.diff(word.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    start, end = edge[::2], edge[1::2]
    prefix = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * _power(_BASE, len(data)), out=prefix[1:])
    hashes = mix((prefix[end] - prefix[start]) * _power(_INVERSE, len(data))[start])
    return hashes, np.searchsorted(start, np.r_[0, np.cumsum(size)])


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the ``k``-word shingles of one text; fewer words make one shingle, none make none."""
    n = len(words)
    if n == 0:
        return words
    if n < k:
        total = np.full(1, n, dtype=np.uint64)
        for i in range(n):
            total += words[i:i + 1] * _STEP[i % 64]
        return mix(total)
    total = np.zeros(n - k + 1, dtype=np.uint64)
    for i in range(k):
        total += words[i:n - k + 1 + i] * _STEP[i % 64]
    return mix(total)


def chunks(values, limit: int = CHUNK):
    """Lists of consecutive encoded texts of about ``limit`` bytes; a longer text stands alone."""
    some, size = [], 0
    for v in values:
        raw = (v.as_py() or "").encode("utf-8", "surrogatepass")
        if some and size + len(raw) > limit:
            yield some
            some, size = [], 0
        some.append(raw)
        size += len(raw)
    if some:
        yield some
