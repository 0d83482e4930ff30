"""Words of many byte texts at once, in numpy: where they stand and a 64-bit code of each.

A splitter is given the bytes that part words and, apart from them, the bytes that also
break a run of words (sentence marks, say).  A word's code is a polynomial over one fixed
random value per byte, taken from prefix sums and mixed.  Work goes through the text in
blocks cut between words, so memory beside the text is that of one block and of the words.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

from stratiform.llm.texthash import mix

BLOCK = 1 << 18  # bytes of text coded at once
TEXTS = 1 << 21  # bytes of text handed out together; a longer text stands alone
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    values = np.full(n, base, dtype=np.uint64)
    values[:1] = 1
    return np.cumprod(values, dtype=np.uint64)


class Words(NamedTuple):
    start: np.ndarray  # first byte of each word
    end: np.ndarray  # the byte after it
    code: np.ndarray  # uint64
    piece: np.ndarray  # number of breaking bytes before the word


class Splitter:
    def __init__(self, blanks: bytes, breaks: bytes = b"", lower: bool = False, seed: int = 20_250_301):
        table = np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        if lower:
            table[65:91] = table[97:123]
        self._table = table
        self._parts = np.zeros(256, dtype=bool)
        self._parts[list(blanks + breaks)] = True
        self._breaks = np.zeros(256, dtype=bool)
        self._breaks[list(breaks)] = True
        self._up = self._down = powers(1, 0)

    def _cut(self, data: np.ndarray, at: int) -> int:
        """The first place from ``at`` on that lies between words."""
        while at < len(data):
            found = np.flatnonzero(self._parts[data[at:at + 4096]])
            if len(found):
                return at + int(found[0])
            at += 4096
        return len(data)

    def words(self, data: np.ndarray) -> Words:
        found, at, breaks = [], 0, 0
        while at < len(data):
            end = self._cut(data, min(at + BLOCK, len(data)))
            part = data[at:end]
            if len(part) > len(self._up):
                n = max(len(part), BLOCK + 4096)
                self._up, self._down = powers(_BASE, n), powers(_INVERSE, n)
            inside = ~self._parts[part]
            edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
            first, last = edge[::2], edge[1::2]
            prefix = np.zeros(len(part) + 1, dtype=np.uint64)
            np.cumsum(self._table[part] * self._up[:len(part)], out=prefix[1:])
            code = mix((prefix[last] - prefix[first]) * self._down[first])
            passed = np.cumsum(self._breaks[part])
            found.append(Words(first + at, last + at, code, passed[first] + breaks))
            breaks += int(passed[-1])
            at = end
        if not found:
            none = np.zeros(0, dtype=np.int64)
            return Words(none, none, none.astype(np.uint64), none)
        return Words(*(np.concatenate(x) for x in zip(*found)))


class Texts(NamedTuple):
    rows: slice  # of the batch
    data: np.ndarray  # the texts, each followed by a line feed
    begin: np.ndarray  # first byte of each text, and the end of the last


def texts(column: pa.Array, limit: int = TEXTS) -> Iterator[Texts]:
    """Consecutive texts of a binary column, about ``limit`` bytes at a time; NULL counts as empty."""
    some, size, done = [], 0, 0

    def out() -> Texts:
        begin = np.zeros(len(some) + 1, dtype=np.int64)
        np.cumsum([len(t) + 1 for t in some], out=begin[1:])
        return Texts(slice(done, done + len(some)), np.frombuffer(b"\n".join(some) + b"\n", dtype=np.uint8), begin)

    for value in column:
        raw = value.as_py() or b""
        if some and size + len(raw) > limit:
            yield out()
            done += len(some)
            some, size = [], 0
        some.append(raw)
        size += len(raw)
    if some:
        yield out()


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))
