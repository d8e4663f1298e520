"""Vectorised word hashing over Arrow string columns: whole texts, no per-word Python.

Words are runs of bytes outside 0x20 and 0x09-0x0D; UTF-8 never uses these bytes inside a character, so byte runs and
character runs agree. A word's hash is a sum over its bytes of table[byte] * P**position (mod 2**64), then mixed. The hash
of a run of words is a polynomial in the word hashes, read in O(1) from prefix sums that use the inverse of the base.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at once; one longer text makes a chunk of its own.
CHUNK_BYTES = 1 << 20
MASK = (1 << 64) - 1


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift rounds)."""
    h = h + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & MASK)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


@lru_cache(maxsize=4)
def tables(seed: int) -> tuple[np.ndarray, int, int, int]:
    """Byte values, the base of byte positions, the base of word positions and its inverse (mod 2**64)."""
    byte = mix(np.arange(256, dtype=np.uint64), 2 * seed + 11)
    odd = [int(x) | 1 for x in mix(np.arange(2, dtype=np.uint64), 2 * seed + 12)]
    return byte, odd[0], odd[1], pow(odd[1], -1, 1 << 64)


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) mod 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(1024, 1 << (n - 1).bit_length())
        have = np.empty(size, np.uint64)
        have[0], done = 1, 1
        while done < size:
            more = min(done, size - done)
            have[done : done + more] = have[:more] * np.uint64(pow(base, done, 1 << 64))
            done += more
        _powers[base] = have
    return have[:n]


SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Words:
    """The words of some texts. first[i]:first[i + 1] are those of text i; start, end are their byte places in data."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.data = LOWER[data] if lower else data
        self.offsets = offsets
        n = len(data)
        solid = ~SPACE[data]
        before = np.empty(n, bool)
        after = np.empty(n, bool)
        if n:
            before[1:], before[0] = solid[:-1], False
            after[:-1], after[-1] = solid[1:], False
            edges = offsets[(offsets > 0) & (offsets < n)]
            before[edges] = False
            after[edges - 1] = False
        self.solid = solid
        self.start = np.flatnonzero(solid & ~before)
        self.end = np.flatnonzero(solid & ~after) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.counts = np.diff(self.first)

    def hashes(self, seed: int = 0) -> np.ndarray:
        byte, base, _, _ = tables(seed)
        if not len(self.start):
            return np.empty(0, np.uint64)
        sizes = self.end - self.start
        at = np.flatnonzero(self.solid)
        begin = np.cumsum(sizes) - sizes
        place = np.arange(len(at)) - np.repeat(begin, sizes)
        value = byte[self.data[at]] * powers(base, int(sizes.max()))[place]
        return mix(np.add.reduceat(value, begin), seed)


class RunHash:
    """Hashes of runs of words: run(start, length) in O(1) each."""

    def __init__(self, words: np.ndarray, seed: int = 0):
        _, _, base, inverse = tables(seed)
        n = len(words)
        self.power = powers(base, n + 1)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(words * powers(inverse, n + 1)[:n], out=self.prefix[1:])

    def run(self, start: np.ndarray, length) -> np.ndarray:
        return mix((self.prefix[start + length] - self.prefix[start]) * self.power[start], 7)


def strings(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow column of strings or bytes; nulls become empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_large_binary(column.type) else "")
    if not pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_string())
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return held[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(column):
    """(first row, end row, data, offsets) of slices of about CHUNK_BYTES."""
    data, offsets = strings(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK_BYTES, "right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
