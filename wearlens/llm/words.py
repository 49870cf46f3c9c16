"""Words of whole texts as NumPy arrays: boundaries, lower-cased bytes, and 64-bit hashes.

All work is on the UTF-8 bytes of an Arrow column, a few megabytes of texts at a time, without a
Python loop over words. Both word rules below cut at ASCII bytes alone, so bytes suffice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 19  # texts handled together; a longer text is handled alone

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _mask(kept) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(kept)] = True
    return table


#: not white space (space, \t, \n, \v, \f, \r)
SPACED = _mask(b for b in range(256) if b != 0x20 and not 0x09 <= b <= 0x0D)
#: digits, letters and all that is not ASCII
ALNUM = _mask(b for b in range(256) if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or 0x41 <= b <= 0x5A or b >= 0x80)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: a permutation that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class _Powers:
    """Powers of BASE and of its inverse modulo 2**64, as many as were needed so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
            size = max(n, CHUNK_BYTES + 1)
            self.up = np.concatenate([[np.uint64(1)], np.cumprod(np.full(size - 1, BASE, dtype=np.uint64))])
            self.down = np.concatenate([[np.uint64(1)], np.cumprod(np.full(size - 1, inverse, dtype=np.uint64))])
        return self.up, self.down


_powers = _Powers()


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each stretch data[start:end] of bytes."""
    n = len(data)
    up, down = _powers.upto(n + 1)
    terms = data.astype(np.uint64)
    terms += np.uint64(1)
    terms *= up[:n]
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(terms, out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def sequence_hashes(words: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each stretch words[start:end] of word hashes."""
    up, down = _powers.upto(len(words) + 1)
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * up[: len(words)], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


@dataclass
class Words:
    """Words of ``rows`` consecutive texts. ``ptr[i]:ptr[i + 1]`` are those of text i."""

    data: np.ndarray  # lower-cased bytes of all texts
    offsets: np.ndarray  # where each text starts in data, and the end
    start: np.ndarray
    end: np.ndarray
    ptr: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.ptr)

    def last(self) -> np.ndarray:
        """For each word, where the words of its text end."""
        return np.repeat(self.ptr[1:], self.counts)

    def text(self) -> np.ndarray:
        """For each word, the number of its text."""
        return np.repeat(np.arange(len(self.ptr) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word's lower-cased bytes."""
        return span_hashes(self.data, self.start, self.end)

    def strings(self, a: int, b: int) -> list[str]:
        """Words a to b as text."""
        return [bytes(self.data[s:e]).decode("utf-8", "replace") for s, e in zip(self.start[a:b], self.end[a:b])]


def split(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> Words:
    """Words of the texts ``data[offsets[i]:offsets[i + 1]]``."""
    flag = is_word[data]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before = np.empty_like(flag)
    before[:1] = False
    before[1:] = flag[:-1]
    before[edges] = False
    start = np.flatnonzero(flag & ~before)
    after = np.empty_like(flag)
    after[-1:] = False
    after[:-1] = flag[1:]
    after[edges - 1] = False
    end = np.flatnonzero(flag & ~after) + 1
    return Words(LOWER[data], offsets, start, end, np.searchsorted(start, offsets))


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with at most ``limit`` bytes: first row, end row, their bytes, and offsets. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "") if column.null_count else column
    wide = pa.types.is_large_string(column.type)
    _, at, data = column.buffers()
    n = len(column)
    at = np.frombuffer(at, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < n:
        stop = max(row + 1, int(np.searchsorted(at, at[row] + limit, side="right")) - 1)
        yield row, stop, data[at[row] : at[stop]], at[row : stop + 1] - at[row]
        row = stop


def grams(words: np.ndarray, last: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the k words from each position, and whether they lie in one text."""
    n = len(words)
    out = np.zeros(n, dtype=np.uint64)
    step = np.uint64(0xD6E8FEB86659FD93)
    for j in range(min(k, n)):
        out[: n - j] *= step
        out[: n - j] += words[j:]
    out = mix(out + np.uint64(k))
    return out, np.arange(n) + k <= last


def lists(ptr: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ptr.astype(np.int32)), pa.array(values, type=kind))
