"""Vectorised word work on Arrow text columns, used inside tasks.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]``.  Everything works on
the UTF-8 buffer of an Arrow string column: no Python string is made per
word.  Hashes are 64-bit and the same in every process.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are worked on in slices of about this many bytes (one text at least),
# which bounds the temporary arrays of a task whatever the batch size.
SLICE_BYTES = 2_000_000

SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEP = np.uint64(0x9E3779B97F4A7C15)
_ROLL = 0xD1342543DE82EF95  # odd, so it has an inverse modulo 2**64
SECOND_ROLL = 0x9FB21C651E98DF25


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift and multiply), on a copy."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """The words of some texts: byte buffer, bounds of words, words per text."""

    data: np.ndarray  # uint8, all texts one after the other
    offsets: np.ndarray  # int64, bounds of the texts in data
    starts: np.ndarray  # int64, first byte of each word
    ends: np.ndarray  # int64, byte behind each word
    first: np.ndarray  # int64, bounds of the texts in the list of words

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def windows(self, k: int) -> np.ndarray:
        """True at each word that starts ``k`` words of one text."""
        n = len(self.starts)
        left = np.repeat(self.first[1:], self.counts) - np.arange(n)
        return left >= k

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        n, step = len(self.starts), 250_000  # bounds the arrays that have an entry per byte
        return np.concatenate(
            [np.zeros(0, dtype=np.uint64)] + [self._hashes(slice(i, i + step)) for i in range(0, n, step)]
        )

    def _hashes(self, words: slice) -> np.ndarray:
        starts = self.starts[words]
        sizes = self.ends[words] - starts
        begin = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        place = np.arange(int(sizes.sum()), dtype=np.int64) - np.repeat(begin, sizes)
        code = self.data[place + np.repeat(starts, sizes)].astype(np.uint64)
        code += (place.astype(np.uint64) + np.uint64(1)) << np.uint64(8)
        code *= _STEP
        return mix(np.add.reduceat(mix(code), begin) + sizes.astype(np.uint64))


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    texts = pc.fill_null(texts, "")
    if len(texts) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.zeros(0, dtype=np.uint8) if raw is None else np.frombuffer(raw, dtype=np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def split_words(texts: pa.Array, lower: bool = False) -> Words:
    """Words of each text; a null text has none.  ``lower`` maps A-Z to a-z."""
    data, offsets = _buffers(texts)
    if lower:
        data = _LOWER[data]
    inside = ~SEPARATOR[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    at = np.flatnonzero(starts)
    return Words(data, offsets, at, np.flatnonzero(ends) + 1, np.searchsorted(at, offsets))


def window_hashes(words: np.ndarray, k: int, roll: int = _ROLL) -> np.ndarray:
    """Hash of ``words[i:i+k]`` for every i with k words left (text bounds are the caller's); ``roll`` is odd."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    if k <= 8:
        total = words[:n].copy()
        for j in range(1, k):
            total *= np.uint64(roll)
            total += words[j : j + n]
        return mix(total)
    power = np.cumprod(np.full(len(words), roll, dtype=np.uint64))
    summed = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(words * power)))
    inverse = np.cumprod(np.full(n, pow(roll, -1, 1 << 64), dtype=np.uint64))
    return mix((summed[k : k + n] - summed[:n]) * inverse)


def sliding_min(x: np.ndarray, k: int) -> np.ndarray:
    """Minimum of ``x[i:i+k]`` for every full window."""
    reach, low = 1, x
    while reach * 2 <= k:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    rest = k - reach
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def cover(flags: np.ndarray, k: int) -> np.ndarray:
    """True at each of the ``len(flags) + k - 1`` words under a flagged window of k words."""
    step = np.zeros(len(flags) + k, dtype=np.int64)
    step[: len(flags)] += flags
    step[k:] -= flags
    return np.cumsum(step)[:-1] > 0


def slices(batch: pa.RecordBatch, text_col: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``size`` bytes of text (one row at least)."""
    total = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False))
    begin = 0
    while begin < batch.num_rows:
        before = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, before + size, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end
    release()


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Give the memory of finished arrays back, so that idle workers stay small."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)
