"""Words of whole texts as NumPy arrays, straight from Arrow's UTF-8 buffers.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D (the white space
of the operators' contracts; all of it is ASCII, so byte runs are code point
runs).  Texts are handled in slices of a few megabytes, so the arrays stay
small however many rows an Arrow batch holds; only one text longer than that
is handled as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_U64 = np.uint64


def _odd(seed: int) -> int:
    return int(np.random.default_rng(seed).integers(1 << 40, 1 << 63, dtype=np.uint64)) * 2 + 1 & (1 << 64) - 1


class Roller:
    """Hashes of all runs of a sequence of 64-bit values, modulo 2**64.

    ``prefix`` gives ``S[i] = sum of v[j] * B**j for j < i``; the hash of
    ``v[i:j]`` is ``(S[j] - S[i]) * B**-i``, so every run costs one product.
    """

    def __init__(self, seed: int):
        self.base = _odd(seed)
        self.inverse = pow(self.base, -1, 1 << 64)
        self._powers = self._inverses = np.ones(1, _U64)

    def _grown(self, table: np.ndarray, base: int, n: int) -> np.ndarray:
        if len(table) >= n:
            return table
        size = max(n, 2 * len(table), 1 << 12)
        step = np.full(size, base, _U64)
        step[0] = 1
        return np.cumprod(step, dtype=_U64)

    def prefix(self, values: np.ndarray) -> np.ndarray:
        n = len(values)
        self._powers = self._grown(self._powers, self.base, n + 1)
        out = np.zeros(n + 1, _U64)
        np.cumsum(values * self._powers[:n], out=out[1:], dtype=_U64)
        return out

    def runs(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        self._inverses = self._grown(self._inverses, self.inverse, len(prefix))
        return (prefix[ends] - prefix[starts]) * self._inverses[starts]

    def windows(self, prefix: np.ndarray, size: int) -> np.ndarray:
        """Hash of every run of ``size`` values."""
        n = len(prefix) - size
        if n <= 0:
            return np.zeros(0, _U64)
        self._inverses = self._grown(self._inverses, self.inverse, len(prefix))
        return (prefix[size:] - prefix[:n]) * self._inverses[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective finishing mix of 64-bit hashes (every bit depends on all)."""
    h = h ^ (h >> _U64(32))
    h = h * _U64(0xD6E8FEB86659FD93)
    h = h ^ (h >> _U64(32))
    h = h * _U64(0xD6E8FEB86659FD93)
    return h ^ (h >> _U64(32))


class WordHasher:
    """64-bit hashes of words, from a table of random byte values and a ``Roller`` over bytes."""

    def __init__(self, seed: int):
        self.values = np.random.default_rng(seed).integers(0, 1 << 64, 256, dtype=np.uint64)
        self.roller = Roller(seed + 1)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        prefix = self.roller.prefix(self.values[data])
        return mixed(self.roller.runs(prefix, starts, ends) + (ends - starts).astype(_U64))


@dataclass
class Texts:
    """A few texts: their bytes, their words' byte bounds, and each text's range of words."""

    rows: slice  # rows of the batch
    data: np.ndarray  # uint8
    starts: np.ndarray  # first byte of each word
    ends: np.ndarray  # byte after each word
    first: np.ndarray  # text k has the words first[k]:first[k + 1]

    def word_bytes(self, lo: int, hi: int) -> list[bytes]:
        raw = self.data.tobytes() if hi - lo > 64 else self.data
        return [bytes(raw[s:e]) for s, e in zip(self.starts[lo:hi].tolist(), self.ends[lo:hi].tolist(), strict=True)]


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def texts(column: pa.Array | pa.ChunkedArray, lower: bool = False, slice_bytes: int = SLICE_BYTES) -> Iterator[Texts]:
    """The texts of a string column (null: no words) in slices of about ``slice_bytes``.

    ``lower`` lower-cases A-Z and nothing else.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    whole = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + slice_bytes, "right")) - 1)
        stop = min(stop, len(column))
        data = whole[offsets[row] : offsets[stop]]
        if lower:
            data = LOWER[data]
        bounds = offsets[row : stop + 1] - offsets[row]
        word = np.zeros(len(data) + 2, bool)
        word[1:-1] = ~_SPACE[data]
        # A text's first byte starts a word even when the text before it ends in one.
        begins = word[1:-1] & ~word[:-2]
        inner = bounds[1:-1][bounds[1:-1] < len(data)]
        begins[inner] = word[1:-1][inner]
        closes = word[1:-1] & ~word[2:]
        closes[inner[inner > 0] - 1] = word[1:-1][inner[inner > 0] - 1]
        starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
        yield Texts(slice(row, stop), data, starts, ends, np.searchsorted(starts, bounds))
        row = stop
