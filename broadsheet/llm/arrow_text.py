"""Words of Arrow text columns as numpy arrays, and hashes of words and of runs of words.

A column is worked on in slices of bounded size. Bytes stay in the Arrow buffer: words are
found with a table lookup, and the hash of any stretch is a difference of two prefix sums of
``value * M**position``, divided by ``M**start`` (all modulo 2**64, M odd).
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20  # of text worked on at once; one longer text is a slice of its own
HASH_BYTES = 1 << 18  # of text hashed at once, cut at white space

# Freed batches go back to the system, as several workers share an executor's memory.
pa.set_memory_pool(pa.system_memory_pool())

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


class Powers:
    """Powers of an odd number and of its inverse modulo 2**64, grown when needed."""

    def __init__(self, base: int):
        self.base = base | 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self._up = self._down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._up) < n:
            n = max(n, 1 << 12)
            step = lambda x: np.concatenate(([_U(1)], np.full(n - 1, x, np.uint64))).cumprod(dtype=np.uint64)
            self._up, self._down = step(self.base), step(self.inverse)
        return self._up[:n], self._down[:n]


_BYTE_POWERS = Powers(0xD6E8FEB86659FD93)
_WORD_POWERS = Powers(0xA0761D6478BD642F)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers = _WORD_POWERS) -> np.ndarray:
    """A 64-bit hash of ``values[start:end]`` for each pair of ends."""
    up, down = powers.upto(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], dtype=np.uint64, out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def bounds(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the offsets between them; a null is an empty text."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = array.fill_null(b"" if pa.types.is_binary(array.type) or pa.types.is_large_binary(array.type) else "")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, offsets, data = array.buffers()
    if len(array) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[off[0] : off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces whose texts have about ``limit`` bytes together."""
    _, off = bounds(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a slice of texts.

    ``data``: the bytes; ``starts``, ``ends``: of each word; ``first``: the index of each
    text's first word, and the number of words at the end.
    """

    def __init__(self, texts: pa.Array, lower: bool = False):
        data, off = bounds(texts)
        self.offsets = off
        self.data = _LOWER[data] if lower else data
        self._space = space = _SPACE[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[off] = True
        before = np.ones(len(data) + 1, bool)
        before[1:] = space
        before |= cut
        after = np.ones(len(data) + 1, bool)
        after[:-1] = space
        after |= cut
        self.starts = np.flatnonzero(~space & before[:-1])
        self.ends = np.flatnonzero(~space & after[1:]) + 1
        self.first = np.searchsorted(self.starts, off)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        return piece_hashes(self.data, self.starts, self.ends)

    def texts_of(self, which: np.ndarray) -> list[bytes]:
        raw = self.data.tobytes()
        return [raw[a:b] for a, b in zip(self.starts[which].tolist(), self.ends[which].tolist())]

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def piece_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of ``data[start:end]`` for ordered, disjoint stretches of bytes."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + HASH_BYTES, "right")))
        low, high = int(starts[at]), int(ends[to - 1])
        part = data[low:high].astype(np.uint64) + _U(1)
        out[at:to] = range_hashes(part, starts[at:to] - low, ends[at:to] - low, _BYTE_POWERS)
        at = to
    return out


def gathered(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``data[start : start + length]`` of all stretches, one after another."""
    total = int(lengths.sum())
    to = np.cumsum(lengths)
    index = np.arange(total) + np.repeat(starts - (to - lengths), lengths)
    return data[index]


def list_array(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
