"""Words of many texts at once, as numpy arrays over one byte buffer.

A word is a run of bytes other than space and 0x09-0x0D, so words never depend on a locale or on
Unicode white space.  Nothing here knows about Spark: the operators call it on the Arrow batches
that their tasks receive.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_RNG = np.random.default_rng(20240917)
#: One random 64-bit value for each byte, and two odd multipliers of the polynomials below.
_BYTE = _RNG.integers(0, 1 << 64, 256, dtype=np.uint64)
_R = np.uint64(0x9E3779B97F4A7C15)
_R_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_GRAM = np.uint64(0xD6E8FEB86659FD93)
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes of text that one call handles; longer texts still go in one piece.
PIECE_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@dataclass
class Words:
    """The words of a run of texts: text t has the words first[t] to first[t + 1] - 1."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, the same in every process."""
        n = len(self.data)
        if not len(self.start):
            return np.zeros(0, dtype=np.uint64)
        power = np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(n, _R))), dtype=np.uint64)
        total = np.concatenate(([np.uint64(0)], np.add.accumulate(_BYTE[self.data] * power[:n], dtype=np.uint64)))
        inverse = np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(n, _R_INVERSE))), dtype=np.uint64)
        return mix((total[self.end] - total[self.start]) * inverse[self.start] + (self.end - self.start).astype(np.uint64))

    def texts_of_words(self) -> np.ndarray:
        """For each word, the index of its text."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def word(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()

    def strings(self) -> pa.BinaryArray:
        """The words as one Arrow array."""
        length = self.end - self.start
        ends = np.cumsum(length)
        keep = ~_SEPARATOR[self.data]
        offsets = np.concatenate(([0], ends)).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(length), [None, pa.py_buffer(offsets), pa.py_buffer(self.data[keep])])


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the offsets of a string or binary column; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    if not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, dtype=np.uint8)
    return data, offsets - offsets[0]


def split(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    """The words of the texts; lower: A-Z become a-z first."""
    if lower:
        data = _LOWER[data]
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = ~_SEPARATOR[data]
    begins = inside[1:] & ~inside[:-1]
    ends = inside[:-1] & ~inside[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    touching = edge[inside[edge] & inside[edge + 1]]  # words that only the end of a text parts
    begins[touching] = True
    ends[touching] = True
    start, end = np.flatnonzero(begins[:-1]), np.flatnonzero(ends)
    return Words(data, offsets, start, end, np.searchsorted(start, offsets))


def pieces(batch: pa.RecordBatch, text: str, size: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of runs of rows with about `size` bytes of text."""
    data, offsets = buffers(batch.column(batch.schema.get_field_index(text)))
    row, rows = 0, batch.num_rows
    while row < rows:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1)
        stop = min(stop, rows)
        yield row, stop, data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
        row = stop


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n consecutive word hashes; n - 1 fewer than there are words."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = hashes[:m].copy()
    for i in range(1, n):
        total *= _GRAM
        total += hashes[i : i + m]
    return mix(total)
