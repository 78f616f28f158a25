"""Sorted columns of 64-bit numbers as bytes, dealt to ranges of their first column, a hash."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard

#: Rows of a range that are unpacked at once.
MOST = 1 << 23


def pack(*columns: np.ndarray) -> bytes:
    """Equally long columns of 64-bit numbers, byte plane by byte plane, so that planes of zeros vanish."""
    planes = b"".join(np.ascontiguousarray(c.view(np.uint8).reshape(-1, 8).T).tobytes() for c in columns)
    return zstandard.ZstdCompressor(level=1).compress(planes)


def unpack(data: bytes, columns: int) -> list[np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8).reshape(columns, 8, -1)
    return [np.ascontiguousarray(p.T).view(np.int64).ravel() for p in planes]


def bucket_of(key: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """Which of as many equal ranges of hashes of `bits` bits each key is in."""
    return ((key << np.uint64(64 - bits) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def pack_buckets(key: np.ndarray, bits: int, buckets: int, *columns: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Bucket and packed rows, with the sorted keys as differences, for each bucket that has any."""
    bucket = bucket_of(key, bits, buckets)
    starts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(bucket) else np.zeros(0, dtype=np.int64)
    step = np.diff(key, prepend=key[:1])
    step[starts] = key[starts]
    ends = np.append(starts[1:], len(key)) if len(starts) else starts
    return bucket[starts], [pack(step[a:z].view(np.int64), *(c[a:z] for c in columns)) for a, z in zip(starts, ends, strict=True)]


def unpack_bucket(bucket: int, packed: list[bytes], columns: int, bits: int, buckets: int, most: int = MOST) -> Iterator[list[np.ndarray]]:
    """The columns of a bucket's rows, keys first.

    A bucket of more than `most` rows comes in as many narrower ranges as it needs, one at a time, so a
    worker holds such a bucket only as it came.
    """
    rows = sum(zstandard.frame_content_size(p) for p in packed) // (8 * columns)
    parts = max(1, -(-rows // most))
    for part in range(parts):
        found = []
        for p in packed:
            first, *rest = unpack(p, columns)
            key = np.add.accumulate(first.view(np.uint64), dtype=np.uint64)
            own = slice(None) if parts == 1 else bucket_of(key, bits, buckets * parts) == bucket * parts + part
            found.append([key[own], *(c[own] for c in rest)])
        yield [np.concatenate(c) for c in zip(*found, strict=True)]


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    """Key and values of rows (key, value) that are sorted by key."""
    now, held = None, []
    for b in batches:
        for key, value in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if key != now and held:
                yield now, held
                held = []
            now = key
            held.append(value)
    if held:
        yield now, held
