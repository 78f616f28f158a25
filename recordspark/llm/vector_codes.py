"""Vector codes: a codebook for each part of the vectors, fitted by Lloyd's rounds with Hamerly's bounds.

Components become integers, so distances, sums and ties are exact.  A row carries its packed integers and a
state: for each part the code, one upper bound of the distance to its entry and one lower bound of the distance
to the second nearest.  When entries move, the upper bound grows by what the own entry moved, the lower one
shrinks by the largest move of the others.  Only where the upper bound isn't strictly below the lower one (or
below half the way from the entry to its nearest neighbour) is the own distance computed, and only where that
fails too are all entries scanned; so a tie always comes to a scan, which takes the lower index.  Bounds are
rounded outwards.

A round is one pass over the rows, written to the shared folder with their states (the round before is then
deleted), and one over codes and integers that adds up each task's parts before the shuffle.  The codebooks,
entries x dimensions numbers, are all that the driver and the closures hold.

Defined results: vectors that are null or hold null or non-finite components take no part.  Shorter vectors
count as filled up with zeros to the longest; where its length isn't divisible by the number of parts, the parts
differ by one component.  Integers beyond the `limit` of the dimensions, where squared distances would no longer
fit in 64 bits, count as the limit.  The first codebook is of the smallest distinct vec_ids; of rows that
share one, of the least vector; null is the last id.  With fewer ids there are fewer entries.  Repeated rows are
rows of their own.  Without rows left the result is empty.  A label's error that is too large for a long is
null.  Further columns are kept, whatever their names are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from recordspark.llm.common import discard, store, table

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Vectors that a worker computes with at once.
PIECE = 4096
#: Labels whose sums are broadcast; with more, rows and sums are joined by a shuffle.
FEW_LABELS = 100_000
_SIGN = 1 << 31


@dataclass(frozen=True)
class Codebooks:
    """entries: part x entry x position; parts shorter than the longest are filled up with zeros, lengths has their own."""

    entries: np.ndarray
    lengths: tuple[int, ...]

    def digest(self) -> str:
        """SHA-256 of all components as decimal integers, by part, entry and position."""
        numbers = (str(x) for part, n in zip(self.entries, self.lengths, strict=True) for entry in part for x in entry[:n])
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()

    def decode(self, code: str) -> np.ndarray:
        """The integers that a code stands for."""
        return np.concatenate([part[i][:n] for part, i, n in zip(self.entries, bytes.fromhex(code), self.lengths, strict=True)])


def limit(dimensions: int) -> int:
    """The largest integer for which squared distances of as many dimensions fit in 64 bits."""
    return min(_SIGN - 1, int((2.0**61 / max(1, dimensions)) ** 0.5) // 2)


def pack(vectors: pa.Array, scale: int) -> tuple[np.ndarray, list[bytes]]:
    """Which vectors take part, and their integers, big-endian with the sign flipped, so that bytes are in the order of numbers."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    lengths = np.where(vectors.is_valid().to_numpy(zero_copy_only=False), vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), 0)
    flat = vectors.flatten()
    values = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
    taken = vectors.is_valid().to_numpy(zero_copy_only=False) & (bad[ends] == bad[ends - lengths])
    with np.errstate(over="ignore", invalid="ignore"):
        numbers = np.clip(np.nan_to_num(np.floor(values * scale)), -_SIGN + 1, _SIGN - 1).astype(np.int64)
    data = (numbers + _SIGN).astype(">u4").tobytes()
    return taken, [data[4 * (e - n) : 4 * e] for e, n in zip(ends[taken].tolist(), lengths[taken].tolist(), strict=True)]


def _packed(scale: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            taken, data = pack(b.column(1), scale)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(taken)), pa.array(data, pa.binary())], ["row", "q"])

    return run


@dataclass(frozen=True)
class _Cut:
    """How vectors of `dimensions` are cut into parts."""

    dimensions: int
    parts: int

    @property
    def lengths(self) -> tuple[int, ...]:
        return tuple((j + 1) * self.dimensions // self.parts - j * self.dimensions // self.parts for j in range(self.parts))

    def of(self, packed: list[bytes]) -> np.ndarray:
        """vector x part x position."""
        whole = 4 * self.dimensions
        zero = _SIGN.to_bytes(4, "big")
        data = b"".join(p if len(p) == whole else p + zero * ((whole - len(p)) // 4) for p in packed)
        numbers = np.frombuffer(data, dtype=">u4").astype(np.int64).reshape(len(packed), self.dimensions) - _SIGN
        most = limit(self.dimensions)
        numbers = np.clip(numbers, -most, most)
        out = np.zeros((len(packed), self.parts, max(self.lengths, default=0)), dtype=np.int64)
        for j, n in enumerate(self.lengths):
            first = j * self.dimensions // self.parts
            out[:, j, :n] = numbers[:, first : first + n]
        return out


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter((x * (1 + 1e-12)).astype(np.float32), np.float32(np.inf))


def _down(x: np.ndarray) -> np.ndarray:
    return np.nextafter((x * (1 - 1e-12)).astype(np.float32), np.float32(-np.inf))


@dataclass(frozen=True)
class Step:
    """A codebook and how far its entries came since the one before (None: there is none)."""

    codebook: np.ndarray  # part x entry x position
    before: np.ndarray | None

    def moves(self) -> tuple[np.ndarray, np.ndarray]:
        """For each entry: how far it moved, and the largest move of the part's others."""
        moved = np.sqrt(((self.codebook - self.before) ** 2).sum(2).astype(np.float64)) * (1 + 1e-12)
        others = np.stack([np.delete(moved, e, axis=1).max(axis=1, initial=0.0) for e in range(moved.shape[1])], axis=1)
        return moved, others

    def halves(self) -> np.ndarray:
        """For each entry: half the way to the part's nearest other entry."""
        far = np.stack([((p[:, None] - p[None]) ** 2).sum(2) for p in self.codebook]).astype(np.float64)
        far[:, np.arange(far.shape[1]), np.arange(far.shape[1])] = np.inf
        return np.sqrt(far.min(2)) / 2 * (1 - 1e-12)

    def assign(self, x: np.ndarray, code: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Codes and bounds of vectors x (vector x part x position) after this step, and how many parts were scanned; code, upper and lower are of the step before."""
        n, parts, _ = x.shape
        part = np.broadcast_to(np.arange(parts), (n, parts))
        if self.before is None:
            code, upper, lower = np.zeros((n, parts), np.uint8), np.full((n, parts), np.inf, np.float32), np.zeros((n, parts), np.float32)
            bound = lower
        else:
            moved, others = self.moves()
            upper, lower = _up(upper + moved[part, code]), _down(lower - others[part, code])
            bound = np.maximum(lower, _down(self.halves())[part, code])
            loose = ~(upper < bound)
            own = ((x[loose] - self.codebook[part[loose], code[loose]]) ** 2).sum(1)
            upper[loose] = _up(np.sqrt(own.astype(np.float64)))
        scanned = 0
        code = code.copy()
        for j in range(parts):
            rows = np.flatnonzero(~(upper[:, j] < bound[:, j]))
            if not len(rows):
                continue
            scanned += len(rows)
            far = ((x[rows, j, None, :] - self.codebook[j][None]) ** 2).sum(2)
            best = far.argmin(1)  # the first of equals
            code[rows, j] = best
            least = far[np.arange(len(rows)), best]
            far[np.arange(len(rows)), best] = np.iinfo(np.int64).max
            second = far.min(1).astype(np.float64)
            upper[rows, j] = _up(np.sqrt(least.astype(np.float64)))
            lower[rows, j] = _down(np.sqrt(second))
        return code, upper, lower, scanned

    def error(self, x: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Squared distance of each vector to what its code stands for."""
        part = np.broadcast_to(np.arange(x.shape[1]), code.shape)
        return ((x - self.codebook[part, code]) ** 2).sum((1, 2))


def _states(column: pa.Array, n: int, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(n, 9 * parts)
    bounds = np.ascontiguousarray(data[:, parts:]).view("<f4")
    return data[:, :parts].copy(), bounds[:, :parts].copy(), bounds[:, parts:].copy()


def _assigned(step: Step, shape: _Cut, last: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, PIECE):
                b = whole.slice(i, PIECE)
                x = shape.of(b.column(1).to_pylist())
                state = (None, None, None) if step.before is None else _states(b.column(2), b.num_rows, shape.parts)
                code, upper, lower, _ = step.assign(x, *state)
                if last:
                    yield pa.RecordBatch.from_arrays([b.column(0), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(step.error(x, code))], ["row", "code", "error"])
                else:
                    data = np.concatenate([code, upper.astype("<f4").view(np.uint8).reshape(len(x), -1), lower.astype("<f4").view(np.uint8).reshape(len(x), -1)], axis=1)
                    yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([d.tobytes() for d in data], pa.binary())], ["row", "q", "s"])

    return run


def _summed(shape: _Cut, entries: int) -> Callable:
    """One row for each part and entry of a task: its count and its sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = max(shape.lengths, default=0)
        count, total = np.zeros((shape.parts, entries), np.int64), np.zeros((shape.parts, entries, width), np.int64)
        for whole in batches:
            for i in range(0, whole.num_rows, PIECE):
                b = whole.slice(i, PIECE)
                x, (code, _, _) = shape.of(b.column(0).to_pylist()), _states(b.column(1), b.num_rows, shape.parts)
                for j in range(shape.parts):
                    count[j] += np.bincount(code[:, j], minlength=entries)
                    np.add.at(total[j], code[:, j], x[:, j])
        part, entry = np.nonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(entry), pa.array(count[part, entry]), pa.array(total[part, entry].tolist(), pa.list_(pa.int64()))], ["part", "entry", "n", "total"])

    return run


def _replaced(codebook: np.ndarray, sums: DataFrame) -> np.ndarray:
    """The codebook with every used entry at the floor of its mean; one row an entry and position comes to the driver."""
    long = sums.select("part", "entry", "n", F.posexplode("total").alias("at", "x"))
    rows = long.groupBy("part", "entry", "at").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect()
    out = codebook.copy()
    for r in rows:
        out[r["part"], r["entry"], r["at"]] = int(r["x"]) // int(r["n"])
    return out


def first_codebook(packed: DataFrame, shape: _Cut, entries: int) -> np.ndarray:
    """The parts of the vectors with the smallest ids, from `packed` (id, q)."""
    whole = F.rpad("q", 4 * shape.dimensions, F.lit(_SIGN.to_bytes(4, "big")))  # a zero's bytes behind shorter vectors
    ids = packed.select("id").distinct().orderBy(F.col("id").asc_nulls_last()).limit(entries)
    rows = packed.join(F.broadcast(ids.withColumnRenamed("id", "_id")), F.col("id").eqNullSafe(F.col("_id"))).groupBy("id").agg(F.min(whole).alias("q"))
    found = rows.orderBy(F.col("id").asc_nulls_last()).collect()  # one row an entry
    return shape.of([bytes(r["q"]) for r in found]).transpose(1, 0, 2)


def encode(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """The rows that take part with _code (bytes, one a part) and _error, and the codebooks.

    The columns of the rows are in the struct `row`, by position (c0, c1, ...).
    """
    spark = vectors.sparkSession
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(vectors.columns) if c != vector])
    light = vectors.select(row.alias("row"), F.col(vector).alias("v"))
    kind = StructField("row", light.schema["row"].dataType)
    binary = lambda c: StructField(c, BinaryType())
    rows, path = store(light.mapInArrow(_packed(scale), StructType([kind, binary("q")])))
    shape = _Cut((rows.agg(F.max(F.octet_length("q"))).first()[0] or 0) // 4, parts)
    codebook, before = first_codebook(rows.select(F.col(f"row.c{vectors.columns.index(key)}").alias("id"), "q"), shape, entries), None
    for _ in range(rounds):
        assigned, new = store(rows.mapInArrow(_assigned(Step(codebook, before), shape, False), StructType([kind, binary("q"), binary("s")])))
        discard(spark, path)
        rows, path = assigned, new
        sums = rows.select("q", "s").mapInArrow(_summed(shape, codebook.shape[1]), "part long, entry long, n long, total array<long>")
        codebook, before = _replaced(codebook, sums), codebook
    coded, _ = store(rows.mapInArrow(_assigned(Step(codebook, before), shape, True), StructType([kind, binary("code"), StructField("error", LongType())])))
    discard(spark, path)
    return coded, Codebooks(codebook, shape.lengths)


def with_label_error(coded: DataFrame) -> DataFrame:
    """`coded` (label, error, ...) with label_error, the error summed over equal labels, nulls together."""
    total = F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error")
    sums = coded.groupBy(F.col("label").alias("_label")).agg(total)
    few = sums.limit(FEW_LABELS + 1).count() <= FEW_LABELS
    return coded.join(F.broadcast(sums) if few else sums, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = encode(table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"))
    flat = coded.select(F.col("row.c0").alias("vec_id"), F.col("row.c1").alias("label"), F.lower(F.hex("code")).alias("code"), "error")
    return with_label_error(flat).select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))
