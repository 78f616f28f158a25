"""Vector indexes: a table's rows in cells of near vectors, a folder for each cell.

Centres of cells come from a bounded sample; every row goes to the cell of its nearest centre, in the index's own
metric, with all its columns.  A search reads the cells of the nearest centres alone, as partitions that are
pruned, and ranks their rows exactly.  How many cells those are is chosen when the index is built, so that the
neighbours of the sample's vectors are found with the wanted recall.

All metrics are brought to a distance that keeps the triangle inequality (unit vectors for COSINE, centred
ones for PEARSON, one less the overlap for JACCARD), and each cell has its radius.  So an exact search needs no full
scan either: the first cells give a bound, and only cells that can hold something nearer than it are read.

Defined results: vectors that are null, of another length, hold null or non-finite components or have no score in
the metric (zero ones for COSINE, constant ones for PEARSON) are in a cell of their own, which only searches
read that find fewer rows than they want.  Repeated rows are kept.  The index is a copy of the rows as they were.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordspark.functions import vectors
from recordspark.sources.storage import cut

#: Metrics whose distance is the root of a sum of squares.
ROOTS = ("EUCLIDEAN", "COSINE", "PEARSON")
METRICS = ("COSINE", "EUCLIDEAN", "MANHATTAN", "MINKOWSKI", "CHEBYSHEV", "HAMMING", "JACCARD", "PEARSON")
#: Sampled vectors for each cell and in all, cells, queries that the number of cells to read is chosen by, and rounds of the centres.
SAMPLE_A_CELL, SAMPLE, MOST_CELLS, TRIED, ROUNDS = 64, 100_000, 4096, 200, 8
#: Distances that are held at once.
PAIRS = 1 << 22
#: The table of cells.
CELLS = "cell int, centre array<double>, radius double, field string, metric string, dimension int, probes int, rows string"
#: The cell of vectors without a score.
NOWHERE = -1
#: What rounding may make of distances.
SLACK = 1e-6


def normal(x: np.ndarray, metric: str) -> np.ndarray:
    """Vectors (rows) in the form in which distances are taken; rows without a score hold NaN."""
    if metric == "PEARSON":
        x = x - x.mean(1, keepdims=True)
        x[(x * x).sum(1) <= 1e-24] = 0.0
    if metric in ("COSINE", "PEARSON"):
        with np.errstate(divide="ignore", invalid="ignore"):
            return x / np.sqrt((x * x).sum(1, keepdims=True))
    return x


def far(x: np.ndarray, centres: np.ndarray, metric: str) -> np.ndarray:
    """Distances of vectors to centres, both in normal form."""
    if metric in ROOTS:
        square = (x * x).sum(1)[:, None] + (centres * centres).sum(1) - 2 * x @ centres.T
        return np.sqrt(np.maximum(square, 0.0))
    if metric == "JACCARD":
        return _overlaps(x, centres)
    out = np.zeros((len(x), len(centres)))
    for j in range(x.shape[1]):
        step = np.abs(x[:, j, None] - centres[None, :, j])
        if metric == "CHEBYSHEV":
            np.maximum(out, step, out=out)
        else:
            out += step if metric == "MANHATTAN" else step**3 if metric == "MINKOWSKI" else step != 0
    return np.cbrt(out) if metric == "MINKOWSKI" else out


def _distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and value of each distinct value of the rows, and how many each row has."""
    x = np.sort(x, axis=1)
    new = np.ones(x.shape, dtype=bool)
    new[:, 1:] = x[:, 1:] != x[:, :-1]
    row, column = np.nonzero(new)
    return row, x[row, column], new.sum(1)


def _overlaps(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """One less the overlap of the sets of values: each value finds the centres that have it, so what shares nothing costs nothing."""
    row, value, size = _distinct(x)
    owner, held, others = _distinct(centres)
    order = np.argsort(held, kind="stable")
    owner, held = owner[order], held[order]
    lo, hi = np.searchsorted(held, value, "left"), np.searchsorted(held, value, "right")
    hit = np.flatnonzero(hi > lo)
    row, lo, n = row[hit], lo[hit], (hi - lo)[hit]
    shared, upto = np.zeros(len(x) * len(centres)), np.cumsum(n)
    at = 0
    while at < len(n):  # PAIRS pairs of equal values at a time, or those of one value
        stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS, "right")))
        m = n[at:stop]
        place = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m) + np.repeat(lo[at:stop], m)
        pair, times = np.unique(np.repeat(row[at:stop], m) * len(centres) + owner[place], return_counts=True)
        shared[pair] += times
        at = stop
    shared = shared.reshape(len(x), len(centres))
    return 1 - shared / (size[:, None] + others - shared)


def nearest(x: np.ndarray, centres: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each vector and the distance to it, PAIRS distances at a time."""
    step, cell, away = max(1, PAIRS // len(centres)), np.zeros(len(x), dtype=np.int64), np.zeros(len(x))
    for i in range(0, len(x), step):
        s = slice(i, i + step)
        d = far(x[s], centres, metric)
        cell[s], away[s] = d.argmin(1), d.min(1)
        if metric in ROOTS:  # a product of matrices finds the centre, but is too rough for a radius
            away[s] = np.sqrt(((x[s] - centres[cell[s]]) ** 2).sum(1))
    return cell, away


def distance_of(score: float, metric: str) -> float:
    """The distance that a score stands for."""
    if metric in ("COSINE", "PEARSON"):
        return math.sqrt(max(0.0, 2 - 2 * score))
    return 1 - score if metric == "JACCARD" else score


def _matrix(column: pa.Array, dimension: int, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors of a column have a score, and those in normal form."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    whole = column.is_valid().to_numpy(zero_copy_only=False) & (column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False) == dimension)
    flat = column.filter(pa.array(whole)).flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    x = normal(flat.reshape(-1, dimension).copy(), metric)
    good = np.isfinite(x).all(1)
    whole[whole] = good
    return whole, x[good]


def centres_of(sample: np.ndarray, cells: int, metric: str, seed: int = 1) -> np.ndarray:
    """Centres in normal form: means for metrics in which they are meant, else vectors of the sample."""
    distinct = np.unique(sample, axis=0)
    centres = distinct[np.random.default_rng(seed).permutation(len(distinct))[:cells]]
    for _ in range(0 if metric in ("HAMMING", "JACCARD") else ROUNDS):
        cell, _ = nearest(sample, centres, metric)
        n = np.bincount(cell, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, cell, sample)
        centres = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centres)
    return centres


def probes_for(sample: np.ndarray, centres: np.ndarray, metric: str, recall: float, k: int) -> int:
    """How many cells hold the k nearest of a sampled vector, for the wanted share of them."""
    tried = sample[: min(TRIED, len(sample))]
    if len(sample) <= 1:
        return len(centres)
    cell, _ = nearest(sample, centres, metric)
    near = far(tried, sample, metric)
    near[np.arange(len(tried)), np.arange(len(tried))] = np.inf
    neighbours = np.argsort(near, 1, kind="stable")[:, : min(k, len(sample) - 1)]
    place = np.argsort(np.argsort(far(tried, centres, metric), 1, kind="stable"), 1)  # of each cell in the order of each vector
    needed = np.sort(np.take_along_axis(place, cell[neighbours], 1).ravel())
    return int(needed[math.ceil(recall * len(needed)) - 1]) + 1


@dataclass(frozen=True)
class Cells:
    """What is known of all cells; rows are those of centres, radii and sizes."""

    numbers: np.ndarray
    centres: np.ndarray
    radii: np.ndarray

    def nearest(self, q: np.ndarray, metric: str, probes: int) -> list[int]:
        order = np.argsort(self._far(q, metric), kind="stable")
        return [int(c) for c in self.numbers[order[:probes]]]

    def _far(self, q: np.ndarray, metric: str) -> np.ndarray:
        return np.sqrt(((q - self.centres) ** 2).sum(1)) if metric in ROOTS else far(q, self.centres, metric)[0]

    def within(self, q: np.ndarray, metric: str, bound: float) -> list[int]:
        """Cells that can hold vectors no farther than the bound."""
        least = self._far(q, metric) - self.radii
        return [int(c) for c in self.numbers[least <= bound * (1 + SLACK) + SLACK]]


@dataclass(frozen=True)
class VectorIndex:
    path: str
    field: str
    metric: str
    dimension: int
    probes: int
    cells: Cells
    schema: T.StructType

    def __post_init__(self) -> None:
        if self.metric not in METRICS:
            raise ValueError(f"no index for the metric {self.metric}")

    def rows(self, spark: SparkSession, cells: Sequence[int] | None = None) -> DataFrame:
        """The rows of some cells (all: None), from their folders alone."""
        df = spark.read.schema(self.schema).parquet(f"{self.path}/rows")
        return (df if cells is None else df.where(F.col("_cell").isin(list(cells)))).select("_row.*")

    def query(self, vector: Sequence[float]) -> np.ndarray:
        """A query's vector in normal form; one that has no score raises."""
        q = normal(np.array([vector], dtype=np.float64), self.metric)
        if q.shape[1] != self.dimension or not np.isfinite(q).all():
            raise ValueError(f"the index on {self.field} takes vectors of {self.dimension} components that have a {self.metric} score")
        return q

    def near(self, spark: SparkSession, vector: Sequence[float], probes: int | None = None) -> DataFrame:
        """The rows of the cells nearest to a vector."""
        return self.rows(spark, self.cells.nearest(self.query(vector), self.metric, probes or self.probes))

    def exact(self, spark: SparkSession, vector: Sequence[float], k: int, kept: Callable[[DataFrame], DataFrame], threshold: float | None = None) -> DataFrame:
        """Rows among which the k nearest of those that `kept` keeps surely are.

        A first job finds the k-th score in the nearest cells.  A threshold bounds the cells too.
        """
        q, up = self.query(vector), vectors.is_similarity(self.metric)
        score = vectors.score(self.field, vector, self.metric).alias("_score")
        first = kept(self.near(spark, vector)).select(score).where(F.col("_score").isNotNull() & ~F.isnan("_score"))
        found = first.orderBy(F.desc("_score") if up else F.asc("_score")).limit(k).collect()
        bound = distance_of(found[-1][0], self.metric) if len(found) == k else math.inf
        if threshold is not None:
            bound = min(bound, distance_of(threshold, self.metric))
        return self.rows(spark) if math.isinf(bound) else self.rows(spark, self.cells.within(q, self.metric, bound))


def _placed(field: int, centres: np.ndarray, metric: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            there, x = _matrix(b.column(0).field(field), centres.shape[1], metric)
            cell, away = np.full(b.num_rows, NOWHERE, dtype=np.int32), np.zeros(b.num_rows)
            if len(x):
                cell[there], away[there] = nearest(x, centres, metric)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(away), pa.array(cell)], ["_row", "_far", "_cell"])

    return run


def _scored(x: Column, dimension: int) -> Column:
    return x.isNotNull() & (F.size(x) == dimension) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))


def build(rows: DataFrame, field: str, metric: str, path: str, cells: int | None = None, recall: float = 0.95, k: int = 10) -> VectorIndex:
    """Write an index of the rows to a new folder.

    cells: about the root of the number of rows without it.  The sample that centres and the number of cells to read
    come from has at most SAMPLE vectors, whatever the table is.
    """
    metric, column = metric.upper(), F.col(f"`{field}`")
    if metric not in METRICS:
        raise ValueError(f"no index for the metric {metric}")
    lengths = rows.where(column.isNotNull()).groupBy(F.size(column).alias("d")).count().orderBy(F.desc("count"), "d").first()
    dimension, n = (lengths["d"], lengths["count"]) if lengths else (0, 0)
    cells = cells or max(1, min(MOST_CELLS, round(math.sqrt(n))))
    wanted = min(SAMPLE, SAMPLE_A_CELL * cells)
    whole = rows.where(_scored(column, dimension)).select(column.cast("array<double>").alias("v"))
    drawn = whole if n <= wanted else whole.sample(min(1.0, 1.2 * wanted / n), seed=1).limit(wanted)
    found = [r["v"] for r in drawn.collect()]
    sample = normal(np.array(found, dtype=np.float64).reshape(len(found), dimension), metric)
    sample = sample[np.isfinite(sample).all(1)]
    centres = centres_of(sample, cells, metric) if len(sample) else np.zeros((0, dimension))
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row")
    light = rows.select(row)
    schema = T.StructType([T.StructField("_row", light.schema[0].dataType), T.StructField("_far", T.DoubleType()), T.StructField("_cell", T.IntegerType())])
    if len(centres):
        placed = light.mapInArrow(_placed(rows.columns.index(field), centres, metric), schema)
    else:
        placed = light.withColumns({"_far": F.lit(0.0), "_cell": F.lit(NOWHERE)})
    # rows of a cell come together; a cell of very many rows is split over several files
    placed.hint("rebalance", "_cell").write.partitionBy("_cell").parquet(f"{path}/rows")
    spark = rows.sparkSession
    written = spark.read.schema(schema).parquet(f"{path}/rows")
    radii = {r["_cell"]: r["far"] for r in written.groupBy("_cell").agg(F.max("_far").alias("far")).collect()}
    probes = probes_for(sample, centres, metric, recall, k) if len(centres) else 1
    told = [(i, [float(v) for v in c], float(radii[i]), field, metric, dimension, probes, schema.json()) for i, c in enumerate(centres) if i in radii]
    spark.createDataFrame(told or [(NOWHERE, [], 0.0, field, metric, dimension, probes, schema.json())], CELLS).coalesce(1).write.parquet(f"{path}/cells")
    return open_index(spark, path)


def add(spark: SparkSession, index: VectorIndex, rows: DataFrame) -> VectorIndex:
    """The index with more rows, of the same columns, in its cells; centres and the number of cells to read stay, radii grow."""
    row = F.struct(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in index.schema["_row"].dataType])
    light, at = rows.select(row.alias("_row")), index.schema["_row"].dataType.names.index(index.field)
    if not len(index.cells.numbers):
        raise ValueError("an index without a vector has no cells; build it anew")
    # cells are numbered by their place here, and by what they were called in the index
    numbers = index.cells.numbers
    named = F.when(F.col("_cell") != NOWHERE, F.get(F.array(*[F.lit(int(n)) for n in numbers]), F.col("_cell"))).otherwise(NOWHERE).cast("int")
    placed = cut(light.mapInArrow(_placed(at, index.cells.centres, index.metric), index.schema).withColumn("_cell", named))
    placed.hint("rebalance", "_cell").write.mode("append").partitionBy("_cell").parquet(f"{index.path}/rows")
    grown = {r["_cell"]: r["far"] for r in placed.groupBy("_cell").agg(F.max("_far").alias("far")).collect()}  # a row a cell
    radii = np.array([max(r, grown.get(int(n), 0.0)) for n, r in zip(numbers, index.cells.radii, strict=True)])
    told = [(int(n), [float(v) for v in c], float(r), index.field, index.metric, index.dimension, index.probes, index.schema.json()) for n, c, r in zip(numbers, index.cells.centres, radii, strict=True)]
    spark.createDataFrame(told, CELLS).coalesce(1).write.mode("overwrite").parquet(f"{index.path}/cells")
    return open_index(spark, index.path)


def open_index(spark: SparkSession, path: str) -> VectorIndex:
    """An index that `build` wrote."""
    found = spark.read.parquet(f"{path}/cells").orderBy("cell").collect()  # MOST_CELLS rows, at most
    own, any_ = [r for r in found if r["cell"] != NOWHERE], found[0]
    cells = Cells(np.array([r["cell"] for r in own], dtype=np.int64), np.array([r["centre"] for r in own]).reshape(len(own), any_["dimension"]), np.array([r["radius"] for r in own]))
    return VectorIndex(path, any_["field"], any_["metric"], any_["dimension"], any_["probes"], cells, T.StructType.fromJson(json.loads(any_["rows"])))
