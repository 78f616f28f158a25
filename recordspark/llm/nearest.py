"""Approximate nearest neighbours by inner product: stable projections under a kd-tree.

Vectors get one more component so that all have the largest norm M; with a zero there for queries, the
nearest by Euclidean distance is the one of the largest inner product.  A seeded Gaussian (2-stable) map
takes them to M_DIMS dimensions, where a squared distance is the true one times a chi-square variable of
M_DIMS degrees.  A kd-tree over the projections, split at medians of a bounded sample, deals every vector
to a cell.

1. A query searches the NEAREST_CELLS cells with the nearest boxes; its k-th best distance there bounds the
   true one.
2. By the chi-square test, a vector at that distance or less has, with probability CONFIDENCE, a projected
   distance of at most bound * quantile.  The query visits just the cells whose boxes reach that close, found
   from the top of the tree.  In a cell, vectors are verified in shells of growing projected distance, with
   the bound shrinking, until the test holds for all that follow.  Only those within the bound are sent on.
3. The verified ones of all cells are merged by their exact inner products.

Cells of more than CELL rows (a vector that a third of the rows share can't be split by the tree) are
salted: their rows are dealt to several tasks and the query visits each.  Visits are counted before vectors
move: a cell that no query visits stays where it is, and one that more than QUERIES visit is copied once
for each QUERIES of its own visits.  So no task holds more than about CELL vectors and QUERIES queries.  How
many cells a query visits is up to the data: few where they are clustered; where they fill all dimensions
evenly, the test leaves a fixed share of all vectors, and the work grows with the square of their number.

Defined results: vectors that are null, zero, or hold a null or non-finite component, and rows without an
id, take no part.  Only vectors of equal length meet.  Rows that share an id are one candidate, the best of
them, and one query.  With fewer than k candidates all are returned.  An empty table gives no rows.
Further columns don't matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from recordspark.llm.common import cut, share, table
from recordspark.llm.words import mix

M_DIMS, CONFIDENCE, SEED = 8, 0.95, 3
CELL, CELLS, QUERIES, SAMPLE_PER_CELL = 1536, 1 << 16, 8192, 16
#: Counts of visits, one for each CELL vectors, are broadcast up to this many and shuffled beyond.
BROADCAST_COUNTS = 1 << 20
#: Cells that give a query its first bound; shells of verification, as shares of what the test still allows.
NEAREST_CELLS, SHELLS = 4, (0.5, 0.75, 1.0)
#: Pairs of vectors that are multiplied at once.
PAIRS = 1 << 14
FOUND = "query_id long, vec_id long, score double"


def chi_square_quantile(p: float, m: int) -> float:
    """The quantile of a chi-square variable with an even number m of degrees, by bisection."""
    low, high = 0.0, 40.0 * m
    for _ in range(200):
        x = (low + high) / 2
        below = 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(m // 2))
        low, high = (x, high) if below < p else (low, x)
    return high


def projection(dims: int, seed: int = SEED) -> np.ndarray:
    """The map of a vector with its one further component."""
    return np.random.default_rng([seed, dims]).normal(size=(dims + 1, M_DIMS))


def project(vectors: np.ndarray, largest: float | None) -> np.ndarray:
    """Of data (largest: the largest squared norm), or of queries (None)."""
    extra = np.zeros(len(vectors)) if largest is None else np.sqrt(np.maximum(largest - (vectors * vectors).sum(axis=1), 0))
    return np.column_stack([vectors, extra]) @ projection(vectors.shape[1])


class Tree:
    """A kd-tree of 2 ** depth cells, split at medians."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth = depth
        n = (1 << depth) - 1
        self.axis, self.at = np.zeros(n, dtype=np.int64), np.zeros(n)
        self.boxes: list[tuple[np.ndarray, np.ndarray]] = []
        self._split(0, 0, np.arange(len(sample)), sample)

    def _split(self, node: int, level: int, rows: np.ndarray, sample: np.ndarray) -> None:
        if level == self.depth:
            return
        points = sample[rows]
        axis = int(np.argmax(points.max(axis=0) - points.min(axis=0))) if len(rows) else 0
        at = float(np.median(points[:, axis])) if len(rows) else 0.0
        self.axis[node], self.at[node] = axis, at
        right = points[:, axis] > at if len(rows) else np.zeros(0, dtype=bool)
        self._split(2 * node + 1, level + 1, rows[~right], sample)
        self._split(2 * node + 2, level + 1, rows[right], sample)

    def cells(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), dtype=np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (points[np.arange(len(points)), self.axis[node]] > self.at[node])
        return node - ((1 << self.depth) - 1)

    def fit_boxes(self, boxes: dict[int, tuple[list[float], list[float]]]) -> None:
        """Shrink the cells' boxes to what is in them; cells without rows get boxes out of reach."""
        low, high = np.full((1 << self.depth, M_DIMS), np.inf), np.full((1 << self.depth, M_DIMS), -np.inf)
        for cell, (least, most) in boxes.items():
            low[cell], high[cell] = least, most
        self.boxes = [(low, high)]
        for _ in range(self.depth):  # the boxes of the inner nodes, level by level
            low, high = np.minimum(low[::2], low[1::2]), np.maximum(high[::2], high[1::2])
            self.boxes.insert(0, (low, high))

    def _squared(self, level: int, points: np.ndarray, node: np.ndarray) -> np.ndarray:
        low, high = self.boxes[level]
        d = np.maximum(np.maximum(low[node] - points, points - high[node]), 0)
        return (d * d).sum(axis=1)

    def reached(self, points: np.ndarray, squared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(point, cell) of all boxes within a squared distance of each point."""
        rows, cells = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for i in range(0, len(points), 64):
            row = np.arange(i, min(len(points), i + 64))
            node = np.zeros(len(row), dtype=np.int64)
            for level in range(self.depth + 1):
                d = self._squared(level, points[row], node)
                near = (d <= squared[row]) & (d < np.inf)
                row, node = row[near], node[near]
                if level < self.depth:
                    row, node = np.repeat(row, 2), (2 * node[:, None] + np.arange(2)).ravel()
            rows.append(row)
            cells.append(node)
        return np.concatenate(rows), np.concatenate(cells)

    def nearest(self, points: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(point, cell) of up to n cells with near boxes: of each level, the 4 * n nearest are followed."""
        rows, cells = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for i in range(0, len(points), 256):
            row = np.arange(i, min(len(points), i + 256))
            node = np.zeros(len(row), dtype=np.int64)
            for level in range(self.depth + 1):
                d = self._squared(level, points[row], node)
                order = np.lexsort((node, d, row))
                row, node, d = row[order], node[order], d[order]
                place = np.arange(len(row)) - np.searchsorted(row, row)
                near = (d < np.inf) & (place < (n if level == self.depth else 4 * n))
                row, node = row[near], node[near]
                if level < self.depth:
                    row, node = np.repeat(row, 2), (2 * node[:, None] + np.arange(2)).ravel()
            rows.append(row)
            cells.append(node)
        return np.concatenate(rows), np.concatenate(cells)


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equally long vectors as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """id, vec (array of floats, if they are floats, or else of doubles) and dims of the rows that take part."""
    kind = vectors.schema[embedding].dataType
    x = F.col(embedding) if kind.typeName() == "array" and kind.elementType.typeName() == "float" else F.col(embedding).cast("array<double>")
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), x.alias("vec")).where("id is not null and vec is not null and size(vec) > 0")
    fine = F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return rows.where(fine & F.exists("vec", lambda v: v != 0)).withColumn("dims", F.size("vec"))


def squared_norm(start: float) -> Column:
    return F.aggregate("vec", F.lit(start), lambda a, v: a + v.cast("double") * v.cast("double"))


def search(ids: np.ndarray, vectors: np.ndarray, q_ids: np.ndarray, q: np.ndarray, bound: np.ndarray, largest: float, quantile: float, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, inner product) of verified neighbours within the queries' bounds, in one cell.

    bound: squared distances; largest: the largest squared norm.  Projected neighbours are verified shell by
    shell; a query stops at the shell behind which the chi-square test holds for its bound.
    """
    shadows, q_shadows = project(vectors, largest), project(q, None)
    near = (shadows * shadows).sum(axis=1) - 2 * (q_shadows @ shadows.T) + (q_shadows * q_shadows).sum(axis=1)[:, None]
    base, bound = (q * q).sum(axis=1) + largest, bound.copy()
    # a product of matrices tells who is surely beyond the bound; the others' inner products are computed pair by pair
    about = base[:, None] - 2 * (q @ vectors.T) - 1e-9 * base[:, None]
    shared = len(np.unique(ids)) < len(ids)
    found: list[tuple[np.ndarray, ...]] = []
    reached = np.full(len(q), -np.inf)
    for shell in SHELLS:
        edge = np.maximum(np.where(np.isfinite(bound), bound * quantile * shell, np.inf), reached)
        row, column = np.nonzero((near > reached[:, None]) & (near <= edge[:, None]) & (about <= bound[:, None]))
        reached = edge
        other = ids[column] != q_ids[row]
        row, column = row[other], column[other]
        score = np.concatenate([np.einsum("ij,ij->i", q[row[i : i + PAIRS]], vectors[column[i : i + PAIRS]]) for i in range(0, len(row), PAIRS)] or [np.zeros(0)])
        within = base[row] - 2 * score <= bound[row] * (1 + 1e-9)
        found.append((row[within], column[within], score[within]))
        row, column, score = (np.concatenate(x) for x in zip(*found, strict=True))
        if shared:  # of several vectors with one id, the best
            order = np.lexsort((-score, ids[column], row))
            row, column, score = row[order], column[order], score[order]
            best = np.ones(len(row), dtype=bool)
            best[1:] = (row[1:] != row[:-1]) | (ids[column[1:]] != ids[column[:-1]])
            row, column, score = row[best], column[best], score[best]
        # the k best of each query, and the bound where there are k
        order = np.lexsort((ids[column], -score, row))
        row, column, score = row[order], column[order], score[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        keep = place < k
        found = [(row[keep], column[keep], score[keep])]
        last = keep & (place == k - 1)
        bound[row[last]] = np.minimum(bound[row[last]], np.maximum(base[row[last]] - 2 * score[last], 0.0))
    return found[0]


def neighbours(vectors: DataFrame, k: int, every: int, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest found for each id divisible by `every`."""
    data = cut(usable(vectors, vec_id, embedding))
    spark = data.sparkSession
    shapes = {r["dims"]: (r["n"], r["largest"]) for r in data.groupBy("dims").agg(F.count("*").alias("n"), F.max(squared_norm(0.0)).alias("largest")).collect()}
    quantile = chi_square_quantile(CONFIDENCE, M_DIMS)
    found = None
    for dims, (n, largest) in sorted(shapes.items()):  # as many as there are lengths of vectors
        part = _of_one_length(data.where(F.col("dims") == dims), n, largest, quantile, k, every)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], FOUND)
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _of_one_length(data: DataFrame, n: int, largest: float, quantile: float, k: int, every: int) -> DataFrame:
    depth = min(max(0, math.ceil(math.log2(n / CELL))), int(math.log2(CELLS)))
    kind = dict(data.dtypes)["vec"]
    vec = pa.list_(pa.float32() if kind == "array<float>" else pa.float64())

    def shadowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(project(matrix(b.column(0)), largest).tolist(), pa.list_(pa.float64()))], ["x"])

    drawn = data.where(share("id") < F.lit((SAMPLE_PER_CELL << depth) / n)).select("vec").mapInArrow(shadowed, "x array<double>").toArrow()["x"]  # SAMPLE_PER_CELL rows a cell
    tree = Tree(matrix(drawn) if len(drawn) else np.zeros((0, M_DIMS)), depth)

    def boxed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                points = project(matrix(b.column(0)), largest)
                cell = tree.cells(points)
                order = np.argsort(cell, kind="stable")
                points, (own, first, n_) = points[order], np.unique(cell[order], return_index=True, return_counts=True)
                low, high = (f.reduceat(points, first, axis=0) for f in (np.minimum, np.maximum))
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(n_), pa.array(low.tolist(), pa.list_(pa.float64())), pa.array(high.tolist(), pa.list_(pa.float64()))], ["cell", "n", "low", "high"])

    boxes = data.select("vec").mapInArrow(boxed, "cell long, n long, low array<double>, high array<double>").groupBy("cell")
    side = lambda f, name: F.array(*[f(F.col(name)[i]) for i in range(M_DIMS)]).alias(name)
    boxes = boxes.agg(F.sum("n").alias("n"), side(F.min, "low"), side(F.max, "high")).collect()  # at most CELLS rows
    tree.fit_boxes({r["cell"]: (r["low"], r["high"]) for r in boxes})
    salts = np.ones(1 << depth, dtype=np.int64)
    for r in boxes:
        salts[r["cell"]] = math.ceil(r["n"] / CELL)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                cell = tree.cells(project(matrix(b.column(1)), largest))
                salt = (mix(b.column(0).to_numpy().astype(np.uint64)) >> np.uint64(1)).astype(np.int64) % salts[cell]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cell), pa.array(salt)], ["id", "vec", "cell", "salt"])

    placed = data.select("id", "vec").mapInArrow(dealt, f"id long, vec {kind}, cell long, salt long")
    queries = data.where(F.col("id") % every == 0).select("id", "vec")

    def visited(b: pa.RecordBatch, home: bool) -> tuple[np.ndarray, ...]:
        """Query, cell, salt and bound: of the nearest cells (one salt of each), or of all others in reach of the query's bound."""
        points = project(matrix(b.column(1)), None)
        if home:
            row, cell = tree.nearest(points, NEAREST_CELLS)
            return row, cell, b.column(0).to_numpy()[row] % salts[cell], np.full(len(row), np.inf)
        bound = b.column(2).to_numpy(zero_copy_only=False).astype(np.float64)
        bound = np.where(np.isnan(bound), np.inf, bound)
        row, cell = tree.reached(points, bound * quantile)
        times = salts[cell]
        salt = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        row, cell = np.repeat(row, times), np.repeat(cell, times)
        # what the first pass has searched whole isn't searched again
        old, old_cell = tree.nearest(points, NEAREST_CELLS)
        place = lambda r, c, s: (r * (1 << depth) + c) * salts.max() + s
        new = ~np.isin(place(row, cell, salt), place(old, old_cell, b.column(0).to_numpy()[old] % salts[old_cell]))
        row, cell, salt = row[new], cell[new], salt[new]
        return row, cell, salt, bound[row]

    def visits(batches: Iterator[pa.RecordBatch], home: bool) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                row, *rest = visited(b, home)
                for i in range(0, len(row), 4096):
                    r = pa.array(row[i : i + 4096])
                    yield pa.RecordBatch.from_arrays([b.column(0).take(r), b.column(1).take(r).cast(vec), *[pa.array(x[i : i + 4096]) for x in rest]], ["id", "vec", "cell", "salt", "bound"])

    def counted(batches: Iterator[pa.RecordBatch], home: bool) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                _, cell, salt, _ = visited(b, home)
                place, times = np.unique(np.column_stack([cell, salt]), axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(place[:, 0]), pa.array(place[:, 1]), pa.array(times)], ["cell", "salt", "visits"])

    def searched(key, left: pa.Table, right: pa.Table) -> pa.Table:
        parts = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0))]
        if left.num_rows and right.num_rows:
            ids, x = left["id"].to_numpy(), matrix(left["vec"])
            q_ids, q, bound = right["id"].to_numpy(), matrix(right["vec"]), right["bound"].to_numpy()
            for i in range(0, len(q), 128):
                row, column, score = search(ids, x, q_ids[i : i + 128], q[i : i + 128], bound[i : i + 128], largest, quantile, k)
                parts.append((q_ids[i : i + 128][row], ids[column], score))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)], names=["query_id", "vec_id", "score"])

    def meet(asked: DataFrame, home: bool) -> DataFrame:
        """Each query with the rows of the cells that it visits; a cell's rows go to as many blocks as its visits need."""
        blocks = asked.mapInArrow(lambda b: counted(b, home), "cell long, salt long, visits long").groupBy("cell", "salt").agg(F.ceil(F.sum("visits") / QUERIES).cast("int").alias("blocks"))
        blocks = cut(blocks)  # a row for each CELL vectors
        blocks = F.broadcast(blocks) if blocks.count() <= BROADCAST_COUNTS else blocks
        left = placed.join(blocks, ["cell", "salt"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
        right = asked.mapInArrow(lambda b: visits(b, home), f"id long, vec {kind}, cell long, salt long, bound double").join(blocks, ["cell", "salt"])
        right = right.withColumn("block", F.pmod(F.xxhash64("id", F.lit("block")), F.col("blocks")).cast("int")).drop("blocks")
        keys = ["cell", "salt", "block"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(searched, FOUND)

    first = cut(meet(queries, True))
    # the squared distance of the k-th best; unknown where the cell has fewer candidates
    one = first.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).groupBy("query_id")
    kth = one.agg(F.when(F.count("*") >= k, F.sort_array(F.collect_list("score"), asc=False)[k - 1]).alias("kth"))
    bounded = queries.join(kth, queries["id"] == kth["query_id"], "left").select("id", "vec", (squared_norm(largest) - 2 * F.col("kth")).alias("bound"))
    bounded = cut(bounded.withColumn("bound", F.greatest(F.col("bound"), F.lit(0.0)) * (1 + 1e-9)))
    return first.unionByName(meet(bounded, False))


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(table(spark, sf_dir, "embeddings"), 20, 20)
