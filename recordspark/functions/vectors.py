"""Vector metrics as expressions over two arrays, in double precision."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Metrics that grow with nearness; the others are distances.
SIMILARITIES = {"COSINE", "JACCARD", "PEARSON"}
METRICS = {"COSINE", "EUCLIDEAN", "MANHATTAN", "CHEBYSHEV", "MINKOWSKI", "HAMMING", "JACCARD", "PEARSON", "MAHALANOBIS"}


def _doubles(x: Column | str) -> Column:
    return (F.col(x) if isinstance(x, str) else x).cast("array<double>")


def _sum(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda a, v: a + v)


def _dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x * y))


def _moments(a: Column) -> Column:
    """The sums of x and of its square, in one pass."""
    start = F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("xx"))
    return F.aggregate(a, start, lambda s, v: F.struct((s["x"] + v).alias("x"), (s["xx"] + v * v).alias("xx")))


def score(column: Column | str, vector: Sequence[float], metric: str = "COSINE", p: float = 3.0, inverse: Sequence[Sequence[float]] | None = None) -> Column:
    """The metric between an array column and a vector.  p: of MINKOWSKI; inverse: the inverse covariance for MAHALANOBIS.

    COSINE with a zero vector, PEARSON with a constant one, and JACCARD of two empty ones are null.
    """
    metric = metric.upper()
    if metric not in METRICS:
        raise ValueError(f"unknown metric: {metric}")
    if not len(vector):
        raise ValueError("empty vector")
    a, b = _doubles(column), F.array(*[F.lit(float(v)) for v in vector])
    if metric == "COSINE":
        norm = float(sum(v * v for v in map(float, vector))) ** 0.5
        return F.try_divide(_dot(a, b), F.sqrt(_dot(a, a)) * F.lit(norm))
    if metric == "EUCLIDEAN":
        return F.sqrt(_sum(F.zip_with(a, b, lambda x, y: (x - y) * (x - y))))
    if metric == "MANHATTAN":
        return _sum(F.zip_with(a, b, lambda x, y: F.abs(x - y)))
    if metric == "CHEBYSHEV":
        return F.array_max(F.zip_with(a, b, lambda x, y: F.abs(x - y)))
    if metric == "MINKOWSKI":
        return F.pow(_sum(F.zip_with(a, b, lambda x, y: F.pow(F.abs(x - y), F.lit(float(p))))), F.lit(1.0 / p))
    if metric == "HAMMING":
        return _sum(F.zip_with(a, b, lambda x, y: (x != y).cast("double")))
    if metric == "JACCARD":
        return F.try_divide(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b)))
    if metric == "PEARSON":
        n = len(vector)
        mean = sum(map(float, vector)) / n
        centred = F.array(*[F.lit(float(v) - mean) for v in vector])
        spread = sum((float(v) - mean) ** 2 for v in vector) ** 0.5
        # n times the variance is the sum of squares less the squared sum over n; what rounding leaves of it for equal values is 0
        variance = F.transform(F.array(_moments(a)), lambda s: F.when(s["xx"] - s["x"] * s["x"] / n > 1e-12 * s["xx"], s["xx"] - s["x"] * s["x"] / n).otherwise(F.lit(0.0)))[0]
        return F.try_divide(_dot(a, centred), F.sqrt(variance) * F.lit(spread))
    if inverse is None:
        raise ValueError("MAHALANOBIS needs the inverse covariance")
    d = F.zip_with(a, b, lambda x, y: x - y)
    rows = [_dot(d, F.array(*[F.lit(float(v)) for v in row])) for row in inverse]
    return F.sqrt(_dot(d, F.array(*rows)))


def is_similarity(metric: str) -> bool:
    return metric.upper() in SIMILARITIES
