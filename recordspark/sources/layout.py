"""Written layouts by the columns of an index: bucketed, sorted, with Bloom filters.

A layout is a copy of a table in buckets by a hash of the index's columns.  A lookup by the columns reads one bucket,
and in it the row groups that can hold the value; joins and groupings on the columns need no exchange where both
sides have layouts of as many buckets.  A query says by a hint that it reads a layout; other queries read the table.

Defined results: null values are in the first bucket, as Spark hashes them.  A value that very many rows have is in
one bucket, in several files.  Repeated rows stay.  The layout holds the rows as they were.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

BUCKETS = 64


@dataclass(frozen=True)
class Layout:
    """name: of the index; stored: the name of the table in the session's catalog."""

    name: str
    columns: tuple[str, ...]
    buckets: int
    path: str
    stored: str

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.stored)


def _named(name: str) -> str:
    return f"layout_{name}_{uuid.uuid4().hex[:12]}"


def write(rows: DataFrame, name: str, columns: Sequence[str], path: str, buckets: int = BUCKETS) -> Layout:
    """Write a layout of the rows to a new folder."""
    if not columns or buckets < 1:
        raise ValueError("a layout needs columns and buckets")
    stored, spark = _named(name), rows.sparkSession
    told = json.dumps({"name": name, "columns": list(columns), "buckets": buckets, "schema": rows.schema.json()})
    spark.createDataFrame([(told,)], "told string").coalesce(1).write.text(f"{path}/layout")
    writer = rows.hint("rebalance", *columns).write.format("parquet").bucketBy(buckets, *columns).sortBy(*columns)
    for c in columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.option("path", f"{path}/rows").saveAsTable(stored)
    return Layout(name, tuple(columns), buckets, path, stored)


def open_layout(spark: SparkSession, path: str) -> Layout:
    """A layout that `write` wrote, maybe in another session."""
    told = json.loads(spark.read.text(f"{path}/layout").first()[0])
    quoted = ", ".join(f"`{c}`" for c in told["columns"])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromJson(json.loads(told["schema"])))
    stored = _named(told["name"])
    spark.sql(f"CREATE TABLE {stored} ({fields}) USING parquet CLUSTERED BY ({quoted}) SORTED BY ({quoted}) INTO {told['buckets']} BUCKETS LOCATION '{path}/rows'")
    return Layout(told["name"], tuple(told["columns"]), told["buckets"], path, stored)
