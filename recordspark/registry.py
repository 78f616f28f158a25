"""Where queries over the folder of tables are registered, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from recordspark.plans.query import Query
from recordspark.sources.catalog import Catalog, files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None) -> Callable:
    """Register a function of a catalog under its name."""

    def register(f: Callable[[Catalog], DataFrame]) -> Callable[[Catalog], DataFrame]:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(files(spark, sf_dir))
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def over(table: str) -> Query:
    return Query().from_table(table)
