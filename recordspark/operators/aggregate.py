"""Typed aggregation over a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame

from recordspark.functions.predicates import Condition
from recordspark.plans.query import Query
from recordspark.sources.catalog import Catalog


def aggregate_records(catalog: Catalog, table: str, select: Mapping[str, Column], group_by: Sequence[str] = (), group_all: bool = False, where: Condition | None = None) -> DataFrame:
    """The keys and the named aggregates, by group or (group_all) for the whole input."""
    if not select:
        raise ValueError("nothing to select")
    if bool(group_by) == group_all:
        raise ValueError("either group_by or group_all is needed")
    q = Query().from_table(table).select(*group_by, *[c.alias(k) for k, c in select.items()])
    q = q.group_all() if group_all else q.group_by(*group_by)
    return (q if where is None else q.where(where)).frame(catalog)
