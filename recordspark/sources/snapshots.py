"""Snapshots of schemas as JSON with a digest, what leads from one to another, and what going back would cost.

A digest depends on what is declared, not on the order of tables, fields, indexes or permissions.  Whether a step back is
SAFE, loses data (DATA_LOSS) or can't be done as declared (UNSAFE) is counted in the rows, with one aggregation for each
table.
"""

from __future__ import annotations

import dataclasses
import hashlib
import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordspark.sources.schema import EdgeSchema, Event, Field, Index, TableSchema, differences

#: The table of snapshots.
SNAPSHOTS = "version string, digest string, tables string"


def told(schema: TableSchema) -> dict[str, Any]:
    """A schema as JSON values."""
    return {"kind": "edge" if isinstance(schema, EdgeSchema) else "table", **dataclasses.asdict(schema)}


def read(values: Mapping[str, Any]) -> TableSchema:
    """The schema that `told` told."""
    v = dict(values)
    kind = EdgeSchema if v.pop("kind") == "edge" else TableSchema
    v["fields"] = tuple(Field(**f) for f in v["fields"])
    v["indexes"] = tuple(Index(**{**i, "columns": tuple(i["columns"])}) for i in v["indexes"])
    v["permissions"] = tuple((a, c) for a, c in v["permissions"])
    v["events"] = tuple(Event(**e) for e in v["events"])
    return kind(**v)


def to_json(schemas: Iterable[TableSchema]) -> str:
    return json.dumps([told(s) for s in sorted(schemas, key=lambda s: s.name)], default=str)


def from_json(text: str) -> list[TableSchema]:
    return [read(v) for v in json.loads(text)]


def digest(schemas: Iterable[TableSchema]) -> str:
    """SHA-256 of what is declared."""

    def plain(v: dict[str, Any]) -> dict[str, Any]:
        by_name = lambda part: sorted(part, key=lambda x: x["name"])
        return v | {"fields": by_name(v["fields"]), "indexes": by_name(v["indexes"]), "events": by_name(v["events"]), "permissions": sorted(map(list, v["permissions"]))}

    tables = sorted((plain(told(s)) for s in schemas), key=lambda v: v["name"])
    return hashlib.sha256(json.dumps(tables, sort_keys=True, default=str).encode()).hexdigest()


def snapshot(spark: SparkSession, version: str, schemas: Iterable[TableSchema]) -> DataFrame:
    """A row for the table of snapshots."""
    schemas = list(schemas)
    return spark.createDataFrame([(version, digest(schemas), to_json(schemas))], SNAPSHOTS)


def compared(snapshots: DataFrame, old: str, new: str) -> list:
    """What leads from one version of the table of snapshots to another; nothing where the digests agree."""
    rows = {r["version"]: r for r in snapshots.where(F.col("version").isin(old, new)).collect()}
    for v in (old, new):
        if v not in rows:
            raise ValueError(f"no snapshot of version {v}")
    if rows[old]["digest"] == rows[new]["digest"]:
        return []
    return differences(from_json(rows[old]["tables"]), from_json(rows[new]["tables"]))


@dataclass(frozen=True)
class Cost:
    """What one change of going back does: values that are lost, rows that break what is declared then, and the verdict."""

    op: str
    table: str
    name: str
    lost: int
    broken: int
    verdict: str


def going_back(now: Iterable[TableSchema], then: Iterable[TableSchema], rows: Mapping[str, DataFrame]) -> list[Cost]:
    """What it costs to go from the schemas that hold now back to earlier ones, by the rows of the tables there are.

    A dropped table or field loses its rows or values; a field of another type, the values that can't be cast.  What
    was dropped since then comes back empty: that is UNSAFE where the table has rows and the field may not be null and
    has no default, and so are nulls and failed assertions of fields that are declared more strictly then.
    """
    now, then = list(now), list(then)
    new, old = {t.name: t for t in now}, {t.name: t for t in then}
    out: list[Cost] = []
    changes = differences(now, then)
    for table in dict.fromkeys(c.table for c in changes):
        own = [c for c in changes if c.table == table]
        df = rows.get(table)
        counts = _counted(df, [_count(c, df, old.get(table)) for c in own]) if df is not None else [(0, 0)] * len(own)
        for c, (lost, broken) in zip(own, counts, strict=True):
            gone = c.op == "add_table" and c.name not in new
            out.append(Cost(c.op, c.table, c.name, lost, broken, "UNSAFE" if broken or gone else "DATA_LOSS" if lost else "SAFE"))
    return out


def _count(change: Any, df: DataFrame, then: TableSchema | None) -> tuple[Column, Column]:
    """Whether a row loses a value by a change, and whether it breaks the schema after it."""
    no, f = F.lit(False), None if then is None else {x.name: x for x in then.fields}.get(change.name)
    there = change.name in df.columns
    if change.op == "drop_table":
        return F.lit(True), no
    if change.op == "drop_field" and there:
        return F.col(change.name).isNotNull(), no
    if change.op == "add_field" and f is not None and not there:
        return no, F.lit(not f.nullable and f.default is None and f.computed is None)
    if change.op == "modify_field" and f is not None and there:
        kind = f.spark().dataType
        cast = F.col(change.name).try_cast(kind) if df.schema[change.name].dataType != kind else F.col(change.name)
        lost = F.col(change.name).isNotNull() & cast.isNull()
        broken = cast.isNull() if not f.nullable and f.default is None else no
        if f.assertion:
            broken = broken | ~F.coalesce(F.expr(f.assertion), F.lit(True))
        return lost, broken
    return no, no


def _counted(df: DataFrame, checks: list[tuple[Column, Column]]) -> list[tuple[int, int]]:
    row = df.agg(*[F.count_if(x).alias(f"c{i}") for i, x in enumerate(c for pair in checks for c in pair)]).first()
    return [(row[2 * i], row[2 * i + 1]) for i in range(len(checks))]
