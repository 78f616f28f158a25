"""Mutations that enforce a schema: what breaks it is rejected, with the reasons, and the rest is written.

Only new rows are checked.  Nulls, assertions, dimensions, undeclared fields and permissions take one pass over them.
All unique indexes and the key take one join with one scan of the rows that are there; references one anti join for
each table that they name.

Kinds of violations: null, assert, dimension, undeclared (a field of a full table that it doesn't declare, with a value),
permission, unique, exists (a key that is there, or comes twice), table (a record id of another table) and reference.

Defined results: nulls break no assertion, index or reference.  Of new rows that share the value of a unique index (or
the key, for inserts), the first by key stays, and the others are rejected, whatever else may be wrong with the first.
A row that replaces another one frees the other's values.  Repeated rows are rejected but for one.  No new rows give no
rejections.  The name `__i` is taken.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordspark.functions.predicates import Condition
from recordspark.operators import mutate
from recordspark.sources.ids import id_part
from recordspark.sources.schema import DISTANCES, EdgeSchema, TableSchema
from recordspark.sources.storage import cut

Tables = Mapping[str, tuple[DataFrame, str]]
FOUND = "__i long, field string, kind string"


@dataclass(frozen=True)
class Checked:
    """accepted: rows as they came; rejected: the others, with `violations`, an array of (field, kind)."""

    accepted: DataFrame
    rejected: DataFrame


@dataclass(frozen=True)
class Enforced:
    """A mutation's new state and result, and what it rejected."""

    state: DataFrame
    result: DataFrame
    rejected: DataFrame


def _of_rows(schema: TableSchema, key: str | None, names: Sequence[str], permitted: Column | None) -> Column:
    """The violations that a row shows by itself, as an array."""
    found: list[Column] = []
    broken = lambda when, field, kind: found.append(F.when(when, F.struct(F.lit(field).alias("field"), F.lit(kind).alias("kind"))))
    there = set(names)
    for f in schema.fields:
        if not f.nullable:
            broken(F.col(f.name).isNull() if f.name in there else F.lit(True), f.name, "null")
        if f.assertion and f.name in there:
            broken(~F.coalesce(F.expr(f.assertion), F.lit(True)), f.name, "assert")
        if f.type == "record" and f.target and f.name in there:
            text = F.col(f.name).cast("string")
            broken(text.rlike("^[A-Za-z0-9_]+:") & ~text.startswith(f"{f.target}:"), f.name, "table")
    for i in schema.indexes:
        if i.kind in DISTANCES and i.columns[0] in there:
            broken(F.size(i.columns[0]) != i.dimension, i.columns[0], "dimension")
    if schema.full:
        declared = {f.name.split(".")[0] for f in schema.fields} | {key, "in", "out"}
        for c in names:
            if c not in declared:
                broken(F.col(f"`{c}`").isNotNull(), c, "undeclared")
    if key is not None:
        broken(F.col(key).isNull(), key, "null")
    if permitted is not None:
        broken(~permitted, "", "permission")
    return F.filter(F.array(*found), lambda x: x.isNotNull()) if found else F.array().cast("array<struct<field:string,kind:string>>")


def _values(schema: TableSchema, key: str | None, names: Sequence[str]) -> Column:
    """(index, value) of every unique index of which a row has all values, and of the key as the index without a name."""
    entry = lambda name, columns: F.when(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]), F.struct(F.lit(name).alias("index"), F.to_json(F.struct(*[F.col(c).alias(f"c{j}") for j, c in enumerate(columns)])).alias("value")))
    entries = [entry(i.name, i.columns) for i in schema.indexes if i.unique and set(i.columns) <= set(names)] + ([entry("", [key])] if key else [])
    return F.explode(F.filter(F.array(*entries), lambda x: x.isNotNull()))


def check(new: DataFrame, schema: TableSchema, key: str | None, existing: DataFrame | None = None, tables: Tables | None = None, action: str = "create", replaces: bool = False) -> Checked:
    """Check new rows against a schema.

    existing: the rows that are there; replaces: whether new rows replace those of the same key.
    """
    names, tables = new.columns, tables or {}
    rows = cut(new.withColumn("__i", F.monotonically_increasing_id()))
    own = rows.select("__i", F.explode(_of_rows(schema, key, names, schema.permitted(action))).alias("v")).select("__i", "v.field", "v.kind")
    found = [own]
    unique = [i for i in schema.indexes if i.unique and set(i.columns) <= set(names)]
    if unique or key:
        order = F.struct(F.col(key).cast("string").alias("k"), "__i") if key else F.struct(F.lit("").alias("k"), "__i")
        mine = rows.select("__i", order.alias("o"), _values(schema, key, names).alias("e")).select("__i", "o", "e.index", "e.value")
        first = mine.groupBy("index", "value").agg(F.min("o").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
        again = mine.join(first, ["index", "value"]).where(F.col("o") != F.col("first")).select("__i", "index")
        if existing is not None:
            old = existing
            if replaces and key:
                old = existing.join(rows.select(F.col(key).alias("__k")), existing[key] == F.col("__k"), "left_anti")
            if set(names) - set(existing.columns):
                old = old.withColumns({c: F.lit(None).cast(new.schema[c].dataType) for c in names if c not in existing.columns})
            theirs = old.select(_values(schema, key, names).alias("e")).select("e.index", "e.value")
            again = again.union(mine.join(theirs, ["index", "value"], "left_semi").select("__i", "index"))
        fields = {i.name: ",".join(i.columns) for i in unique}
        told = F.coalesce(*[F.when(F.col("index") == n, F.lit(f)) for n, f in fields.items()], F.lit(key or "")) if fields else F.lit(key or "")
        found.append(again.select("__i", told.alias("field"), F.when(F.col("index") == "", "exists").otherwise("unique").alias("kind")))
    by_target: dict[str, list[tuple[str, str]]] = {}
    for f in schema.fields:
        if f.type == "record" and f.target in tables and f.name in names:
            by_target.setdefault(f.target, []).append((f.name, f.target))
    if isinstance(schema, EdgeSchema):
        for end, t in (("in", schema.from_table), ("out", schema.to_table)):
            if t in tables:
                by_target.setdefault(t, []).append((end, t))
    for target, links in by_target.items():
        there, there_key = tables[target]
        kind = there.schema[there_key].dataType.simpleString()
        value = lambda c: F.when(F.col(f"`{c}`").cast("string").startswith(f"{target}:"), id_part(F.col(f"`{c}`").cast("string"))).otherwise(F.col(f"`{c}`").cast("string")).try_cast(kind)  # noqa: B023, E731
        refs = rows.select("__i", F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"`{c}`").isNotNull().alias("given"), value(c).alias("ref")) for c, _ in links])).alias("r")).select("__i", "r.*").where("given")
        keys = there.select(F.col(there_key).alias("__key"))
        found.append(refs.join(keys, refs["ref"] == keys["__key"], "left_anti").select("__i", "field", F.lit("reference").alias("kind")))
    every = cut(reduce(DataFrame.union, found).groupBy("__i").agg(F.array_sort(F.collect_set(F.struct("field", "kind"))).alias("violations")))
    return Checked(rows.join(every, "__i", "left_anti").select(*names), rows.join(every, "__i").select(*names, "violations"))


def insert(df: DataFrame, rows: Sequence[Mapping[str, Any]] | DataFrame, key: str, schema: TableSchema, tables: Tables | None = None) -> Enforced:
    """Add the rows that keep the schema, with its defaults and computed fields."""
    c = check(schema.applied(mutate.typed(df, rows)), schema, key, df, tables)
    return Enforced(df.unionByName(c.accepted, allowMissingColumns=True), c.accepted, c.rejected)


def upsert(df: DataFrame, rows: Sequence[Mapping[str, Any]] | DataFrame, key: str, schema: TableSchema, tables: Tables | None = None) -> Enforced:
    """Add or replace records by the rows that keep the schema; a key that comes twice is rejected but for one row."""
    c = check(schema.applied(mutate.typed(df, rows)), schema, key, df, tables, replaces=True)
    return Enforced(mutate.upsert(df, c.accepted, key).state, c.accepted, c.rejected)


def update(df: DataFrame, values: Mapping[str, Any], key: str, schema: TableSchema, where: Condition | None = None, tables: Tables | None = None) -> Enforced:
    """Set fields of the records for which a condition and the update permission hold; records that the new values would break stay as they are."""
    readonly = [f.name for f in schema.fields if f.readonly]
    done = mutate.update(df, values, key, where, "after", readonly, schema.permitted("update"))
    c = check(done.result, _unasked(schema), key, df, tables, "update", replaces=True)
    return Enforced(mutate.upsert(df, c.accepted, key).state, c.accepted, c.rejected)


def delete(df: DataFrame, schema: TableSchema, where: Condition | None = None) -> mutate.Mutation:
    """Delete the records for which a condition and the delete permission hold."""
    return mutate.delete(df, where, permitted=schema.permitted("delete"))


def relate(edges: DataFrame, rows: Sequence[tuple[Any, Any, Mapping[str, Any]]] | DataFrame, schema: EdgeSchema, tables: Tables | None = None) -> Enforced:
    """Add the edges whose ends are there, and that keep the edge's schema."""
    given = rows if isinstance(rows, DataFrame) else [{"in": a, "out": b, **p} for a, b, p in rows]
    new = schema.applied(mutate.typed(edges, given))
    c = check(new, schema, None, edges, tables)
    return Enforced(edges.unionByName(c.accepted, allowMissingColumns=True), c.accepted, c.rejected)


def _unasked(schema: TableSchema) -> TableSchema:
    """The schema without permissions: of updates, the rows before them have been asked."""
    return replace(schema, permissions=())
