"""Schemas in code: fields, tables and edges, how they become Spark types, and what rows violate them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordspark.functions.scalar import value

#: Types of fields and the Spark types that hold them.
SPARK_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(), "int": T.LongType(), "float": T.DoubleType(), "bool": T.BooleanType(), "datetime": T.TimestampType(), "duration": T.DayTimeIntervalType(), "decimal": T.DecimalType(38, 18),
    "number": T.DoubleType(), "object": T.VariantType(), "array": T.ArrayType(T.StringType()), "record": T.StringType(), "geometry": T.BinaryType(), "any": T.VariantType(),
}


@dataclass(frozen=True)
class Field:
    """assertion: a Spark SQL condition on the field's name; computed: an expression that gives its value."""

    name: str
    type: str
    assertion: str | None = None
    default: Any = None
    computed: str | None = None
    readonly: bool = False
    nullable: bool = True
    target: str | None = None
    element: str | None = None

    def __post_init__(self) -> None:
        if self.type not in SPARK_TYPES:
            raise ValueError(f"unknown type: {self.type}")
        if not all(p.isidentifier() for p in self.name.split(".")):
            raise ValueError(f"not a name: {self.name!r}")

    def spark(self) -> T.StructField:
        kind = T.ArrayType(SPARK_TYPES[self.element]) if self.element else SPARK_TYPES[self.type]
        return T.StructField(self.name, kind, self.nullable, {k: str(v) for k, v in (("assert", self.assertion), ("default", self.default), ("readonly", self.readonly), ("target", self.target)) if v})


def computed_field(name: str, expression: str, type_: str) -> Field:
    return Field(name, type_, computed=expression, readonly=True)


def record_field(name: str, target: str, **kw: Any) -> Field:
    return Field(name, "record", target=target, **kw)


#: Distances and component types that vector indexes may declare.
DISTANCES = {"mtree": ("COSINE", "EUCLIDEAN", "MANHATTAN", "MINKOWSKI"), "hnsw": ("CHEBYSHEV", "COSINE", "EUCLIDEAN", "HAMMING", "JACCARD", "MANHATTAN", "MINKOWSKI", "PEARSON")}
COMPONENTS = ("F64", "F32", "I64", "I32", "I16")


@dataclass(frozen=True)
class Index:
    """kind: standard, search, mtree or hnsw.  `sources.indexes` builds them; `violations` and `duplicates` check what they promise."""

    name: str
    columns: tuple[str, ...]
    unique: bool = False
    kind: str = "standard"
    dimension: int | None = None
    distance: str = "EUCLIDEAN"
    component: str = "F64"

    def __post_init__(self) -> None:
        if self.kind not in ("standard", "search", *DISTANCES):
            raise ValueError(f"not a kind of index: {self.kind}")
        if self.kind in DISTANCES:
            if len(self.columns) != 1 or self.dimension is None or self.dimension < 1:
                raise ValueError("a vector index needs one column and a dimension")
            if self.distance not in DISTANCES[self.kind] or self.component not in COMPONENTS:
                raise ValueError(f"not possible in a {self.kind} index: {self.distance}, {self.component}")


def search_index(name: str, *columns: str) -> Index:
    return Index(name, columns, kind="search")


def vector_index(name: str, column: str, dimension: int, kind: str = "hnsw", distance: str = "EUCLIDEAN", component: str = "F64") -> Index:
    return Index(name, (column,), kind=kind, dimension=dimension, distance=distance, component=component)


#: What permissions are given for.
ACTIONS = ("select", "create", "update", "delete")


@dataclass(frozen=True)
class Event:
    """What happens to a table when the Spark SQL condition on `action`, `before` and `after` (structs of the record) holds."""

    name: str
    when: str = "true"


@dataclass(frozen=True)
class TableSchema:
    name: str
    fields: tuple[Field, ...] = ()
    indexes: tuple[Index, ...] = ()
    rule: str | None = None
    #: (action, Spark SQL condition) pairs: which rows an action may see or touch; an action without one may all.
    permissions: tuple[tuple[str, str], ...] = ()
    #: Of a full table, rows may have declared fields only.
    full: bool = False
    events: tuple[Event, ...] = ()

    def with_mode(self, full: bool) -> TableSchema:
        return replace(self, full=full)

    def with_events(self, *events: Event) -> TableSchema:
        return replace(self, events=(*self.events, *events))

    def with_fields(self, *fields: Field) -> TableSchema:
        return replace(self, fields=(*self.fields, *fields))

    def with_indexes(self, *indexes: Index) -> TableSchema:
        return replace(self, indexes=(*self.indexes, *indexes))

    def with_permissions(self, **conditions: str) -> TableSchema:
        if unknown := set(conditions) - set(ACTIONS):
            raise ValueError(f"not an action: {', '.join(sorted(unknown))}")
        return replace(self, permissions=tuple((dict(self.permissions) | conditions).items()))

    def permitted(self, action: str) -> Column:
        """The condition on rows that an action may see or touch; also for `Catalog.add` and for mutations."""
        if action not in ACTIONS:
            raise ValueError(f"not an action: {action}")
        condition = dict(self.permissions).get(action)
        return F.lit(True) if condition is None else F.coalesce(F.expr(condition), F.lit(False))

    def spark(self) -> T.StructType:
        """The columns; fields inside of objects are no columns of their own."""
        return T.StructType([f.spark() for f in self.fields if "." not in f.name])

    def inside(self, name: str) -> dict[str, Any]:
        """The declared fields of an object as a tree: its parts, and at the leaves the field."""
        tree: dict[str, Any] = {}
        for f in self.fields:
            if f.name.startswith(f"{name}."):
                *outer, last = f.name.split(".")[1:]
                at = tree
                for p in outer:
                    if isinstance(at.get(p), Field) and at[p].type == "object":
                        at[p] = {}
                    at = at.setdefault(p, {})
                if f.type != "object" or last not in at:
                    at[last] = f
        return tree

    def as_objects(self, df: DataFrame) -> DataFrame:
        """Object fields as Variant: text is read as JSON (null where it isn't), structs and maps as what they hold."""
        out = {}
        for f in self.fields:
            if f.type == "object" and "." not in f.name and f.name in df.columns:
                kind = df.schema[f.name].dataType
                if not isinstance(kind, T.VariantType):
                    out[f.name] = F.try_parse_json(F.col(f.name) if isinstance(kind, T.StringType) else F.to_json(F.col(f.name)))
        return df.withColumns(out)

    def opened(self, df: DataFrame) -> DataFrame:
        """Object fields as structs of their declared fields, so that paths are columns; a value that can't be cast to its type is null."""

        def struct(name: str, tree: dict[str, Any], path: str) -> Column:
            get = lambda p, kind: F.try_variant_get(F.col(name), f"{path}.{p}", kind.simpleString())
            return F.struct(*[(struct(name, x, f"{path}.{p}") if isinstance(x, dict) else get(p, x.spark().dataType)).alias(p) for p, x in tree.items()])

        df = self.as_objects(df)
        objects = {f.name: self.inside(f.name) for f in self.fields if f.type == "object" and "." not in f.name and f.name in df.columns}
        return df.withColumns({n: F.when(F.col(n).isNotNull(), struct(n, t, "$")) for n, t in objects.items() if t})

    def mistyped(self, df: DataFrame, key: str) -> DataFrame:
        """key and field of the values inside of objects that are there (and aren't JSON's null) but can't be cast to the declared type."""
        df, checks = self.as_objects(df), []
        for f in self.fields:
            top, _, path = f.name.partition(".")
            if path and top in df.columns and f.type != "object":
                there = F.try_variant_get(F.col(top), f"$.{path}", "variant")
                fits = F.try_variant_get(F.col(top), f"$.{path}", f.spark().dataType.simpleString()).isNotNull()
                checks.append(F.when(there.isNotNull() & ~F.is_variant_null(there) & ~fits, F.lit(f.name)))
        found = F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")
        return df.select(key, F.explode(found).alias("field"))

    def fired(self, before: DataFrame, after: DataFrame, key: str) -> DataFrame:
        """event, key, action (CREATE, UPDATE, DELETE), before and after of every event that a mutation of the rows fires; one join."""
        if not self.events:
            raise ValueError(f"no events of {self.name}")
        whole = lambda df, name: df.where(F.col(key).isNotNull()).select(F.col(key).alias(f"_{name}"), F.struct(*df.columns).alias(name))
        met = whole(before, "before").join(whole(after, "after"), F.col("_before") == F.col("_after"), "full")
        action = F.when(F.col("before").isNull(), "CREATE").when(F.col("after").isNull(), "DELETE").when(F.to_json("before") != F.to_json("after"), "UPDATE")
        changed = met.select(F.coalesce("_before", "_after").alias("key"), action.alias("action"), "before", "after").where("action is not null")
        held = F.array(*[F.when(F.coalesce(F.expr(e.when), F.lit(False)), F.lit(e.name)) for e in self.events])
        return changed.select(F.explode(F.array_compact(held)).alias("event"), "key", "action", "before", "after")

    def applied(self, df: DataFrame) -> DataFrame:
        """Defaults for what is null or absent, then computed fields, then the row rule."""
        for f in self.fields:
            if f.default is not None:
                df = df.withColumn(f.name, F.coalesce(F.col(f.name), value(f.default)) if f.name in df.columns else value(f.default))
        for f in self.fields:
            if f.computed:
                df = df.withColumn(f.name, F.expr(f.computed).cast(SPARK_TYPES[f.type]))
        return df.where(self.rule) if self.rule else df

    def violations(self, df: DataFrame, key: str) -> DataFrame:
        """key, field and kind ("null", "assert" or "dimension") of every field that breaks its declaration; one pass."""
        checks: list[Column] = []
        for f in self.fields:
            struct = lambda kind, f=f: F.struct(F.lit(f.name).alias("field"), F.lit(kind).alias("kind"))
            if not f.nullable:
                checks.append(F.when(F.col(f.name).isNull(), struct("null")))
            if f.assertion:
                checks.append(F.when(~F.coalesce(F.expr(f.assertion), F.lit(True)), struct("assert")))
        for i in self.indexes:
            if i.kind in DISTANCES:
                checks.append(F.when(F.size(i.columns[0]) != i.dimension, F.struct(F.lit(i.columns[0]).alias("field"), F.lit("dimension").alias("kind"))))
        if not checks:
            return df.select(key, F.lit("").alias("field"), F.lit("").alias("kind")).limit(0)
        return df.select(key, F.explode(F.filter(F.array(*checks), lambda x: x.isNotNull())).alias("v")).select(key, "v.field", "v.kind")

    def duplicates(self, df: DataFrame) -> dict[str, DataFrame]:
        """For each unique index, its values that occur more than once."""
        return {i.name: df.groupBy(*i.columns).agg(F.count("*").alias("n")).where("n > 1") for i in self.indexes if i.unique}

    def dangling(self, df: DataFrame, key: str, tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
        """key and field of references to records that aren't there."""
        out = df.select(key, F.lit("").alias("field")).limit(0)
        for f in self.fields:
            if f.type == "record" and f.target in tables:
                there, there_key = tables[f.target]
                there = there.select(F.col(there_key).alias("_key"))
                out = out.union(df.where(F.col(f.name).isNotNull()).join(there, F.col(f.name) == F.col("_key"), "left_anti").select(key, F.lit(f.name)))
        return out


@dataclass(frozen=True)
class EdgeSchema(TableSchema):
    """An edge table: rows with `in` and `out`, from one table to another (or any, where they aren't named)."""

    from_table: str | None = None
    to_table: str | None = None

    def broken(self, edges: DataFrame, tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
        """in, out and end of the edges that lack an end, or whose end isn't in the table that it must be in."""
        out = edges.where("`in` is null or out is null").select("in", "out", F.when(F.col("in").isNull(), "in").otherwise("out").alias("end"))
        for end, table in (("in", self.from_table), ("out", self.to_table)):
            if table in tables:
                rows, key = tables[table]
                there = rows.select(F.col(key).alias("_key"))
                out = out.union(edges.where(F.col(end).isNotNull()).join(there, F.col(end) == F.col("_key"), "left_anti").select("in", "out", F.lit(end)))
        return out

    def reversed(self, name: str) -> EdgeSchema:
        return replace(self, name=name, from_table=self.to_table, to_table=self.from_table)


def typed_edge(name: str, from_table: str, to_table: str, *fields: Field) -> EdgeSchema:
    return EdgeSchema(name, fields, from_table=from_table, to_table=to_table)


def bidirectional_edge(name: str, table: str, *fields: Field) -> EdgeSchema:
    """Between records of one table."""
    return typed_edge(name, table, table, *fields)


@dataclass(frozen=True)
class Change:
    """One difference between two schemas."""

    op: str
    table: str
    name: str
    safe: bool


def differences(old: Iterable[TableSchema], new: Iterable[TableSchema]) -> list[Change]:
    """What leads from one set of tables to another; a change is safe if it loses no data."""
    a, b = {t.name: t for t in old}, {t.name: t for t in new}
    out = [Change("add_table", n, n, True) for n in b if n not in a] + [Change("drop_table", n, n, False) for n in a if n not in b]
    for n in (n for n in b if n in a):
        before, after = {f.name: f for f in a[n].fields}, {f.name: f for f in b[n].fields}
        out += [Change("add_field", n, f, True) for f in after if f not in before]
        out += [Change("drop_field", n, f, False) for f in before if f not in after]
        out += [Change("modify_field", n, f, before[f].type == after[f].type) for f in after if f in before and after[f] != before[f]]
        was, now = {i.name: i for i in a[n].indexes}, {i.name: i for i in b[n].indexes}
        out += [Change("add_index", n, i, True) for i in sorted(set(now) - set(was))] + [Change("drop_index", n, i, True) for i in sorted(set(was) - set(now))]
        out += [Change("modify_index", n, i, True) for i in now if i in was and now[i] != was[i]]
        if dict(a[n].permissions) != dict(b[n].permissions) or a[n].rule != b[n].rule:
            out.append(Change("modify_permissions", n, n, True))
        ends = lambda t: (getattr(t, "from_table", None), getattr(t, "to_table", None))
        if ends(a[n]) != ends(b[n]):
            out.append(Change("modify_edge", n, n, False))
    return out


def report(found: Iterable[tuple[str, str, str]]) -> dict[str, Any]:
    """Numbers of errors and warnings, whether there are errors, and a text with a line for each finding."""
    found = sorted(found)
    n = {s: sum(x[0] == s for x in found) for s in ("error", "warning")}
    return {"errors": n["error"], "warnings": n["warning"], "failed": n["error"] > 0, "text": "\n".join(f"{s}: {f}: {w}" for s, f, w in found)}


#: The table of applied migrations.
HISTORY = "version string, description string, applied_at timestamp, checksum string, execution_time_ms long"


def pending(history: DataFrame, migrations: Mapping[str, str]) -> tuple[list[str], list[str]]:
    """Of migrations (version: checksum): versions not yet applied, in order, and applied ones whose checksum is another by now."""
    applied = {r["version"]: r["checksum"] for r in history.select("version", "checksum").collect()}
    return sorted(set(migrations) - set(applied)), sorted(v for v, c in migrations.items() if v in applied and applied[v] != c)


def mismatches(schema: TableSchema, df: DataFrame) -> list[tuple[str, str, str]]:
    """(severity, field, what) between a declaration and the rows there are."""
    there, out = {f.name: f for f in df.schema.fields}, []
    for f in schema.fields:
        if f.name not in there:
            out.append(("error", f.name, "missing"))
        elif there[f.name].dataType != f.spark().dataType:
            out.append(("error", f.name, f"{there[f.name].dataType.simpleString()} instead of {f.spark().dataType.simpleString()}"))
    return out + [("warning", n, "not declared") for n in there if n not in {f.name for f in schema.fields}]
