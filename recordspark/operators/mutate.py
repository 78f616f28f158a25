"""Mutations as transforms: from the rows of a table to its new rows and what the mutation returns.

Nothing is written; `Transaction` gathers new states of several tables and hands them over at once, and the
caller writes them wherever its tables are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from dataclasses import replace as replace_
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordspark.functions.predicates import Condition, as_column
from recordspark.functions.scalar import value

IMAGES = ("none", "before", "after", "full", "diff")


@dataclass(frozen=True)
class Mutation:
    """state: all rows of the table afterwards; result: what it returns."""

    state: DataFrame
    result: DataFrame


def typed(df: DataFrame, rows: Sequence[Mapping[str, Any]] | DataFrame) -> DataFrame:
    """New rows with the table's types; columns that they leave out are null, further ones are added (as text where they are null in all rows)."""
    new, types = rows if isinstance(rows, DataFrame) else _frame(df, rows), dict(df.dtypes)
    return new.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in new.columns])


def _frame(df: DataFrame, rows: Sequence[Mapping[str, Any]]) -> DataFrame:
    """Rows of a list.  Types come from what isn't null; whole numbers beside fractions are fractions."""
    names = list(dict.fromkeys(c for r in rows for c in r))
    kinds = {c: {type(r[c]) for r in rows if r.get(c) is not None} for c in names}
    fit = lambda c, v: float(v) if kinds[c] == {int, float} and v is not None else v
    new = df.sparkSession.createDataFrame([{c: fit(c, r.get(c)) for c in names if kinds[c]} | {"__": 0} for r in rows])
    return new.select(*[F.col(c) if kinds[c] else F.lit(None).cast("string").alias(c) for c in names])


def _image(before: DataFrame, after: DataFrame, key: str, image: str) -> DataFrame:
    if image not in IMAGES:
        raise ValueError(f"not a form of return: {image}")
    if image == "none":
        return after.limit(0)
    if image == "before":
        return before
    return diff(before, after, key) if image == "diff" else after


def diff(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """The key and `changes`, an array of (op, path, value) for each field that differs; rows without changes are left out.

    A field that only one of the two has is null in the other.
    """
    names = [c for c in dict.fromkeys([*after.columns, *before.columns]) if c != key]
    old = before.select(F.col(key), *[F.col(c).alias(f"_old_{c}") for c in names if c in before.columns])
    met = after.withColumns({c: F.lit(None).cast(before.schema[c].dataType) for c in names if c not in after.columns}).join(old, key, "left")

    def change(c: str) -> Column:
        new = F.col(c)
        before_ = F.col(f"_old_{c}") if c in before.columns else F.lit(None)
        op = F.when(before_.isNull(), "add").when(new.isNull(), "remove").otherwise("replace")
        entry = F.struct(op.alias("op"), F.lit(f"/{c}").alias("path"), new.cast("string").alias("value"))
        return F.when(~new.eqNullSafe(before_), entry)

    changes = F.filter(F.array(*[change(c) for c in names]), lambda x: x.isNotNull())
    return met.select(key, changes.alias("changes")).where(F.size("changes") > 0)


def insert(df: DataFrame, rows: Sequence[Mapping[str, Any]] | DataFrame, key: str) -> Mutation:
    """Fails if a key is there already (or twice among the new rows)."""
    if not isinstance(rows, DataFrame) and not rows:
        return Mutation(df, df.limit(0))
    new = typed(df, rows)
    taken = new.select(key).join(df.select(key), key, "left_semi").union(new.groupBy(key).count().where("count > 1").select(key)).take(1)
    if taken:
        raise ValueError(f"record exists: {taken[0][0]}")
    state = df.unionByName(new, allowMissingColumns=True)
    return Mutation(state, df.limit(0).unionByName(new, allowMissingColumns=True))


@dataclass(frozen=True)
class Update:
    """An update that is put together step by step and applied to a table's rows at the end; each step returns a new one."""

    values: tuple[tuple[str, Any], ...] = ()
    conditions: tuple[Condition, ...] = ()
    image: str = "after"

    def set(self, **values: Any) -> Update:
        return replace_(self, values=(*self.values, *values.items()))

    def where(self, condition: Condition) -> Update:
        """All conditions must hold."""
        return replace_(self, conditions=(*self.conditions, condition))

    def returning(self, image: str) -> Update:
        if image not in IMAGES:
            raise ValueError(f"not a form of return: {image}")
        return replace_(self, image=image)

    def apply(self, df: DataFrame, key: str, readonly: Sequence[str] = ()) -> Mutation:
        if not self.values:
            raise ValueError("nothing is set")
        where = reduce(lambda a, b: a & b, [as_column(c, df) for c in self.conditions]) if self.conditions else None
        return update(df, dict(self.values), key, where, self.image, readonly)


def update(df: DataFrame, values: Mapping[str, Any], key: str, where: Condition | None = None, image: str = "after", readonly: Sequence[str] = (), permitted: Condition | None = None) -> Mutation:
    """Set fields of the rows that a condition holds for.  Fields in `readonly` can't be set; rows that aren't `permitted` stay as they are."""
    if blocked := set(values) & set(readonly):
        raise ValueError(f"read only: {', '.join(sorted(blocked))}")
    hit = _hit(df, where, permitted)
    types = dict(df.dtypes)
    marked = df.withColumn("_hit", hit)
    new = {k: (value(v).cast(types[k]) if k in types else value(v)) for k, v in values.items()}
    set_ = marked.withColumns({k: F.when(F.col("_hit"), v).otherwise(F.col(k) if k in types else F.lit(None)) for k, v in new.items()})
    before = marked.where("_hit").drop("_hit")
    after = set_.where("_hit").drop("_hit")
    return Mutation(set_.drop("_hit"), _image(before, after, key, image))


def merge(df: DataFrame, key: str, id_: Any, values: Mapping[str, Any], image: str = "after") -> Mutation:
    """Set fields of one record."""
    return update(df, values, key, F.col(key) == id_, image)


def upsert(df: DataFrame, rows: Sequence[Mapping[str, Any]] | DataFrame, key: str, image: str = "after", on: Sequence[str] = ()) -> Mutation:
    """Replace whole records, or add them.  on: the fields that tell a record, instead of the key; nulls are equal.

    Of several items for one record the last stays: the last of a list, or of a DataFrame the one with the
    largest fields, as its rows have no order.
    """
    if not isinstance(rows, DataFrame) and not rows:
        return Mutation(df, df.limit(0))
    by = list(on) or [key]
    if not isinstance(rows, DataFrame):
        rows = _frame(df, [{**r, "_place": i} for i, r in enumerate(rows)])
        place = F.col("_place")
    else:
        place = F.to_json(F.struct(*rows.columns))
    last = typed(df, rows).groupBy(*by).agg(F.max_by(F.struct(*rows.columns), place).alias("_row")).select("_row.*").drop("_place")
    new = df.limit(0).unionByName(last, allowMissingColumns=True)
    keys = new.select(*[F.col(c).alias(f"_by_{c}") for c in by])
    same = reduce(lambda a, b: a & b, [df[c].eqNullSafe(keys[f"_by_{c}"]) for c in by])
    before = df.join(keys, same, "left_semi")
    state = df.join(keys, same, "left_anti").unionByName(new, allowMissingColumns=True)
    return Mutation(state, _image(before, new, key, image))


def replace(df: DataFrame, key: str, id_: Any, values: Mapping[str, Any], image: str = "after") -> Mutation:
    """All fields of one record; those left out become null.  A record that isn't there stays so."""
    there = df.where(F.col(key) == id_)
    types = dict(df.dtypes)
    new = there.select(*[F.col(c) if c == key else (value(values[c]) if c in values else F.lit(None)).cast(types[c]).alias(c) for c in df.columns])
    return Mutation(df.where(~(F.col(key) == id_) | F.col(key).isNull()).unionByName(new), _image(there, new, key, image))


def _hit(df: DataFrame, *conditions: Condition | None) -> Column:
    """Whether all conditions that there are hold; what is null doesn't."""
    return reduce(lambda a, b: a & b, [F.coalesce(as_column(c, df), F.lit(False)) for c in conditions if c is not None], F.lit(True))


def delete(df: DataFrame, where: Condition | None = None, image: str = "before", permitted: Condition | None = None) -> Mutation:
    """Without a condition, all rows; rows that aren't `permitted` stay."""
    hit = _hit(df, where, permitted)
    gone = df.where(hit)
    return Mutation(df.where(~hit), gone if image == "before" else gone.limit(0))


def delete_many(df: DataFrame, ids: Sequence[Any] | DataFrame, key: str) -> Mutation:
    keys = ids if isinstance(ids, DataFrame) else df.sparkSession.createDataFrame([(i,) for i in ids], df.select(key).schema) if ids else df.select(key).limit(0)
    return Mutation(df.join(keys, key, "left_anti").select(*df.columns), df.join(keys, key, "left_semi").select(*df.columns))


def relate_many(edges: DataFrame, relations: Sequence[tuple[Any, Any, Mapping[str, Any]]]) -> Mutation:
    """Edges from (source, target, properties)."""
    if not relations:
        return Mutation(edges, edges.limit(0))
    new = typed(edges, [{"in": a, "out": b, **p} for a, b, p in relations])
    return Mutation(edges.unionByName(new, allowMissingColumns=True), edges.limit(0).unionByName(new, allowMissingColumns=True))


def backfill(df: DataFrame, name: str, default: Any) -> DataFrame:
    """A field's default where it is null or absent."""
    return df.withColumn(name, F.coalesce(F.col(name), value(default)) if name in df.columns else value(default))


@dataclass
class Transaction:
    """Mutations of several tables, seen by one another and kept together."""

    tables: dict[str, DataFrame]
    pending: dict[str, DataFrame] = field(default_factory=dict)
    open: bool = True

    def execute(self, table: str, f: Any, *args: Any, **kw: Any) -> DataFrame:
        """Apply a mutation to a table's present state; its result."""
        if not self.open:
            raise RuntimeError("the transaction is over")
        m = f(self.pending.get(table, self.tables[table]), *args, **kw)
        self.pending[table] = m.state
        return m.result

    def commit(self) -> dict[str, DataFrame]:
        if not self.open:
            raise RuntimeError("the transaction is over")
        self.open = False
        self.tables.update(self.pending)
        return self.tables

    def cancel(self) -> None:
        self.open = False
        self.pending.clear()
