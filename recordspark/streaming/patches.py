"""JSON patches between two versions of records: structs, maps and arrays by their parts.

An entry is (op, path, value): `add`, `replace` or `remove`, a JSON pointer, and the new value as JSON.  Fields of
structs that are null count as absent; keys of maps and elements of arrays are there with a null value, and are
replaced by it.  Elements are compared by place: what an array has more at its end is added in order, what it lost
is removed from the end.  All of it is one expression, built from the columns' types.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENTRY = "array<struct<op:string,path:string,value:string>>"


def as_json(x: Column) -> Column:
    """A value of any type as JSON."""
    whole = F.to_json(F.struct(x.alias("v")))
    return F.when(x.isNull(), F.lit("null")).otherwise(F.substring(whole, F.lit(6), F.length(whole) - 6))


def _step(name: Column) -> Column:
    """A name as a part of a JSON pointer."""
    return F.concat(F.lit("/"), F.replace(F.replace(name, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1")))


def _entry(op: str, path: Column, value: Column) -> Column:
    return F.array(F.struct(F.lit(op).alias("op"), path.alias("path"), value.cast("string").alias("value")))


def changes(old: Column, new: Column, kind: T.DataType, path: Column, had: Column, has: Column) -> Column:
    """The entries that lead from one value to another; had, has: whether they are there."""
    nothing = F.array().cast(ENTRY)
    both = nothing
    if isinstance(kind, T.StructType):
        both = F.concat(nothing, *[_field(old, new, f, path) for f in kind])
    elif isinstance(kind, T.MapType):
        keys = F.array_sort(F.array_union(F.map_keys(old), F.map_keys(new)))
        both = F.flatten(F.transform(keys, lambda k: changes(old[k], new[k], kind.valueType, F.concat(path, _step(k.cast("string"))), F.map_contains_key(old, k), F.map_contains_key(new, k))))
    elif isinstance(kind, T.ArrayType):
        a, b = F.size(old), F.size(new)
        at = lambda i: F.concat(path, F.lit("/"), i.cast("string"))
        true = F.lit(True)
        met = F.flatten(F.transform(_upto(F.lit(0), F.least(a, b)), lambda i: changes(F.get(old, i), F.get(new, i), kind.elementType, at(i), true, true)))
        more = F.flatten(F.transform(_upto(a, b), lambda i: _entry("add", at(i), as_json(F.get(new, i)))))
        less = F.flatten(F.transform(F.reverse(_upto(b, a)), lambda i: _entry("remove", at(i), F.lit(None))))
        both = F.concat(met, more, less)
    else:
        both = _entry("replace", path, as_json(new))
    same = old.eqNullSafe(new) if not _has_map(kind) else as_json(old).eqNullSafe(as_json(new))
    found = F.when(~had & ~has, nothing).when(~had, _entry("add", path, as_json(new))).when(~has, _entry("remove", path, F.lit(None)))
    return found.when(same, nothing).when(old.isNull() | new.isNull(), _entry("replace", path, as_json(new))).otherwise(both).cast(ENTRY)


def _field(old: Column, new: Column, f: T.StructField, path: Column) -> Column:
    a, b = old.getField(f.name), new.getField(f.name)
    return changes(a, b, f.dataType, F.concat(path, _step(F.lit(f.name))), a.isNotNull(), b.isNotNull())


def _upto(first: Column, end: Column) -> Column:
    return F.when(first < end, F.sequence(first, end - 1)).otherwise(F.array().cast("array<int>"))


def _has_map(kind: T.DataType) -> bool:
    """Whether values can't be compared as they are."""
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind)
    return isinstance(kind, T.MapType) or (isinstance(kind, T.ArrayType) and _has_map(kind.elementType))


def patches(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """The key and `changes` of records in both versions that differ; the columns must have the same types in both.

    A column that only one of the two has is absent in the other.  Rows without a key are nobody's record.
    """
    names = [c for c in dict.fromkeys([*before.columns, *after.columns]) if c != key]
    kinds = {c: (before if c in before.columns else after).schema[c].dataType for c in names}
    whole = lambda df, name: df.select(F.col(key).alias(f"{name}_key"), F.struct(*[F.col(f"`{c}`") if c in df.columns else F.lit(None).cast(kinds[c]).alias(c) for c in names]).alias(name))
    for c in names:
        if c in before.columns and c in after.columns and before.schema[c].dataType.simpleString() != after.schema[c].dataType.simpleString():
            raise ValueError(f"{c} has another type")
    form = T.StructType([T.StructField(c, kinds[c]) for c in names])
    met = whole(before, "old").join(whole(after, "new"), F.col("old_key") == F.col("new_key"))
    true = F.lit(True)
    return met.select(F.col("old_key").alias(key), changes(F.col("old"), F.col("new"), form, F.lit(""), true, true).alias("changes")).where(F.size("changes") > 0)


def apply_patch(document: Any, entries: list[dict[str, Any]]) -> Any:
    """A JSON value after the entries of a patch; structs and maps are dicts."""
    for e in entries:
        *outer, last = [p.replace("~1", "/").replace("~0", "~") for p in e["path"].split("/")[1:]]
        at = document
        for p in outer:
            at = at[int(p)] if isinstance(at, list) else at[p]
        value = None if e["op"] == "remove" else json.loads(e["value"])
        if isinstance(at, list):
            at[int(last) : int(last) + (e["op"] != "add")] = [] if e["op"] == "remove" else [value]
        elif e["op"] == "remove":
            at.pop(last, None)
        else:
            at[last] = value
    return document


def patched(rows: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """The rows with the patches of their records applied; the key's and the columns' types stay."""
    kind = rows.schema
    told = rows.select(F.col(key).alias("_k"), F.to_json(F.struct(*[c for c in rows.columns if c != key]), {"ignoreNullFields": "false"}).alias("_old"))
    met = told.join(found.select(F.col(key).alias("_p"), F.to_json(F.col("changes")).alias("_changes")), F.col("_k") == F.col("_p"), "left").select("_k", "_old", "_changes")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            new = [o if c is None or c != c else json.dumps(apply_patch(json.loads(o), json.loads(c))) for o, c in zip(b["_old"], b["_changes"], strict=True)]
            yield pd.DataFrame({"_k": b["_k"], "_new": new})

    form = T.StructType([f for f in kind if f.name != key])
    out = met.mapInPandas(run, T.StructType([T.StructField("_k", kind[key].dataType), T.StructField("_new", T.StringType())]))
    back = F.from_json("_new", form)
    return out.withColumn("_row", back).select(*[F.col("_k").alias(c) if c == key else F.col(f"_row.`{c}`").alias(c) for c in rows.columns])
