"""Graph operators: hops are joins with edge tables.

Traversals keep one row for each path; neighbours are distinct.  Searches widen a frontier by one join a
level; each level is written to the shared checkpoint folder, so plans stay short and survive lost executors.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordspark.functions.predicates import Condition, as_column
from recordspark.sources.catalog import Catalog
from recordspark.sources.storage import cut, dealt

_HOP = re.compile(r"(<->|->|<-)([A-Za-z_][A-Za-z0-9_]*|\?)")


def _keys(edges: DataFrame, *names: str) -> T.StructType:
    """A schema of columns of the edges' key type."""
    return T.StructType([T.StructField(n, edges.schema[0].dataType) for n in names])


def oriented(edges: DataFrame, direction: str) -> DataFrame:
    """Edges with the columns `_from` and `_to` in the direction of travel: out, in or both."""
    ahead = edges.select(F.col("in").alias("_from"), F.col("out").alias("_to"))
    back = edges.select(F.col("out").alias("_from"), F.col("in").alias("_to"))
    if direction not in ("out", "in", "both"):
        raise ValueError(f"not a direction: {direction}")
    return ahead if direction == "out" else back if direction == "in" else ahead.union(back)


def follow(catalog: Catalog, start: DataFrame, table: str, path: str) -> tuple[DataFrame, str]:
    """The rows at the end of a path from the rows `start` of a table, and the table they are of.

    Steps alternate between edges and tables; a path that ends with an edge gives edge rows, `?` stands for
    the table that the edge leads to.
    """
    steps = _HOP.findall(path)
    if not steps or "".join(a + n for a, n in steps) != path:
        raise ValueError(f"not a path: {path!r}")
    frontier = start.select(F.col(catalog.key(table)).alias("_at"))
    i = 0
    while i < len(steps):
        arrow, name = steps[i]
        if name not in catalog.edges:
            raise ValueError(f"not an edge: {name}")
        edge = catalog.edges[name]
        direction = {"->": "out", "<-": "in", "<->": "both"}[arrow]
        if i + 1 == len(steps):
            rows = catalog.frame(name)
            on = {"out": rows["in"] == frontier["_at"], "in": rows["out"] == frontier["_at"], "both": (rows["in"] == frontier["_at"]) | (rows["out"] == frontier["_at"])}[direction]
            if direction == "both":
                # equi-joins rather than one join by a disjunction; the second half has the edges that the first doesn't
                ahead = rows.join(frontier, rows["in"] == frontier["_at"], "left_semi")
                back = rows.join(frontier, rows["out"] == frontier["_at"], "left_semi").join(frontier, rows["in"] == frontier["_at"], "left_anti")
                return ahead.union(back), name
            return rows.join(frontier, on).drop("_at"), name
        table = steps[i + 1][1]
        if table == "?":
            table = edge.from_table if direction == "in" else edge.to_table
        moved = frontier.join(oriented(catalog.frame(name), direction), F.col("_at") == F.col("_from")).select(F.col("_to").alias("_at"))
        i += 2
        if i == len(steps):
            nodes = catalog.frame(table)
            return nodes.join(moved, nodes[catalog.key(table)] == moved["_at"]).drop("_at"), table
        frontier = moved
    raise AssertionError


def edges_of(catalog: Catalog, key: object, edge: str, direction: str = "out") -> DataFrame:
    """Edge rows that leave (out) or reach (in) a record."""
    if direction not in ("out", "in"):
        raise ValueError(f"not a direction: {direction}")
    return catalog.frame(edge).where(F.col("in" if direction == "out" else "out") == key)


def related(catalog: Catalog, key: object, edge: str, table: str, direction: str = "out") -> DataFrame:
    """Rows of a table one hop from a record."""
    ends = edges_of(catalog, key, edge, direction).select(F.col("out" if direction == "out" else "in").alias("_at"))
    nodes = catalog.frame(table)
    return nodes.join(ends, nodes[catalog.key(table)] == ends["_at"]).drop("_at")


def count_related(catalog: Catalog, key: object, edge: str, direction: str = "out") -> DataFrame:
    """One row with the number of edges."""
    return edges_of(catalog, key, edge, direction).agg(F.count("*").alias("count"))


def traverse_with_depth(catalog: Catalog, key: object, edge: str, table: str, depth: int, direction: str = "out") -> DataFrame:
    """Rows of a table at the ends of paths of 1 to `depth` edges, one for each path."""
    steps = oriented(catalog.frame(edge), direction)
    at = steps.where(F.col("_from") == key).select(F.col("_to").alias("_at"))
    reached = at
    for _ in range(depth - 1):
        at = at.join(steps, F.col("_at") == F.col("_from")).select(F.col("_to").alias("_at"))
        reached = reached.union(at)
    nodes = catalog.frame(table)
    return nodes.join(reached, nodes[catalog.key(table)] == reached["_at"]).drop("_at")


def neighbours(catalog: Catalog, key: object, edge: str, depth: int = 1, direction: str = "both") -> DataFrame:
    """Distinct records within `depth` hops, without the start: `id` and the `depth` at which each is met first."""
    if depth < 1:
        raise ValueError("depth must be at least 1")
    steps = oriented(catalog.frame(edge), direction)
    start = steps.sparkSession.createDataFrame([(key,)], _keys(steps, "id"))
    seen, frontier = start.withColumn("depth", F.lit(0)), start
    for level in range(1, depth + 1):
        met = frontier.join(dealt(steps), F.col("id") == F.col("_from")).select(F.col("_to").alias("id")).distinct()
        frontier = cut(met.join(dealt(seen), "id", "left_anti"))
        seen = seen.union(frontier.withColumn("depth", F.lit(level)))
    return seen.where("depth > 0")


def degrees(catalog: Catalog, edge: str, table: str | None = None) -> DataFrame:
    """id, in_degree, out_degree and total of every record that an edge touches, or with `table` of all its records; one shuffle of edges."""
    ends = catalog.frame(edge).select(F.explode(F.array(F.struct(F.col("in").alias("id"), F.lit(0).alias("i"), F.lit(1).alias("o")), F.struct(F.col("out").alias("id"), F.lit(1).alias("i"), F.lit(0).alias("o")))).alias("e"))
    per = ends.groupBy(F.col("e.id").alias("id")).agg(F.sum("e.i").alias("in_degree"), F.sum("e.o").alias("out_degree"))
    if table is not None:
        every = catalog.frame(table).select(F.col(catalog.key(table)).alias("id")).distinct()
        per = every.join(per, "id", "left").select("id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("in_degree", "out_degree")])
    return per.withColumn("total", F.col("in_degree") + F.col("out_degree"))


def degree(catalog: Catalog, key: object, edge: str) -> DataFrame:
    """One row: in_degree, out_degree and total of a record."""
    e = catalog.frame(edge).where((F.col("in") == key) | (F.col("out") == key))
    counted = e.agg(F.count_if(F.col("out") == key).alias("in_degree"), F.count_if(F.col("in") == key).alias("out_degree"))
    return counted.withColumn("total", F.col("in_degree") + F.col("out_degree"))


def mutual(catalog: Catalog, key: object, edge: str) -> DataFrame:
    """`id` of the records that the record leads to and that lead back to it."""
    out = edges_of(catalog, key, edge).select(F.col("out").alias("id")).distinct()
    back = edges_of(catalog, key, edge, "in").select(F.col("in").alias("id"))
    return out.join(back, "id", "left_semi")


def shortest_path(catalog: Catalog, a: object, b: object, edge: str, max_depth: int = 10, where: Condition | None = None, table: str | None = None) -> DataFrame:
    """step and id of a shortest path along outgoing edges; no rows if there is none within max_depth.

    where: a condition on the edges that may be used.  table: the records of the path follow, with all columns.
    Every record that is met remembers the smallest record it was met from, so the path is one of the
    shortest and always the same.
    """
    edges = catalog.frame(edge)
    steps = oriented(edges if where is None else edges.where(as_column(where, edges)), "out")
    spark = steps.sparkSession
    start = spark.createDataFrame([(a, None)], _keys(steps, "id", "parent"))
    form = T.StructType([T.StructField("step", T.IntegerType()), *_keys(steps, "id").fields])
    levels, seen, frontier = [start], start, start
    found = a == b
    while not found and len(levels) <= max_depth:
        met = frontier.join(dealt(steps), F.col("id") == F.col("_from")).groupBy("_to").agg(F.min("id").alias("parent")).withColumnRenamed("_to", "id")
        frontier = cut(met.join(dealt(seen.select("id")), "id", "left_anti"))
        if frontier.isEmpty():
            break
        levels.append(frontier)
        seen = seen.union(frontier)
        found = not frontier.where(F.col("id") == b).isEmpty()
    path, at = [], b
    if not found:
        levels = []
    for i in range(len(levels) - 1, -1, -1):
        path.append((i, at))
        at = levels[i].where(F.col("id") == at).first()["parent"]
    out = spark.createDataFrame(path[::-1], form)
    if table is None:
        return out
    nodes = catalog.frame(table)
    return out.join(nodes, out["id"] == nodes[catalog.key(table)])  # max_depth rows, at most


def leading(catalog: Catalog, table: str, path: str, condition: Condition | None = None) -> DataFrame:
    """`_key` of the rows of a table from which a path leads to a row for which the condition holds.

    The path is walked from its end, with distinct keys at each step, so no row is met twice.
    """
    steps = _HOP.findall(path)
    if not steps or "".join(a + n for a, n in steps) != path or len(steps) % 2:
        raise ValueError(f"not a path to a table: {path!r}")
    hops = [(catalog.edges[name], {"->": "out", "<-": "in", "<->": "both"}[arrow]) for arrow, name in steps[::2]]
    last, direction = hops[-1]
    target = steps[-1][1] if steps[-1][1] != "?" else last.from_table if direction == "in" else last.to_table
    rows = catalog.frame(target)
    keys = (rows if condition is None else rows.where(as_column(condition, rows))).select(F.col(catalog.key(target)).alias("_key"))
    for edge, direction in reversed(hops):
        moved = oriented(catalog.frame(edge.name), direction)
        keys = moved.join(keys, moved["_to"] == keys["_key"], "left_semi").select(F.col("_from").alias("_key")).distinct()
    return keys


def relate(edges: DataFrame, a: object, b: object, **properties: object) -> DataFrame:
    """The edges and one more."""
    form = T.StructType([T.StructField(n, edges.schema[n].dataType) for n in ("in", "out")])
    new = edges.sparkSession.createDataFrame([(a, b)], form).withColumns({k: F.lit(v) for k, v in properties.items()})
    return edges.unionByName(new, allowMissingColumns=True)


def unrelate(edges: DataFrame, a: object, b: object) -> DataFrame:
    """The edges without those from a to b."""
    return edges.where(~((F.col("in") == a) & (F.col("out") == b)))


def collected(catalog: Catalog, table: str, edge: str, target: str, columns: list[Column | str], alias: str) -> DataFrame:
    """Each row of a table with an array of structs of the rows it leads to."""
    key, nodes = catalog.key(table), catalog.frame(target)
    ends = catalog.frame(edge).join(nodes, F.col("out") == nodes[catalog.key(target)]).groupBy("in").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias(alias))
    rows = catalog.frame(table)
    return rows.join(ends, rows[key] == ends["in"], "left").drop("in")
