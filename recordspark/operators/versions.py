"""A graph of versions, each with any number of parents: rows of version and parent (null: none).

Searches go level by level with distinct versions, so merged branches are met once; each level is one join, cut off
from the last.  A graph with a cycle is refused before anything is searched.

Defined results: repeated rows count once.  A parent without rows of its own is a version without parents.  Null versions
take no part.  An empty graph has nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordspark.sources.storage import cut, dealt


@dataclass(frozen=True)
class Versions:
    """edges: distinct parent and version; nodes: every version with its level, the longest way from a version without parents."""

    edges: DataFrame
    nodes: DataFrame

    def ancestors(self, version: Any) -> DataFrame:
        """version and distance (of a shortest way) of all versions that a version comes from."""
        return self._reach(version, "version", "parent")

    def descendants(self, version: Any) -> DataFrame:
        """version and distance of all versions that come from a version."""
        return self._reach(version, "parent", "version")

    def heads(self) -> DataFrame:
        """The versions that nothing comes from."""
        return self.nodes.select("version").join(self.edges.select(F.col("parent").alias("version")), "version", "left_anti")

    def roots(self) -> DataFrame:
        """The versions without parents."""
        return self.nodes.where("level = 0").select("version")

    def common(self, versions: Sequence[Any]) -> DataFrame:
        """The versions that all of some versions come from or are, of the highest level: where their branches part."""
        met: DataFrame | None = None
        for v in versions:
            own = self.ancestors(v).select("version").union(self.nodes.where(F.col("version") == v).select("version"))
            met = own if met is None else met.join(own, "version", "left_semi")
        if met is None:
            raise ValueError("no versions")
        found = met.join(self.nodes, "version")
        return found.join(found.agg(F.max("level").alias("_top")), F.col("level") == F.col("_top"), "left_semi").select("version", "level")

    def path(self, a: Any, b: Any) -> DataFrame:
        """step and version of a shortest way between two versions, up or down at each step, through the smallest versions; no rows if there is none."""
        spark, kind = self.edges.sparkSession, self.edges.schema["version"].dataType.simpleString()
        steps = self.edges.select(F.col("parent").alias("_at"), F.col("version").alias("_to"))
        both = cut(steps.union(steps.select(F.col("_to").alias("_at"), F.col("_at").alias("_to"))))
        near = self._levels(a, both, b)
        last = near.where(F.col("version") == b).first()
        way = [] if last is None else [b]
        for d in range(last["distance"] - 1, -1, -1) if last is not None else ():
            before = near.where(F.col("distance") == d).select(F.col("version").alias("_at"))
            way.append(both.where(F.col("_to") == way[-1]).join(before, "_at", "left_semi").agg(F.min("_at")).first()[0])
        return spark.createDataFrame(list(enumerate(reversed(way))), f"step int, version {kind}")

    def _reach(self, version: Any, at: str, to: str) -> DataFrame:
        return self._levels(version, self.edges.select(F.col(at).alias("_at"), F.col(to).alias("_to"))).where("distance > 0")

    def _levels(self, version: Any, steps: DataFrame, until: Any = None) -> DataFrame:
        """version and distance of all that steps lead to from a version, itself included; no farther than `until`."""
        frontier = self.nodes.where(F.col("version") == version).select("version")
        seen, out, distance = frontier, frontier.withColumn("distance", F.lit(0)), 0
        while version != until:
            distance += 1
            met = steps.join(dealt(frontier), F.col("_at") == F.col("version"), "left_semi").select(F.col("_to").alias("version")).distinct()
            frontier = cut(met.join(dealt(seen), "version", "left_anti"))
            if frontier.isEmpty():
                break
            seen, out = seen.union(frontier), out.union(frontier.withColumn("distance", F.lit(distance)))
            if until is not None and not frontier.where(F.col("version") == until).isEmpty():
                break
        return out


def graph(rows: DataFrame) -> Versions:
    """The graph of rows of version and parent; fails if it has a cycle."""
    edges = cut(rows.where("version is not null and parent is not null").select("parent", "version").distinct())
    left = cut(rows.select("version").union(rows.select("parent")).where("version is not null").distinct())
    out, level, waiting = left.withColumn("level", F.lit(0)).limit(0), 0, edges
    while not left.isEmpty():
        # versions whose parents all have a level
        ready = cut(left.join(dealt(waiting.select("version")), "version", "left_anti"))
        if ready.isEmpty():
            raise ValueError(f"versions come from themselves, {left.first()[0]} among them or after them")
        out, level = out.union(ready.withColumn("level", F.lit(level))), level + 1
        left = cut(left.join(dealt(ready), "version", "left_anti"))
        waiting = cut(waiting.join(dealt(ready.withColumnRenamed("version", "parent")), "parent", "left_anti"))
    return Versions(edges, out)
