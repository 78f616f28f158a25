"""The query: an immutable description that becomes one lazy DataFrame."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from recordspark.functions import vectors
from recordspark.functions.predicates import Condition, FullText, as_column, in_rows
from recordspark.functions.scalar import bound
from recordspark.operators.graph import follow, leading
from recordspark.plans import hints as H
from recordspark.sources.catalog import Catalog
from recordspark.sources.ids import RecordId


#: A column, a path into one, or all columns.
_NAME = re.compile(r"(\w+|`[^`]+`|\*)(\.(\w+|`[^`]+`|\*))*")


@dataclass(frozen=True)
class Near:
    field: str
    vector: tuple[float, ...]
    k: int
    metric: str
    threshold: float | None
    probes: int | None = None
    exact: bool = False


@dataclass(frozen=True)
class Join:
    table: str
    on: Condition
    how: str


@dataclass(frozen=True)
class Leads:
    path: str
    condition: Condition | None


@dataclass(frozen=True)
class Query:
    """Every method returns a new query.  Clauses apply in the order: scan, path, joins, links, where, nearest, group, order, offset, limit."""

    source: str | RecordId | None = None
    fields: tuple[Column | str, ...] = ()
    conditions: tuple[Condition, ...] = ()
    path: str = ""
    joins: tuple[Join, ...] = ()
    links: tuple[str, ...] = ()
    leads: tuple[Leads, ...] = ()
    parameters: tuple[tuple[str, Any], ...] = ()
    near: Near | None = None
    groups: tuple[str, ...] = ()
    whole: bool = False
    having_: tuple[Condition, ...] = ()
    orders: tuple[tuple[str, str], ...] = ()
    count: int | None = None
    skip: int = 0
    hints: tuple[H.Hint, ...] = field(default=())

    def select(self, *fields: Column | str) -> Query:
        """No fields: all columns."""
        return replace(self, fields=fields)

    def from_table(self, source: str | RecordId) -> Query:
        """A table, or one record by its id."""
        return replace(self, source=source)

    def where(self, condition: Condition) -> Query:
        """All conditions must hold."""
        return replace(self, conditions=(*self.conditions, condition))

    def traverse(self, path: str) -> Query:
        """Follow edges: `->edge` to edge rows, `->edge->table` to their targets, `<-` backwards, `<->` both ways."""
        return replace(self, path=self.path + path)

    def join(self, table: str, on: Condition, how: str = "inner") -> Query:
        return replace(self, joins=(*self.joins, Join(table, on, how)))

    def out(self, edge: str, depth: int = 1) -> Query:
        """Exactly `depth` hops along an edge, to the records there."""
        return self._hops(f"->{edge}->?", depth)

    def in_(self, edge: str, depth: int = 1) -> Query:
        return self._hops(f"<-{edge}<-?", depth)

    def both(self, edge: str, depth: int = 1) -> Query:
        return self._hops(f"<->{edge}<->?", depth)

    def _hops(self, hop: str, depth: int) -> Query:
        if depth < 1:
            raise ValueError("depth must be at least 1")
        return self.traverse(hop * depth)

    def fetch_link(self, *fields: str) -> Query:
        """Put the record that a declared link names in the link's place, as a struct; dots lead into fetched records."""
        return replace(self, links=(*self.links, *fields))

    def where_path(self, path: str, condition: Condition | None = None) -> Query:
        """Rows from which the path leads to a record, of those for which the condition holds."""
        return replace(self, leads=(*self.leads, Leads(path, condition)))

    def bind(self, **values: Any) -> Query:
        """Values for the `:name` markers in whatever is given as text: conditions of rows, groups, joins and paths, and fields."""
        return replace(self, parameters=(*self.parameters, *values.items()))

    def group_by(self, *fields: str) -> Query:
        return replace(self, groups=(*self.groups, *fields))

    def group_all(self) -> Query:
        """The whole input is one group; this wins over `group_by`."""
        return replace(self, whole=True)

    def having(self, condition: Condition) -> Query:
        """On the columns after grouping."""
        return replace(self, having_=(*self.having_, condition))

    def order_by(self, name: str, direction: str = "ASC") -> Query:
        if direction.upper() not in ("ASC", "DESC"):
            raise ValueError(f"not a direction: {direction}")
        return replace(self, orders=(*self.orders, (name, direction.upper())))

    def limit(self, n: int) -> Query:
        if n < 0:
            raise ValueError("a limit can't be negative")
        return replace(self, count=n)

    def offset(self, n: int) -> Query:
        if n < 0:
            raise ValueError("an offset can't be negative")
        return replace(self, skip=n)

    def vector_search(self, name: str, vector: list[float], k: int = 10, metric: str = "COSINE", threshold: float | None = None, probes: int | None = None, exact: bool = False) -> Query:
        """The k nearest of the rows that the conditions keep; ties go to the smaller key.

        Where the table has an index of the field and metric, only cells near the vector are read: as many as
        `probes` (the index's own number without it), or with `exact` all that can hold one of the k nearest, which takes
        a job of its own to know.  Without an index every search is exact.
        """
        if k < 1 or not vector:
            raise ValueError("a vector and at least one neighbour are needed")
        if metric.upper() not in vectors.METRICS:
            raise ValueError(f"unknown metric: {metric}")
        if probes is not None and probes < 1:
            raise ValueError("a search reads at least one cell")
        return replace(self, near=Near(name, tuple(vector), k, metric.upper(), threshold, probes, exact))

    def similarity_score(self, name: str, vector: list[float], metric: str = "COSINE", alias: str = "similarity") -> Query:
        """One more column; without a selection it stands alone."""
        return replace(self, fields=(*self.fields, vectors.score(name, vector, metric).alias(alias)))

    def hint(self, *hints: H.Hint) -> Query:
        return replace(self, hints=(*self.hints, *hints))

    # what becomes of it
    def frame(self, catalog: Catalog) -> DataFrame:
        if self.source is None:
            raise ValueError("a query needs a table")
        if any(isinstance(h, H.Index) for h in self.hints):
            start = self.source.table if isinstance(self.source, RecordId) else self.source.split(":")[0]
            catalog = catalog.laid_out(H.indexes(self.hints, self._tables(catalog, start), catalog.layouts))
        name, df = catalog.target(self.source)
        if self.path:
            df, name = follow(catalog, df, name, self.path)
        key = catalog.tables[name].key if name in catalog.tables else None
        index = catalog.vector_indexes.get((name, self.near.field)) if self.near and self.source == name and not self.path else None
        if index and index.metric == self.near.metric:
            n, kept = self.near, lambda rows: self._kept(catalog, name, key, catalog.visible(name, rows))
            df = kept(index.exact(catalog.spark, n.vector, n.k, kept, n.threshold) if n.exact else index.near(catalog.spark, n.vector, n.probes))
        else:
            df = self._kept(catalog, name, key, df)
        if self.near:
            df = self._nearest(df, key)
        return H.applied(self._shaped(df), self.hints)

    def _tables(self, catalog: Catalog, start: str) -> list[str]:
        """The tables that the query names: its own, and those of its path, joins and links."""
        names = [start, *(j.table for j in self.joins)]
        for p in [self.path, *(x.path for x in self.leads)]:
            for n in re.findall(r"\w+", p):
                names += [catalog.edges[n].from_table, catalog.edges[n].to_table] if n in catalog.edges else [n]
        return list(dict.fromkeys([*names, *(t for (_, link), t in catalog.links.items() if any(link in x.split(".") for x in self.links))]))

    def _kept(self, catalog: Catalog, name: str, key: str | None, df: DataFrame) -> DataFrame:
        """The rows under joins, links and conditions."""
        for j in self.joins:
            other = catalog.frame(j.table)
            df = df.join(other, as_column(self._text(j.on), df), j.how)
        for link in self.links:
            df = self._fetched(catalog, df, name, link)
        for p in self.leads:
            keys = leading(catalog, name, p.path, self._text(p.condition))
            df = df.join(keys, df[key] == keys["_key"], "left_semi")
        for c in self.conditions:
            index = catalog.search_indexes.get((name, c.name)) if isinstance(c, FullText) else None
            keys = index.matching(catalog.spark, c.name, c.terms, c.phrase) if index else None
            df = df.where(as_column(self._text(c), df)) if keys is None else df.join(keys, df[key] == keys["key"], "left_semi")
        return df

    def _shaped(self, df: DataFrame) -> DataFrame:
        """Grouping, ordering, pages and the selection."""
        if self.whole:
            df = df.agg(*self._columns(()))
        elif self.groups:
            df = df.groupBy(*self.groups).agg(*self._columns(self.groups))
        for c in self.having_:
            df = df.where(as_column(self._text(c), df))
        plain = not (self.whole or self.groups)
        # sort keys may be columns that the selection leaves out, or ones that it makes
        late = plain and self.fields and all(o in df.columns for o, _ in self.orders)
        dropped: list[str] = []
        if plain and self.fields and not late:
            chosen = self._selected(df)
            dropped = [o for o, _ in self.orders if o in df.columns and o not in chosen.columns]
            df = self._selected(df, dropped) if dropped else chosen
        if self.orders:
            df = df.orderBy(*[F.asc_nulls_first(o) if d == "ASC" else F.desc_nulls_last(o) for o, d in self.orders])
        if self.skip:
            df = df.offset(self.skip)
        if self.count is not None:
            df = df.limit(self.count)
        if late:
            df = self._selected(df)
        if dropped:
            df = df.drop(*dropped)
        return df

    def _selected(self, df: DataFrame, more: list[str] | None = None) -> DataFrame:
        """The selection, and `more` columns behind it.  Texts that aren't names of columns are Spark SQL expressions."""
        fields = [*self.fields, *(more or [])]
        return df.select(*[f if not isinstance(f, str) or f in df.columns or _NAME.fullmatch(f) else F.expr(self._text(f)) for f in fields])

    def _text[C](self, condition: C) -> C:
        """Text with the bound values in the place of its markers; anything else as it is."""
        return bound(condition, dict(self.parameters)) if self.parameters and isinstance(condition, str) else condition

    def _fetched(self, catalog: Catalog, df: DataFrame, table: str, link: str) -> DataFrame:
        *outer, last = link.split(".")
        for name in outer:
            table = catalog.links[table, name]
        if (table, last) not in catalog.links:
            raise ValueError(f"not a link: {link}")
        target = catalog.links[table, last]
        rows = catalog.frame(target)
        there = rows.select(F.col(catalog.key(target)).alias("_link"), F.struct(*rows.columns).alias("_record"))
        met = df.join(there, F.col(link) == F.col("_link"), "left")
        new = F.col("_record")
        if outer:
            new = F.col(outer[0]).withField(".".join([*outer[1:], last]), new)
        return met.withColumn(outer[0] if outer else last, new).drop("_link", "_record")

    # subqueries of other queries' conditions
    def scalar(self, catalog: Catalog) -> Column:
        """The only value of the only row."""
        return self.frame(catalog).scalar()

    def inside(self, catalog: Catalog, name: str) -> Condition:
        """The condition that a column's value is in this query's only column."""
        return in_rows(name, self.frame(catalog))

    def count_rows(self, catalog: Catalog) -> int:
        return self.frame(catalog).count()

    def exists(self, catalog: Catalog) -> bool:
        return not self.frame(catalog).isEmpty()

    def _columns(self, keys: tuple[str, ...]) -> list[Column]:
        columns = [f for f in self.fields if not isinstance(f, str)]
        if any(isinstance(f, str) and f not in keys for f in self.fields):
            raise ValueError("a grouped query selects its keys and aggregates")
        if not columns:
            raise ValueError("a grouped query needs an aggregate")
        return columns

    def _nearest(self, df: DataFrame, key: str | None) -> DataFrame:
        n = self.near
        assert n is not None
        up = vectors.is_similarity(n.metric)
        scored = df.withColumn("_score", vectors.score(n.field, list(n.vector), n.metric))
        if n.threshold is not None:
            scored = scored.where(F.col("_score") >= n.threshold if up else F.col("_score") <= n.threshold)
        order = [F.desc_nulls_last("_score") if up else F.asc_nulls_last("_score"), *([F.asc(key)] if key else [])]
        return scored.orderBy(*order).limit(n.k).drop("_score")

    def fetch(self, catalog: Catalog) -> Any:
        return H.fetch(self.frame(catalog), self.hints)

    def first(self, catalog: Catalog) -> Row | None:
        rows = self.frame(catalog).take(1)
        return rows[0] if rows else None


def vector_query(table: str, name: str, vector: list[float], k: int = 10, metric: str = "COSINE", threshold: float | None = None, score: str | None = None, probes: int | None = None, exact: bool = False) -> Query:
    """The k nearest rows of a table; score: the name of a score column."""
    q = Query().from_table(table).vector_search(name, vector, k, metric, threshold, probes, exact)
    return q.select("*").similarity_score(name, vector, metric, score) if score else q
