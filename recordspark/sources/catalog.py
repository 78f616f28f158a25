"""Tables, their keys, and edge tables over them."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordspark.sources.ids import RecordId
from recordspark.sources.layout import Layout
from recordspark.sources.schema import TableSchema
from recordspark.sources.search_index import SearchIndex
from recordspark.sources.vector_index import VectorIndex


@dataclass(frozen=True)
class Table:
    """A source of rows.  rule: rows that readers may see (a row permission), applied at every scan."""

    name: str
    load: Callable[[], DataFrame]
    key: str = "id"
    rule: Callable[[DataFrame], Column] | None = None


@dataclass(frozen=True)
class Edge:
    """An edge table with the columns `in` (source key) and `out` (target key), from one table to another."""

    name: str
    load: Callable[[], DataFrame]
    from_table: str
    to_table: str


@dataclass
class Catalog:
    spark: SparkSession
    tables: dict[str, Table] = field(default_factory=dict)
    edges: dict[str, Edge] = field(default_factory=dict)
    links: dict[tuple[str, str], str] = field(default_factory=dict)
    #: By table and field.
    vector_indexes: dict[tuple[str, str], VectorIndex] = field(default_factory=dict)
    search_indexes: dict[tuple[str, str], SearchIndex] = field(default_factory=dict)
    #: Tables and edges whose schema says which rows may be seen, and what may be written.
    schemas: dict[str, TableSchema] = field(default_factory=dict)
    #: By table and name of the index.
    layouts: dict[tuple[str, str], Layout] = field(default_factory=dict)

    def add(self, name: str, source: DataFrame | str | Callable[[], DataFrame], key: str = "id", rule: Callable[[DataFrame], Column] | None = None) -> Catalog:
        """Register a DataFrame, a Parquet path, or a function that makes a DataFrame."""
        load = source if callable(source) else (lambda: self.spark.read.parquet(source)) if isinstance(source, str) else (lambda: source)
        self.tables[name] = Table(name, load, key, rule)
        return self

    def add_edge(self, name: str, source: DataFrame | Callable[[], DataFrame], from_table: str, to_table: str) -> Catalog:
        self.edges[name] = Edge(name, source if callable(source) else lambda: source, from_table, to_table)
        return self

    def key(self, name: str) -> str:
        return self.tables[name].key

    def frame(self, name: str) -> DataFrame:
        """All visible rows of a table, or of an edge table."""
        if name in self.edges:
            df = self.edges[name].load()
            return df.where(self.schemas[name].permitted("select")) if name in self.schemas else df
        if name not in self.tables:
            raise KeyError(f"unknown table: {name}")
        return self.visible(name, self.tables[name].load())

    def visible(self, name: str, df: DataFrame) -> DataFrame:
        """Of rows of a table those that readers may see."""
        rule = self.tables[name].rule
        df = df if rule is None else df.where(rule(df))
        return df.where(self.schemas[name].permitted("select")) if name in self.schemas else df

    def add_schema(self, schema: TableSchema) -> Catalog:
        """Scans of the table or edge see the rows that its schema permits; `enforced` mutations follow it."""
        if schema.name not in self.tables and schema.name not in self.edges:
            raise KeyError(f"unknown table: {schema.name}")
        self.schemas[schema.name] = schema
        return self

    def keys(self) -> dict[str, tuple[DataFrame, str]]:
        """All rows and the key of every table, seen or not: what references may name."""
        return {n: (t.load(), t.key) for n, t in self.tables.items()}

    def target(self, target: str | RecordId) -> tuple[str, DataFrame]:
        """The table's name and rows of a table, or of one record given by its id."""
        if isinstance(target, str) and ":" not in target:
            return target, self.frame(target)
        ref = RecordId.parse(target) if isinstance(target, str) else target
        df, key = self.frame(ref.table), self.key(ref.table)
        # an id that the key's type can't hold is nobody's
        return ref.table, df.where(df[key] == F.lit(ref.id).try_cast(df.schema[key].dataType))

    def add_link(self, table: str, field_: str, target: str) -> Catalog:
        """Declare that a field holds keys of another table."""
        self.links[table, field_] = target
        return self

    def add_vector_index(self, table: str, index: VectorIndex) -> Catalog:
        """Searches by the index's field and metric read its cells instead of the table."""
        if table not in self.tables:
            raise KeyError(f"unknown table: {table}")
        self.vector_indexes[table, index.field] = index
        return self

    def add_search_index(self, table: str, index: SearchIndex) -> Catalog:
        """Full-text conditions on the index's fields read its postings instead of texts."""
        if table not in self.tables:
            raise KeyError(f"unknown table: {table}")
        self.search_indexes |= {(table, f): index for f in index.fields}
        return self

    def add_layout(self, table: str, layout: Layout) -> Catalog:
        """Queries with a hint to the layout's index read it instead of the table."""
        if table not in self.tables:
            raise KeyError(f"unknown table: {table}")
        self.layouts[table, layout.name] = layout
        return self

    def laid_out(self, names: Mapping[str, str]) -> Catalog:
        """The catalog with the layouts of some tables (by table the index's name) in the tables' place."""
        load = lambda found: lambda: found.rows(self.spark)  # noqa: E731  the table's rule stays
        new = {t: replace(self.tables[t], load=load(self.layouts[t, n])) for t, n in names.items()}
        return replace(self, tables=self.tables | new)

    def describe(self) -> list[tuple[str, str, str]]:
        """(table, column, type) of everything registered."""
        return [(n, c, k) for n in [*self.tables, *self.edges] for c, k in self.frame(n).dtypes]


def files(spark: SparkSession, sf_dir: str) -> Catalog:
    """The catalog of a folder of Parquet tables, with the edges that its foreign keys imply."""
    c = Catalog(spark)
    keys = {"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey", "lineitem": "l_orderkey", "events": "event_id", "documents": "doc_id", "embeddings": "vec_id"}
    for name, key in keys.items():
        c.add(name, f"{sf_dir}/{name}.parquet", key)
    edge = lambda table, a, b: lambda: c.frame(table).select(F.col(a).cast("long").alias("in"), F.col(b).cast("long").alias("out"))
    c.add_edge("placed", edge("orders", "o_custkey", "o_orderkey"), "customer", "orders")
    c.add_edge("contains", edge("lineitem", "l_orderkey", "l_partkey"), "orders", "part")
    c.add_edge("supplied", lambda: edge("lineitem", "l_partkey", "l_suppkey")().distinct(), "part", "supplier")
    c.add_edge("lives_in", edge("customer", "c_custkey", "c_nationkey"), "customer", "nation")
    c.add_edge("in_region", edge("nation", "n_nationkey", "n_regionkey"), "nation", "region")

    for table, name, target in (("orders", "o_custkey", "customer"), ("customer", "c_nationkey", "nation"), ("supplier", "s_nationkey", "nation"), ("nation", "n_regionkey", "region"), ("lineitem", "l_orderkey", "orders"), ("lineitem", "l_partkey", "part"), ("lineitem", "l_suppkey", "supplier")):
        c.add_link(table, name, target)
    customers: list[int] = []

    def knows() -> DataFrame:
        """A sparse directed graph over customers, made by arithmetic on their keys."""
        k = c.frame("customer").select(F.col("c_custkey").alias("k"))
        customers.extend([] if customers else [k.count()])  # once for a catalog
        n = F.lit(customers[0])
        to = F.array(F.pmod(F.col("k") + 1, n), F.pmod(7 * F.col("k") + 3, n), F.when(F.col("k") % 3 == 0, F.pmod(F.col("k") - 1 + n, n)))
        return k.select(F.col("k").alias("in"), F.explode(to).alias("out")).where("out is not null")

    return c.add_edge("knows", knows, "customer", "customer")
