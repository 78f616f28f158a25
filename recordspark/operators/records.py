"""Reading records: by id, by condition, first, last, pages and counts."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass, fields, is_dataclass
from math import ceil
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from recordspark.functions.predicates import Condition, as_column
from recordspark.operators import mutate
from recordspark.plans.query import Query
from recordspark.sources.catalog import Catalog


def get_record(catalog: Catalog, table: str, key: object) -> Row | None:
    """A record by its key; a key that the column's type can't hold is nobody's."""
    df, name = catalog.frame(table), catalog.key(table)
    rows = df.where(df[name] == F.lit(key).try_cast(df.schema[name].dataType)).take(1)
    return rows[0] if rows else None


def exists(catalog: Catalog, table: str, key: object) -> bool:
    return get_record(catalog, table, key) is not None


def query_records(catalog: Catalog, table: str, conditions: Iterable[Condition] = (), order_by: tuple[str, str] | None = None, limit: int | None = None, offset: int = 0) -> DataFrame:
    q = Query().from_table(table)
    for c in conditions:
        q = q.where(c)
    if order_by:
        q = q.order_by(*order_by)
    if limit is not None:
        q = q.limit(limit)
    return q.offset(offset).frame(catalog)


def count_records(catalog: Catalog, table: str, condition: Condition | None = None) -> int:
    df = catalog.frame(table)
    return (df if condition is None else df.where(as_column(condition, df))).count()


def first(catalog: Catalog, table: str, order_by: tuple[str, str] | None = None, condition: Condition | None = None) -> DataFrame:
    return query_records(catalog, table, [] if condition is None else [condition], order_by, 1)


def last(catalog: Catalog, table: str, order_by: tuple[str, str] | None = None, condition: Condition | None = None) -> DataFrame:
    """The first in the other direction; without an order, the same as `first`."""
    turned = (order_by[0], "ASC" if order_by[1].upper() == "DESC" else "DESC") if order_by else None
    return first(catalog, table, turned, condition)


@dataclass(frozen=True)
class Page:
    items: list[Row]
    page: int
    page_size: int
    total: int

    @property
    def pages(self) -> int:
        return ceil(self.total / self.page_size)

    @property
    def has_next(self) -> bool:
        return self.page < self.pages

    @property
    def has_previous(self) -> bool:
        return self.page > 1


def page(catalog: Catalog, query: Query, number: int, size: int) -> Page:
    """Page `number`, from 1, of an ordered query."""
    if number < 1 or size < 1:
        raise ValueError("pages and their sizes begin at 1")
    whole = query.frame(catalog)
    return Page(query.offset((number - 1) * size).limit(size).frame(catalog).collect(), number, size, whole.count())


@dataclass(frozen=True)
class Found[R]:
    """A record, or none."""

    record: R | None

    @property
    def exists(self) -> bool:
        return self.record is not None

    def unwrap(self) -> R:
        if self.record is None:
            raise LookupError("no record")
        return self.record

    def unwrap_or(self, default: R) -> R:
        return default if self.record is None else self.record


@dataclass(frozen=True)
class Records[R]:
    """Records of a limited read, and whether there are more."""

    items: tuple[R, ...]
    limit: int | None = None
    offset: int = 0
    has_more: bool = False

    def __len__(self) -> int:
        return len(self.items)

    def __iter__(self) -> Iterator[R]:
        return iter(self.items)

    def __getitem__(self, i: int) -> R:
        return self.items[i]

    @property
    def first(self) -> R | None:
        return self.items[0] if self.items else None

    @property
    def last(self) -> R | None:
        return self.items[-1] if self.items else None


def typed[R](row: Row, kind: type[R]) -> R:
    """A row as an object of a dataclass, or of any class that takes its fields by name; other columns are left out."""
    values = row.asDict(recursive=True)
    return kind(**({f.name: values[f.name] for f in fields(kind) if f.name in values} if is_dataclass(kind) else values))


def untyped(x: Any) -> dict[str, Any]:
    """The fields of an object: of a dataclass, or of whatever names its attributes."""
    return asdict(x) if is_dataclass(x) else dict(x) if isinstance(x, Mapping) else dict(vars(x))


def create[R](df: DataFrame, objects: Sequence[R], key: str) -> tuple[mutate.Mutation, list[R]]:
    """Insert objects of one class; the mutation, and the records that were made as objects again."""
    return _written(mutate.insert(df, [untyped(x) for x in objects], key), objects)


def put[R](df: DataFrame, objects: Sequence[R], key: str, on: Sequence[str] = ()) -> tuple[mutate.Mutation, list[R]]:
    """Insert objects or replace records by them."""
    return _written(mutate.upsert(df, [untyped(x) for x in objects], key, on=on), objects)


def change[R](df: DataFrame, key: str, id_: Any, kind: type[R], **values: Any) -> tuple[mutate.Mutation, R | None]:
    """Set fields of one record; the mutation, and the record as an object (None if there is none)."""
    m = mutate.merge(df, key, id_, values)
    rows = m.result.take(1)
    return m, typed(rows[0], kind) if rows else None


def _written[R](m: mutate.Mutation, objects: Sequence[R]) -> tuple[mutate.Mutation, list[R]]:
    return m, [typed(r, type(objects[0])) for r in m.result.collect()] if objects else []  # as many as were given


def find[R](catalog: Catalog, table: str, key: object, kind: type[R]) -> Found[R]:
    row = get_record(catalog, table, key)
    return Found(None if row is None else typed(row, kind))


def read[R](catalog: Catalog, query: Query, kind: type[R], limit: int, offset: int = 0) -> Records[R]:
    """Up to `limit` records of a query; one more is read to know whether there are more."""
    rows = query.offset(offset).limit(limit + 1).frame(catalog).collect()
    return Records(tuple(typed(r, kind) for r in rows[:limit]), limit, offset, len(rows) > limit)


def raw(catalog: Catalog, text: str, **parameters: Any) -> DataFrame:
    """A Spark SQL statement over the catalog: `{name}` stands for a table or an edge, `:name` for a parameter.  No view stays behind."""
    names = {n for n in re.findall(r"\{(\w+)\}", text) if n in catalog.tables or n in catalog.edges}
    return catalog.spark.sql(text, args=parameters, **{n: catalog.frame(n) for n in names})


def raw_typed[R](catalog: Catalog, kind: type[R], text: str, **parameters: Any) -> list[R]:
    """The rows of a statement as objects; they come to the driver."""
    return [typed(r, kind) for r in raw(catalog, text, **parameters).collect()]


# results
def one(df: DataFrame) -> dict[str, Any] | None:
    rows = df.take(1)
    return rows[0].asDict(recursive=True) if rows else None


def scalar(df: DataFrame, name: str, default: Any = 0) -> Any:
    row = one(df)
    return default if row is None or row.get(name) is None else row[name]


def has_results(df: DataFrame) -> bool:
    return not df.isEmpty()
