"""Hints: settings of one query's execution."""

from __future__ import annotations

import contextlib
import io
from collections.abc import Container, Iterable, Iterator
from dataclasses import dataclass
from typing import Literal

from pyspark.sql import DataFrame, Row


@dataclass(frozen=True)
class Index:
    """Read a table of the query through the layout of an index.  force: fail where there is none; else the table is read."""

    table: str
    name: str
    force: bool = False


@dataclass(frozen=True)
class Parallel:
    workers: int

    def __post_init__(self) -> None:
        if not 1 <= self.workers <= 32:
            raise ValueError("workers must be 1 to 32")


@dataclass(frozen=True)
class Timeout:
    seconds: float

    def __post_init__(self) -> None:
        if self.seconds <= 0:
            raise ValueError("a timeout must be positive")


@dataclass(frozen=True)
class Fetch:
    mode: Literal["eager", "lazy", "batch"]
    size: int | None = None

    def __post_init__(self) -> None:
        if self.mode == "batch" and (self.size is None or not 1 <= self.size <= 10_000):
            raise ValueError("a batch needs a size of 1 to 10000")


@dataclass(frozen=True)
class Explain:
    full: bool = False


Hint = Index | Parallel | Timeout | Fetch | Explain


def merged(hints: Iterable[Hint]) -> dict[type, Hint]:
    """The last hint of each kind."""
    return {type(h): h for h in hints}


def indexes(hints: Iterable[Hint], tables: Iterable[str], there: Container[tuple[str, str]]) -> dict[str, str]:
    """By table the name of the index whose layout is read: the last hint of each table, of those that there are."""
    last, tables = {h.table: h for h in hints if isinstance(h, Index)}, list(tables)
    for h in last.values():
        if h.table not in tables:
            raise ValueError(f"an index of {h.table} on a query of {', '.join(tables)}")
        if h.force and (h.table, h.name) not in there:
            raise ValueError(f"no layout of the index {h.name} of {h.table}")
    return {t: h.name for t, h in last.items() if (t, h.name) in there}


def explained(df: DataFrame, full: bool = False) -> str:
    """The plan as text: the physical one, or with all stages of its making."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("extended" if full else "formatted")
    return out.getvalue()


def applied(df: DataFrame, hints: Iterable[Hint]) -> DataFrame:
    """The DataFrame under the hints that concern its plan."""
    last = merged(hints)
    if e := last.get(Explain):
        print(explained(df, e.full))
    # the result in so many parts; scans and shuffles below keep their own
    return df.hint("rebalance", p.workers) if (p := last.get(Parallel)) else df


def fetch(df: DataFrame, hints: Iterable[Hint]) -> Iterator[Row] | Iterator[list[Row]]:
    """Rows as the fetch hint has it: all at once, one by one, or in lists.  A timeout cancels the query's jobs."""
    import threading

    last = merged(hints)
    context, timer = df.sparkSession.sparkContext, None
    if t := last.get(Timeout):
        tag = f"query-{id(df)}"
        context.addJobTag(tag)
        timer = threading.Timer(t.seconds, context.cancelJobsWithTag, (tag,))
        timer.start()
    try:
        f = last.get(Fetch, Fetch("eager"))
        if f.mode == "eager":
            yield from df.collect()
        elif f.mode == "lazy":
            yield from df.toLocalIterator()
        else:
            rows: list[Row] = []
            for r in df.toLocalIterator():
                rows.append(r)
                if len(rows) == f.size:
                    yield rows
                    rows = []
            if rows:
                yield rows
    finally:
        if timer:
            timer.cancel()
            context.removeJobTag(tag)
