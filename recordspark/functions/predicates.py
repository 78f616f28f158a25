"""Predicates.  Each is a function of a DataFrame, so that `contains` can follow a column's type.

Comparisons follow SQL: with null they are neither true nor false, and the row is left out.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordspark.functions.scalar import value


@dataclass(frozen=True)
class Predicate:
    """A condition that becomes a Column once the rows are known."""

    on: Callable[[DataFrame], Column]

    def __and__(self, other: Predicate) -> Predicate:
        return Predicate(lambda df: self.on(df) & other.on(df))

    def __or__(self, other: Predicate) -> Predicate:
        return Predicate(lambda df: self.on(df) | other.on(df))

    def __invert__(self) -> Predicate:
        return Predicate(lambda df: ~self.on(df))


@dataclass(frozen=True)
class FullText(Predicate):
    """A full-text condition; a query whose table has a search index of the field asks that."""

    name: str
    terms: str
    phrase: bool = False


Condition = Predicate | Column | str


def as_column(condition: Condition, df: DataFrame) -> Column:
    """A condition as a Column; text is a Spark SQL expression."""
    if isinstance(condition, Predicate):
        return condition.on(df)
    return F.expr(condition) if isinstance(condition, str) else condition


def _compare(name: str, f: Callable[[Column, Column], Column], v: object) -> Predicate:
    return Predicate(lambda df: f(F.col(name), value(v)))


def eq(name: str, v: object) -> Predicate:
    return _compare(name, lambda a, b: a == b, v)


def ne(name: str, v: object) -> Predicate:
    return _compare(name, lambda a, b: a != b, v)


def gt(name: str, v: object) -> Predicate:
    return _compare(name, lambda a, b: a > b, v)


def gte(name: str, v: object) -> Predicate:
    return _compare(name, lambda a, b: a >= b, v)


def lt(name: str, v: object) -> Predicate:
    return _compare(name, lambda a, b: a < b, v)


def lte(name: str, v: object) -> Predicate:
    return _compare(name, lambda a, b: a <= b, v)


def _is_array(df: DataFrame, name: str) -> bool:
    return isinstance(df.select(F.col(name)).schema[0].dataType, T.ArrayType)


def contains(name: str, v: object) -> Predicate:
    """A text contains a text, or an array an element."""
    return Predicate(lambda df: F.array_contains(F.col(name), v) if _is_array(df, name) else F.col(name).contains(v))


def contains_not(name: str, v: object) -> Predicate:
    return ~contains(name, v)


def contains_all(name: str, vs: Sequence[object]) -> Predicate:
    def on(df: DataFrame) -> Column:
        if _is_array(df, name):
            return F.size(F.array_except(value(list(vs)), F.col(name))) == 0
        out = F.lit(True)
        for v in vs:
            out = out & F.col(name).contains(v)
        return out

    return Predicate(on)


def contains_any(name: str, vs: Sequence[object]) -> Predicate:
    def on(df: DataFrame) -> Column:
        if _is_array(df, name):
            return F.arrays_overlap(F.col(name), value(list(vs)))
        out = F.lit(False)
        for v in vs:
            out = out | F.col(name).contains(v)
        return out

    return Predicate(on)


def inside(name: str, vs: Sequence[object]) -> Predicate:
    return Predicate(lambda df: F.col(name).isin(list(vs)))


def not_inside(name: str, vs: Sequence[object]) -> Predicate:
    return ~inside(name, vs)


def is_null(name: str) -> Predicate:
    return Predicate(lambda df: F.col(name).isNull())


def is_not_null(name: str) -> Predicate:
    return Predicate(lambda df: F.col(name).isNotNull())


def matches(name: str, pattern: str) -> Predicate:
    """A regular expression is found in the text."""
    return Predicate(lambda df: F.col(name).rlike(pattern))


def like(name: str, pattern: str) -> Predicate:
    return Predicate(lambda df: F.col(name).like(pattern))


def full_text(name: str, terms: str) -> Predicate:
    """All words of `terms` are words of the text, whatever their case; words are runs of Unicode letters, digits and `_`."""
    words = [w for w in re.split(r"\W+", terms.lower()) if w]
    return FullText(lambda df: F.size(F.array_except(value(words).cast("array<string>"), F.split(F.lower(F.col(name)), r"(?U)\W+"))) == 0, name, terms)


def phrase(name: str, terms: str) -> Predicate:
    """The words of `terms` follow each other in the text, whatever stands between words."""

    def on(df: DataFrame) -> Column:
        words = lambda x: F.filter(F.split(F.lower(x), r"(?U)\W+"), lambda w: w != "")
        joined = lambda x: F.concat(F.lit(" "), F.array_join(words(x), " "), F.lit(" "))
        return F.contains(joined(F.col(name)), joined(F.lit(terms)))

    return FullText(on, name, terms, True)


def in_rows(name: str, rows: DataFrame) -> Predicate:
    """The value is in the only column of `rows`: Spark plans a semi join."""
    return Predicate(lambda df: F.col(name).isin(rows))
