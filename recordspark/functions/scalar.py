"""Scalar and aggregate functions by the names that records queries use; all are built-in expressions."""

from __future__ import annotations

import re
from collections.abc import Mapping
from datetime import date, datetime
from decimal import Decimal
from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordspark.sources.ids import id_part, record_id

ColumnOr = Column | str


def _c(x: ColumnOr) -> Column:
    return F.col(x) if isinstance(x, str) else x


def field(name: str) -> Column:
    """A column, by a dotted path where it is nested."""
    return F.col(name)


#: Parts of a Spark SQL text in which no marker is one (quoted text and names, comments), or a marker.
_MARKER = re.compile(r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`|--[^\n]*|/\*.*?\*/|(?<![\w:]):([A-Za-z_]\w*)""", re.S)


def literal(v: object) -> str:
    """A value as Spark SQL text."""
    if v is None or isinstance(v, bool):
        return {None: "NULL", True: "TRUE", False: "FALSE"}[v]
    if isinstance(v, int):
        return f"{v}L" if -(1 << 63) <= v < 1 << 63 and abs(v) >= 1 << 31 else f"({v})"
    if isinstance(v, float):
        return f"CAST('{v!r}' AS DOUBLE)"
    if isinstance(v, Decimal):
        return f"CAST('{v}' AS DECIMAL(38, {max(0, -int(v.as_tuple().exponent))}))"
    if isinstance(v, datetime):
        return f"{'TIMESTAMP' if v.tzinfo else 'TIMESTAMP_NTZ'}'{v.isoformat(' ')}'"
    if isinstance(v, date):
        return f"DATE'{v.isoformat()}'"
    if isinstance(v, bytes):
        return f"X'{v.hex()}'"
    if isinstance(v, list | tuple):
        return f"array({', '.join(literal(x) for x in v)})"
    if isinstance(v, str):
        escaped = v.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"
    raise TypeError(f"not a value that can be bound: {v!r}")


def bound(text: str, values: Mapping[str, object]) -> str:
    """Spark SQL text with literals in the place of its `:name` markers; those without a value stay, and Spark refuses them."""
    return _MARKER.sub(lambda m: literal(values[m[1]]) if m[1] in values else m[0], text)


def json_field(column: ColumnOr, path: str) -> Column:
    """A dotted path into JSON text."""
    return F.get_json_object(_c(column), "$." + path)


def value(v: object) -> Column:
    """A literal; lists become arrays and dicts become structs.  A Column stays."""
    if isinstance(v, Column):
        return v
    if isinstance(v, (list, tuple)):
        return F.array(*[value(x) for x in v])
    if isinstance(v, dict):
        return F.struct(*[value(x).alias(k) for k, x in v.items()])
    return F.lit(v)


# aggregates
def count(x: ColumnOr | None = None) -> Column:
    return F.count(F.lit(1)) if x is None else F.count(_c(x))


def count_if(predicate: Column | None = None) -> Column:
    return count() if predicate is None else F.count_if(predicate)


def math_sum(x: ColumnOr) -> Column:
    return F.sum(_c(x))


def math_mean(x: ColumnOr) -> Column:
    return F.avg(_c(x))


def math_min(x: ColumnOr) -> Column:
    return F.min(_c(x))


def math_max(x: ColumnOr) -> Column:
    return F.max(_c(x))


# strings
def string_upper(x: ColumnOr) -> Column:
    return F.upper(_c(x))


def string_lower(x: ColumnOr) -> Column:
    return F.lower(_c(x))


def string_concat(*parts: ColumnOr) -> Column:
    """Null if any part is."""
    if not parts:
        raise ValueError("nothing to concatenate")
    return F.concat(*[_c(p) for p in parts])


def string_len(x: ColumnOr) -> Column:
    return F.length(_c(x))


def string_slice(x: ColumnOr, start: int, length: int) -> Column:
    """`length` characters from the position `start`, counted from 0."""
    return F.substring(_c(x), start + 1, length)


def is_email(x: ColumnOr) -> Column:
    return _c(x).rlike(r"^[^@\s]+@[^@\s]+\.[^@\s]+$")


# arrays
def array_length(x: ColumnOr) -> Column:
    return F.size(_c(x))


def array_contains(x: ColumnOr, v: object) -> Column:
    return F.array_contains(_c(x), v)


# numbers
def math_abs(x: ColumnOr) -> Column:
    return F.abs(_c(x))


def math_ceil(x: ColumnOr) -> Column:
    return F.ceil(_c(x)).cast("double")


def math_floor(x: ColumnOr) -> Column:
    return F.floor(_c(x)).cast("double")


def math_round(x: ColumnOr, precision: int = 0) -> Column:
    return F.round(_c(x), precision)


# time
def time_now() -> Column:
    return F.current_timestamp()


#: Microseconds of the units of durations.
DURATION_UNITS = {"us": 1, "ms": 1_000, "s": 1_000_000, "m": 60_000_000, "h": 3_600_000_000, "d": 86_400_000_000, "w": 604_800_000_000}
#: strftime directives and the date patterns they stand for.
STRFTIME = {"%Y": "yyyy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss", "%y": "yy", "%j": "DDD", "%b": "MMM", "%B": "MMMM", "%a": "EEE", "%A": "EEEE", "%p": "a", "%I": "hh", "%f": "SSSSSS", "%z": "xx"}


def time_format(x: ColumnOr, fmt: str) -> Column:
    """A timestamp by a strftime format; `%%` is a percent sign."""
    parts = [(d, d != "%%" and STRFTIME.get(d), t) for d, t in re.findall(r"(%.?)|([^%]+)", fmt, re.DOTALL)]
    if unknown := [d for d, pattern, _ in parts if d and pattern is None]:
        raise ValueError(f"unknown directive: {unknown[0]}")
    out = ""
    for literal, run in groupby(parts, lambda x: not x[1]):
        if literal:  # quoted in one piece, as two quoted pieces side by side would make a quote
            text = "".join(t or "%" for _, _, t in run).replace("'", "''")
            out += f"'{text}'"
        else:
            out += "".join(pattern for _, pattern, _ in run)
    return F.date_format(_c(x), out)


def time_floor(x: ColumnOr, unit: str) -> Column:
    """The start of the second, minute, hour, day, week, month or year."""
    return F.date_trunc(unit, _c(x))


def duration(text: str) -> Column:
    """A duration such as `1w2d`, `90m` or `1h30m` as an interval, to be added to or taken from timestamps."""
    parts = re.findall(r"(\d+)(ms|us|[wdhms])", text)
    if not parts or "".join(n + u for n, u in parts) != text:
        raise ValueError(f"not a duration: {text!r}")
    micros = sum(int(n) * DURATION_UNITS[u] for n, u in parts)
    return F.make_dt_interval(secs=F.lit(Decimal(micros) / 1_000_000).cast("decimal(18,6)"))


def to_datetime(x: ColumnOr) -> Column:
    """ISO 8601 text as a timestamp; null where it isn't one."""
    return F.try_to_timestamp(_c(x))


def rand_uuid() -> Column:
    """A random UUID in each row."""
    return F.expr("uuid()")


def call(name: str, *arguments: object) -> Column:
    """A built-in function by its name; text arguments are columns, other values are literals."""
    return F.call_function(name, *[F.col(a) if isinstance(a, str) else value(a) for a in arguments])


# types
TYPES = {"string": "string", "int": "bigint", "float": "double", "bool": "boolean", "datetime": "timestamp", "duration": "interval day to second", "decimal": "decimal(38,18)", "number": "double"}


#: Spark's types, as patterns of their names, that hold each kind of values.
KINDS = {
    "string": r"string|(var)?char\(.*", "int": "tinyint|smallint|int|bigint", "float": "float|double", "bool": "boolean", "datetime": "timestamp|timestamp_ntz|date", "duration": "interval .*", "decimal": r"decimal\(.*",
    "number": r"tinyint|smallint|int|bigint|float|double|decimal\(.*", "object": "struct<.*|map<.*|variant", "array": "array<.*", "record": r"string|(var)?char\(.*|tinyint|smallint|int|bigint", "geometry": "binary", "any": ".*",
}


def cast(x: ColumnOr, to: str) -> Column:
    """Null where the value doesn't fit the type."""
    if to not in TYPES:
        raise ValueError(f"unknown type: {to}")
    return _c(x).try_cast(TYPES[to])


def type_is(x: ColumnOr, name: str) -> Column:
    """Whether the type of a column is one that holds the named kind of values (a constant that the analyser folds)."""
    if name not in KINDS:
        raise ValueError(f"unknown type: {name}")
    return F.typeof(_c(x)).rlike(f"^({KINDS[name]})$")


__all__ = ["TYPES", "array_contains", "array_length", "bound", "call", "cast", "count", "count_if", "duration", "field", "id_part", "is_email", "json_field", "math_abs", "math_ceil", "math_floor", "math_max", "math_mean", "math_min", "math_round", "math_sum", "rand_uuid", "record_id", "string_concat", "string_len", "string_lower", "string_slice", "string_upper", "time_floor", "time_format", "time_now", "to_datetime", "type_is", "value"]
