"""Record ids, `table:id` as text."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

_TABLE = re.compile(r"[A-Za-z0-9_]+")
_PLAIN = re.compile(r"[A-Za-z0-9_]+")


@dataclass(frozen=True)
class RecordId:
    """A table and a key.  Text keys that aren't plain words are written in angle brackets."""

    table: str
    id: str | int

    def __post_init__(self) -> None:
        if not _TABLE.fullmatch(self.table):
            raise ValueError(f"not a table name: {self.table!r}")
        if self.id == "":
            raise ValueError("empty record id")

    def __str__(self) -> str:
        key = str(self.id)
        return f"{self.table}:{key}" if isinstance(self.id, int) or _PLAIN.fullmatch(key) else f"{self.table}:<{key}>"

    @classmethod
    def parse(cls, text: str) -> RecordId:
        table, colon, key = text.partition(":")
        if not colon or not key:
            raise ValueError(f"not a record id: {text!r}")
        if key[0] in "<⟨" and key[-1] in ">⟩":
            return cls(table, key[1:-1])
        return cls(table, int(key) if re.fullmatch(r"-?\d+", key) else key)


def record_id(table: str, key: Column | str) -> Column:
    """The text form of the ids of a key column, as `RecordId` writes them."""
    key = F.col(key) if isinstance(key, str) else key
    text = key.cast("string")
    quoted = (F.typeof(key) == "string") & ~text.rlike(f"^{_PLAIN.pattern}$")
    return F.concat(F.lit(f"{table}:"), F.when(quoted, F.concat(F.lit("<"), text, F.lit(">"))).otherwise(text))


def id_part(ref: Column | str) -> Column:
    """The key of a record id in its text form: what follows the first colon, without brackets around it."""
    key = F.regexp_replace(F.col(ref) if isinstance(ref, str) else ref, r"(?s)^[^:]*:", "")
    return F.regexp_replace(key, r"(?s)^[<⟨](.*)[>⟩]$", "$1")
