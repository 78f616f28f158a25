"""Results kept for a while: persisted DataFrames by the meaning of their plans."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, timedelta
from decimal import Decimal
from fnmatch import fnmatchcase
from functools import wraps
from typing import Any
from uuid import UUID

from pyspark.sql import DataFrame


def _told(x: Any, frames: list[DataFrame]) -> str:
    """Text that is equal for equal arguments.  A DataFrame is told by its plan, and added to `frames`."""
    if isinstance(x, DataFrame):
        frames.append(x)
        return f"plan {x.semanticHash()}"
    if x is None or isinstance(x, bool | int | float | str | bytes | Decimal | date | timedelta | UUID):
        return f"{type(x).__name__} {x!r}"
    if isinstance(x, list | tuple):
        return f"{type(x).__name__} [{', '.join(_told(v, frames) for v in x)}]"
    if isinstance(x, dict):
        return f"dict [{', '.join(f'{k!r}: {_told(v, frames)}' for k, v in sorted(x.items()))}]"
    raise TypeError(f"a cached function can't tell arguments of {type(x).__name__} apart")


def _call(f: Callable[..., Any], args: tuple, kw: dict[str, Any]) -> tuple[str, tuple[DataFrame, ...]]:
    frames: list[DataFrame] = []
    told = hashlib.sha256(_told([args, kw], frames).encode()).hexdigest()
    return f"{f.__module__}.{f.__qualname__}:{told[:16]}", tuple(frames)


def key_of(f: Callable[..., Any], *args: Any, **kw: Any) -> str:
    """The key of a call: the function's name, and a digest of its arguments."""
    return _call(f, args, kw)[0]


def is_cached(f: Callable[..., Any]) -> bool:
    return hasattr(f, "cache")


@dataclass
class Cache:
    """At most `size` results, each for `ttl` seconds; the oldest go first."""

    ttl: float = 300.0
    size: int = 1000
    clock: Callable[[], float] = time.monotonic
    hits: int = 0
    misses: int = 0
    #: End of life, table, result, and the DataFrames whose plans belong to the key.
    held: dict[str, tuple[float, str, DataFrame, tuple[DataFrame, ...]]] = field(default_factory=dict)

    def get_or_set(self, make: Callable[[], DataFrame], table: str = "", key: str | None = None, frames: tuple[DataFrame, ...] = ()) -> DataFrame:
        """The persisted result under the key, or of the same plan.

        frames: what the key tells by hashes of plans; on a hit the plans themselves are compared, and a result of
        others gives way.
        """
        df = None
        if key is None:
            df = make()
            key, frames = str(df.semanticHash()), (df,)
        found = self.held.get(key)
        if found and found[0] > self.clock() and len(found[3]) == len(frames) and all(a.sameSemantics(b) for a, b in zip(found[3], frames, strict=True)):
            self.hits += 1
            return found[2]
        self.misses += 1
        self._drop([key])
        while len(self.held) >= self.size:
            self._drop([next(iter(self.held))])
        kept = (make() if df is None else df).persist()
        self.held[key] = (self.clock() + self.ttl, table, kept, frames)
        return kept

    def invalidate(self, table: str | None = None, key: str | None = None, pattern: str | None = None) -> int:
        """Drop what was made of a table, or is under a key or under keys of a glob pattern, or everything; how many."""
        every = table is key is pattern is None
        return self._drop([k for k, v in self.held.items() if every or (table is not None and v[1] == table) or k == key or (pattern is not None and fnmatchcase(k, pattern))])

    def has(self, key: str) -> bool:
        return key in self.held and self.held[key][0] > self.clock()

    def stats(self) -> dict[str, float]:
        asked = self.hits + self.misses
        return {"hits": self.hits, "misses": self.misses, "size": len(self.held), "ratio": self.hits / asked if asked else 0.0}

    def cached(self, table: str = "") -> Callable[[Callable[..., DataFrame]], Callable[..., DataFrame]]:
        """A decorator: results of a function, by its name and arguments."""

        def wrap(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
            @wraps(f)
            def call(*args: Any, **kw: Any) -> DataFrame:
                key, frames = _call(f, args, kw)
                return self.get_or_set(lambda: f(*args, **kw), table, key, frames)

            call.cache = self  # type: ignore[attr-defined]
            return call

        return wrap

    def _drop(self, keys: list[str]) -> int:
        gone = [self.held.pop(k) for k in keys if k in self.held]
        for g in gone:
            g[2].unpersist()
        return len(gone)
