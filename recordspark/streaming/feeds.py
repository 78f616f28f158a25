"""Change feeds: new records of a growing source, and the changes between two snapshots."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from recordspark.operators.mutate import diff
from recordspark.streaming.patches import changes


def stream(spark: SparkSession, path: str, schema: str | None = None, files_per_batch: int = 100) -> DataFrame:
    """A folder of Parquet files as a stream; timestamps without a zone become timestamps, as watermarks need."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    df = reader.schema(schema or spark.read.parquet(path).schema).parquet(path)
    return df.withColumns({c: F.col(c).cast("timestamp") for c, k in df.dtypes if k == "timestamp_ntz"})


def created(rows: DataFrame, key: str, time: str, late: str = "1 hour") -> DataFrame:
    """A CREATE for each key the first time that it comes.

    What is remembered of a key goes when the watermark has passed its time, so the state stays bounded;
    a key that comes again later than that is new.
    """
    once = rows.withWatermark(time, late).dropDuplicatesWithinWatermark([key])
    return once.select(F.lit("CREATE").alias("action"), F.struct(*rows.columns).alias("result"))


#: What the state store of `transformWithState` needs.
_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
_TOLD = "key string, action string, result string, before string"


class _Versions(StatefulProcessor):
    """The last version of a record: its order, its mark, and itself, until `keep` milliseconds after it.

    waits: whether versions wait for the watermark to pass them, so that they come in order.
    """

    def __init__(self, order: str, waits: bool, keep: int | None):
        self.order, self.waits, self.keep = order, waits, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        form = f"o {self.order}, mark long, gone boolean, result string"
        self.last = handle.getValueState("last", form)
        self.pending = handle.getListState("pending", form)

    def _told(self, key: tuple, versions: list[tuple]) -> Iterator[Row]:
        last = self.last.get() if self.last.exists() else None
        last = tuple(last) if last is not None else None
        for v in sorted(versions, key=lambda v: (v[0], not v[2], v[1])):
            there = last is not None and not last[2]
            if last is not None and v[0] < last[0]:
                continue  # older than what is known
            action = ("DELETE" if there else None) if v[2] else "CREATE" if not there else "UPDATE" if v[1] != last[1] else None
            if action and not (v[2] and v[3] is None):
                yield Row(key=key[0], action=action, result=last[3] if v[2] else v[3], before=last[3] if there else None)
            last = v
        if last is not None:
            self.last.update(last)

    def _until(self, order: Any) -> int:
        return math.ceil(order.timestamp() * 1000)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        new = [(r["order"], r["mark"], r["gone"], r["result"]) for r in rows if r["order"] is not None]
        if not self.waits:
            yield from self._told(key, new)
            if self.keep is not None and new:
                for t in list(self.handle.listTimers()):
                    self.handle.deleteTimer(t)
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.keep)
            return
        if new:  # one timer for the earliest; those behind it get theirs when it has expired
            self.pending.appendList(new)
            self.handle.registerTimer(min(self._until(v[0]) for v in new))

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        if not self.waits:
            self.last.clear()
            return
        now = timerValues.getCurrentWatermarkInMs()
        waiting = [tuple(v) for v in self.pending.get()] if self.pending.exists() else []
        due, rest = [v for v in waiting if self._until(v[0]) <= now], [v for v in waiting if self._until(v[0]) > now]
        if rest:
            self.pending.put(rest)
            self.handle.registerTimer(min(self._until(v[0]) for v in rest))
        else:
            self.pending.clear()
        yield from self._told(key, due)
        last = self.last.get() if self.last.exists() else None
        if self.keep is not None and last is not None:
            end = self._until(last[0]) + self.keep
            if end <= now and not rest:
                self.last.clear()
            else:
                self.handle.registerTimer(max(end, now + 1))

    def close(self) -> None:
        pass


def notifications(rows: DataFrame, key: str, order: str, deleted: str, late: str | None = None, keep: float | None = None, quiet: str | None = None) -> DataFrame:
    """key, action (CREATE, UPDATE, DELETE), result and before (JSON) for the versions of records in a stream.

    A version replaces those before it in the order of the column `order`; where the column `deleted` is true, the
    record goes, and the result is what it was.  A version that changes nothing gives nothing.  The last version of each
    record, or that it went, is kept in state, so a version that comes late, in whatever batch, is left out.

    late: `order` is a timestamp, and versions wait until the watermark has passed them by so much; so they are told
    in their order even if batches come shuffled, but for those that come later still.  keep: seconds after which the
    state of a record goes (since it came, or with `late` in the time of `order`); a version after that is a new record.
    quiet: a column that is true where a record goes and nothing is told of it; what comes next is new.
    The session's streams get the RocksDB state store, which this needs.
    Of versions of one order a deletion is the last but for what is written again.  Versions without an order are left out.
    """
    fields = [c for c in rows.columns if c not in (order, deleted, quiet)]
    rows.sparkSession.conf.set(*_STORE)
    if late is not None:
        rows = rows.withWatermark(order, late)
    hushed = F.lit(False) if quiet is None else F.coalesce(F.col(quiet), F.lit(False))
    result = F.when(~hushed, F.to_json(F.struct(*fields)))  # none: the record goes without a word
    versions = rows.select(F.col(key).cast("string").alias("key"), F.col(order).alias("order"), (F.coalesce(F.col(deleted), F.lit(False)) | hushed).alias("gone"), F.xxhash64(result).alias("mark"), result.alias("result"))
    held = _Versions(rows.schema[order].dataType.simpleString(), late is not None, None if keep is None else math.ceil(keep * 1000))
    mode = "EventTime" if late is not None else "None" if keep is None else "ProcessingTime"
    return versions.groupBy("key").transformWithState(held, _TOLD, "Append", mode)


def with_patches(told: DataFrame, form: T.StructType) -> DataFrame:
    """Notifications with `patch`, what leads from the version before to the new one (none for CREATE and DELETE); form: the type of the records."""
    old, new = F.from_json("before", form), F.from_json("result", form)
    true = F.lit(True)
    return told.withColumn("patch", F.when(F.col("action") == "UPDATE", changes(old, new, form, F.lit(""), true, true)))


def on_event(changes: DataFrame, actions: Sequence[str], then: Callable[[DataFrame, int], None], checkpoint: str, when: Column | None = None, once: bool = False) -> StreamingQuery:
    """An event trigger: hand the notifications of some actions, for which a condition holds, to a callback."""
    if unknown := set(actions) - {"CREATE", "UPDATE", "DELETE"}:
        raise ValueError(f"not an action: {', '.join(sorted(unknown))}")
    wanted = F.col("action").isin(list(actions))
    return live(changes, then, checkpoint, wanted if when is None else wanted & when, once)


def active(spark: SparkSession) -> list[StreamingQuery]:
    """The live queries of the session."""
    return list(spark.streams.active)


def kill(spark: SparkSession, query_id: str) -> bool:
    """Stop a live query; whether there was one of that id."""
    found = [q for q in spark.streams.active if str(q.id) == query_id]
    for q in found:
        q.stop()
    return bool(found)


def live(rows: DataFrame, on_batch: Callable[[DataFrame, int], None], checkpoint: str, condition: Column | None = None, once: bool = False) -> StreamingQuery:
    """Hand every batch of the rows that a condition holds for to a callback.  once: what is there now, then stop."""
    kept = rows if condition is None else rows.where(condition)
    writer = kept.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def windowed_counts(rows: DataFrame, time: str, by: str, size: str, late: str) -> DataFrame:
    """Counts of each value in windows of time, for batches and streams."""
    held = rows.withWatermark(time, late) if rows.isStreaming else rows
    return held.groupBy(F.window(time, size).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), by, "n")


def snapshot_changes(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """key and action (CREATE, UPDATE, DELETE) of every record that differs between two snapshots.

    Rows are compared by a hash of their other fields, counted for each key.  Rows without a key are nobody's record
    and take no part.  Of rows that share a key, equal ones stand for each other and the others are updates, one by one.
    """
    names = sorted({*before.columns, *after.columns} - {key})
    # JSON leaves nulls out, so a field that only one of the two has is null in the other
    mark = lambda df, n: df.where(F.col(key).isNotNull()).select(F.col(key), F.xxhash64(F.to_json(F.struct(*[F.col(c) for c in names if c in df.columns] or [F.lit(0)]))).alias("_mark"), F.lit(n).cast("long").alias("_n"))
    marks = mark(before, 1).union(mark(after, -1)).repartition(F.col(key)).groupBy(key, "_mark").agg(F.sum("_n").alias("_n"))
    left = marks.groupBy(key).agg(F.sum(F.greatest("_n", F.lit(0))).alias("_old"), F.sum(F.greatest(-F.col("_n"), F.lit(0))).alias("_new"))
    times = lambda action, n: F.array_repeat(F.lit(action), n.cast("int"))
    both = F.least("_old", "_new")
    actions = F.concat(times("UPDATE", both), times("CREATE", F.col("_new") - both), times("DELETE", F.col("_old") - both))
    return left.where("_old > 0 or _new > 0").select(key, F.explode(actions).alias("action"))


def patches(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """The changed fields of records in both snapshots, as arrays of (op, path, value)."""
    return diff(before, after.join(before.select(key), key, "left_semi"), key)
