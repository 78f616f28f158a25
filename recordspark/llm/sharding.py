"""Contiguous shards of near equal bytes by global prefix sums.

Rows are put in one order by ranges (`repartitionByRange`), so each partition holds the rows between two
others.  A pass over each sorted partition gives every row the bytes and rows before it in its partition and
yields the partition's totals; prefix sums over the totals (one row a partition) make both global.  The
boundaries are equal shares of all bytes.  Each moves to the nearest end of the row that it falls in, or, where
the rows of one group are adjacent and take no more than `SLACK` of a shard, to the nearest end of that group.
Only the rows at the boundaries, one a shard, come to the driver.

The order of the query is by a hash of the text, then doc_id: copies of a text are adjacent, so they stay in
one shard unless they are many, and each shard is an even sample of the documents.  A group of any size is
split between ranges and shards, since the order goes on within it; rows repeated entirely are told apart by
a number that is fixed before they are dealt.

Defined results: a null or empty text has a size of 1, as the separator counts.  Null keys come first in the
order.  Rows that are equal in the whole order are put in any order.  With fewer rows than shards, or rows
larger than a shard's share, some shards are empty.  An empty table gives no rows.  Further columns are kept
by `place` and `write_shards`, whatever their names are (but for `size`, `shard` and `slot`, which `place` sets).
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from recordspark.llm.common import cut, stored, table

SHARDS = 8
#: Rows of a range, about.
RANGE = 1 << 18
#: The largest group, as a part of a shard's bytes, that a boundary goes around.
SLACK = 1 / 64


@dataclass(frozen=True)
class Cut:
    """The first row of a shard: the bytes and the rows before it."""

    byte: int
    row: int


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a sorted partition with its number, and the bytes and rows before each in it."""
    partition, bytes_before, rows_before = TaskContext.get().partitionId(), 0, 0
    for b in batches:
        size = b.column(b.schema.get_field_index("s")).to_numpy(zero_copy_only=False)
        ends = bytes_before + np.cumsum(size)
        columns = [pa.array(np.full(len(size), partition, dtype=np.int64)), pa.array(ends - size), pa.array(np.arange(rows_before, rows_before + len(size)))]
        yield pa.RecordBatch.from_arrays([*b.columns, *columns], [*b.schema.names, "p", "b", "r"])
        rows_before += len(size)
        bytes_before = int(ends[-1]) if len(size) else bytes_before


def prefix_sums(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """`rows` (with a column s, the size) in the given order, with b and r: bytes and rows before each in the whole order.

    `order` should tell all rows apart, so that no range is larger than others.
    """
    ranges = max(1, -(-rows.count() // RANGE))
    by = [F.col(c).asc_nulls_first() for c in order]
    schema = StructType([*rows.schema, *[StructField(c, LongType()) for c in ("p", "b", "r")]])
    local = cut(rows.repartitionByRange(ranges, *by).sortWithinPartitions(*by).mapInArrow(_running, schema))
    totals = sorted(local.groupBy("p").agg(F.max_by(F.col("b") + F.col("s"), "r").alias("b"), (F.max("r") + 1).alias("r")).collect())  # one row a range
    before, firsts = Cut(0, 0), []
    for t in totals:
        firsts.append((t["p"], before.byte, before.row))
        before = Cut(before.byte + t["b"], before.row + t["r"])
    offsets = F.broadcast(rows.sparkSession.createDataFrame(firsts, "p long, _b long, _r long"))
    return local.join(offsets, "p").withColumns({"b": F.col("b") + F.col("_b"), "r": F.col("r") + F.col("_r")}).drop("p", "_b", "_r")


def cuts(placed: DataFrame, shards: int, group: Sequence[str] = ()) -> list[Cut]:
    """Where each shard but the first begins; `group` names the columns that tell groups of adjacent rows apart."""
    total = placed.agg(F.sum("s")).first()[0] or 0
    targets = [total * k // shards for k in range(1, shards)]
    if not total or not targets:
        return []
    below = lambda x: f"least({shards - 1}, greatest(0, (({x}) * {shards} + {total - 1}L) div {total}L - 1))"  # noqa: E731  how many of the targets are smaller
    edges = placed.where(f"{below('b + s')} > {below('b')}").select("b", "s", "r", *group).orderBy("b").collect()
    ends = {e["b"]: (Cut(e["b"], e["r"]), Cut(e["b"] + e["s"], e["r"] + 1)) for e in edges}
    if group:
        keys = placed.sparkSession.createDataFrame([tuple(e[c] for c in group) for e in edges], placed.select(*group).schema).distinct()
        same = placed.join(F.broadcast(keys), on=[placed[c].eqNullSafe(keys[c]) for c in group], how="left_semi")
        found = same.groupBy(*group).agg(F.min("b").alias("b"), F.min("r").alias("r"), F.max(F.col("b") + F.col("s")).alias("e"), F.max("r").alias("l")).collect()
        extent = {tuple(f[c] for c in group): f for f in found if f["e"] - f["b"] <= SLACK * total / shards}
        for e in edges:
            if f := extent.get(tuple(e[c] for c in group)):
                ends[e["b"]] = Cut(f["b"], f["r"]), Cut(f["e"], f["l"] + 1)
    out, starts = [], [e["b"] for e in edges]
    for t in targets:
        low, high = ends[starts[bisect.bisect_right(starts, t) - 1]]
        out.append(low if t - low.byte <= high.byte - t else high)
    return out


def _dealt(found: list[Cut]):
    """A function of sorted batches that adds shard and slot."""
    starts, rows = np.array([c.byte for c in found], dtype=np.int64), np.array([0, *(c.row for c in found)], dtype=np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shard = np.searchsorted(starts, b.column(b.schema.get_field_index("b")).to_numpy(), side="right")
            slot = b.column(b.schema.get_field_index("r")).to_numpy() - rows[shard]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shard.astype(np.int32)), pa.array(slot)], [*b.schema.names, "shard", "slot"])

    return deal


def place(rows: DataFrame, order: Sequence[str | Column], shards: int = SHARDS, group: int = 0) -> DataFrame:
    """The rows (with a column `size`) with shard and slot, the place in the shard.

    order: columns that tell rows apart as far as possible; the first `group` of them tell groups apart, which
    are kept together where they are small.  All columns of the rows pass one shuffle.
    """
    carried = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(rows.columns)])
    keys = [f"k{i}" for i in range(len(order))]
    light = rows.select(carried.alias("row"), F.col("size").alias("s"), *[(F.col(o) if isinstance(o, str) else o).alias(k) for o, k in zip(order, keys, strict=True)], F.monotonically_increasing_id().alias("i"))
    placed = prefix_sums(stored(light), [*keys, "i"])
    found = cuts(placed, shards, keys[:group])
    thin = placed.select("row", "b", "r")
    out = thin.mapInArrow(_dealt(found), StructType([*thin.schema, StructField("shard", IntegerType()), StructField("slot", LongType())]))
    return out.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(rows.columns)], "shard", "slot")


def text_facts(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and text_hash of every document."""
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select("doc_id", (F.octet_length(data) + 1).cast("long").alias("size"), F.crc32(data).alias("text_crc32"), F.xxhash64("text").alias("text_hash"))


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every document; equal texts are a group."""
    return place(text_facts(docs), ["text_hash", "size", "text_crc32", "doc_id"], shards, group=3).drop("text_hash")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """The documents with all their columns as Parquet, a folder `shard=k` for each shard, rows in the order of slots within a file."""
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    row = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)])
    sized = docs.select(row.alias("row"), (F.octet_length(data) + 1).cast("long").alias("size"), F.xxhash64("text").alias("h"), F.crc32(data).alias("crc"), F.col("doc_id").alias("id"))
    placed = place(sized, ["h", "size", "crc", "id"], shards, group=3)
    clash = sorted({"shard", "slot"} & {c.lower() for c in docs.columns})
    if clash:
        raise ValueError(f"columns that the folders of shards need: {', '.join(clash)}")
    out = placed.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)], "shard", "slot")
    out.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)  # the rows are in ranges of the order already


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_documents(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
