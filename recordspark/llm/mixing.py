"""Mixing sources to target weights by pivotal dependent rounding.

A source's target words come from weights and caps (`targets`).  Every document of the source expects
target / size-of-source copies: the integral part is given to each, and the fractional part is rounded
dependently.  Two documents with fractional probabilities meet; words are moved from one to the other,
one way or the other at random so that expectations stay, until one of the two probabilities is 0 or 1;
the other meets the next.  Since what is moved is measured in words, the words of a source come to its
target but for one document.

The rounding is a reduction tree.  Light rows (key, size, source; never texts) are dealt by a hash of the
document to buckets of about BUCKET documents; in each bucket all pairs but one residual a source are
settled.  Residuals meet in the next level, FAN buckets in one, until a source has a single residual, which
is rounded by its probability.  The number of levels is the logarithm of the number of documents, and no
task holds more than a bucket's rows, whatever the sizes of the sources.  Long documents meet first, so that
shorter ones can settle them and what remains at the end is small.  All chances are hashes of the
documents, so reruns agree whatever the partitions are.

Defined results: a null or empty text has size 0, and nothing is taken of it.  A null source is a source
of its own and the last in order.  Repeated rows are documents of their own (told apart by a number among
equals); rows with null doc_id too.  Further columns don't matter to `mix`; `apply_mix` keeps them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from recordspark.llm.common import cut, table

WEIGHTS, MOST = (5.0, 2.0, 1.0), 3.0
BUCKET, FAN = 1024, 256
EPSILON = 1e-9


def n_words(text: Column) -> Column:
    """The number of words: a word begins where no word character stands before."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^ \t\n\x0B\f\r]+")).cast("long")


def ranked(per: DataFrame) -> DataFrame:
    """`per` (source, ...) with `_rank`, the place of each source by code points, null last, from 0; sorted in ranges."""
    source = F.col("source").cast("binary").asc_nulls_last()
    ranges = per.repartitionByRange(source).withColumn("_p", F.spark_partition_id())
    within = cut(ranges.withColumn("_rank", F.row_number().over(Window.partitionBy("_p").orderBy(source)) - 1))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # over as many rows as there are ranges
    firsts = within.groupBy("_p").count().select("_p", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_first"))
    return within.join(F.broadcast(firsts), "_p").withColumn("_rank", F.col("_rank") + F.col("_first")).drop("_p", "_first")


def targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """source, source_size and target: one row a source, from `sized` (source, size).

    The targets are least(most * source_size, level * weight) for the level at which they sum to the whole.
    The level rises from that without caps, round by round, until no further source reaches its cap; only
    sums of sources come to the driver, so there may be many of them.
    """
    per = cut(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_docs")))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    rated = cut(ranked(per).withColumn("_w", weight).withColumn("_cap", most * F.col("source_size")))
    level, capped = 0.0, -1
    while True:
        full = F.lit(False) if capped < 0 else F.col("_cap") < F.lit(level) * F.col("_w")
        r = rated.agg(F.sum("source_size").alias("size"), F.sum(F.when(full, F.col("_cap"))).alias("taken"), F.sum(F.when(~full, F.col("_w"))).alias("w"), F.count_if(full).alias("n")).first()
        if r["n"] == capped:
            break
        capped = r["n"]
        level = ((r["size"] or 0) - (r["taken"] or 0.0)) / r["w"] if r["w"] else 0.0
    return rated.select("source", "source_size", "_docs", F.least("_cap", F.lit(level) * F.col("_w")).alias("target"))


def chance(a: int, b: int) -> float:
    """A number in [0, 1) from two document hashes."""
    x = (a * 0x9E3779B97F4A7C15 + b * 0xD6E8FEB86659FD93 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF
    for _ in range(2):
        x ^= x >> 32
        x = x * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF
    return ((x ^ (x >> 32)) >> 11) / (1 << 53)


def settle(hashes: list[int], sizes: list[int], probabilities: list[float]) -> tuple[list[float], int]:
    """Pair documents until at most one has a fractional probability; the probabilities and its index, or -1."""
    p = list(probabilities)
    held = -1
    for i in range(len(p)):
        if sizes[i] == 0 or p[i] <= EPSILON or p[i] >= 1 - EPSILON:
            p[i] = 0.0 if sizes[i] == 0 else float(round(p[i]))
            continue
        if held < 0:
            held = i
            continue
        a, b = p[held] * sizes[held], p[i] * sizes[i]
        up = min(sizes[held] - a, b)  # words that `held` can get from i
        down = min(a, sizes[i] - b)  # words that it can give
        moved = up if chance(hashes[held], hashes[i]) * (up + down) < down else -down
        p[held], p[i] = (a + moved) / sizes[held], (b - moved) / sizes[i]
        for j in (held, i):
            if p[j] <= EPSILON or p[j] >= 1 - EPSILON:
                p[j] = float(round(p[j]))
        left = [j for j in (held, i) if 0.0 < p[j] < 1.0]
        held = left[0] if left else -1
    return p, held


def _settle_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by source, group and document, of whole groups: the same with p settled, and the last residual rounded where a source has one group."""

    def done(rows: list[tuple]) -> pa.RecordBatch:
        p, held = settle([r[3] for r in rows], [r[5] for r in rows], [r[6] for r in rows])
        if held >= 0 and rows[0][2] == 1:
            p[held] = 1.0 if chance(rows[held][3], 1) < p[held] else 0.0
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(columns[i], pa.int64()) for i in range(6)] + [pa.array(p, pa.float64())], list(LEVEL))

    group: list[tuple] = []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if group and group[0][:2] != row[:2]:
                yield done(group)
                group = []
            group.append(row)
    if group:
        yield done(group)


#: Source, group, groups of the source, document (hash and number among equals), size, probability.
LEVEL = ("_s", "_group", "_groups", "_h", "_n", "size", "p")
LEVEL_SCHEMA = "_s long, _group long, _groups long, _h long, _n long, size long, p double"


def round_dependently(rows: DataFrame) -> DataFrame:
    """rows: _s, _docs (documents of the source), _h, _n, size and p.  Returns _s, _h, _n and the rounded p of every row."""
    rows = rows.withColumn("_groups", F.ceil(F.col("_docs") / BUCKET).cast("long"))
    most = rows.agg(F.max("_groups")).first()[0] or 1
    settled = []
    while True:
        dealt = rows.withColumn("_group", F.pmod(F.xxhash64("_h", "_n", "_groups"), F.col("_groups"))).select(*LEVEL)
        dealt = dealt.repartition("_s", "_group").sortWithinPartitions("_s", "_group", F.desc("size"), "_h", "_n")
        done = cut(dealt.mapInArrow(_settle_groups, LEVEL_SCHEMA))
        fractional = (F.col("p") > 0) & (F.col("p") < 1)
        settled.append(done.where(~fractional).select("_s", "_h", "_n", "p"))
        if most == 1:
            break
        most = math.ceil(most / FAN)
        rows = done.where(fractional).withColumn("_groups", F.ceil(F.col("_groups") / FAN).cast("long"))
    out = settled[0]
    for s in settled[1:]:
        out = out.unionByName(s)
    return out


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """doc_id, size, source_size, target, copies, taken and `_h`, `_n` of every row of `docs`."""
    sized = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64("doc_id", "source", "text").alias("_h"))
    return mix_sized(cut(sized), weights, most)


def mix_sized(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    per = targets(sized, weights, most).select(F.col("source").alias("_source"), "source_size", "_docs", "target")
    # equal rows get numbers; there are as many in a group as a row is repeated
    numbered = sized.groupBy("doc_id", "source", "size", "_h").count().select("doc_id", "source", "size", "_h", F.explode(F.sequence(F.lit(1), F.col("count"))).alias("_n"))
    rated = numbered.join(per, F.col("source").eqNullSafe(F.col("_source"))).drop("_source").withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    rated = rated.withColumn("_s", F.xxhash64("source"))
    rounded = round_dependently(rated.select("_s", "_docs", "_h", "_n", "size", (F.col("rate") - F.floor("rate")).alias("p")))
    rounded = rounded.select("_s", "_h", "_n", F.col("p").alias("_p"))
    out = rated.join(rounded, ["_s", "_h", "_n"]).withColumn("copies", F.when(F.col("size") > 0, F.floor("rate") + F.round("_p").cast("long")).otherwise(F.lit(0)).cast("long"))
    return out.select("doc_id", "size", "source_size", F.col("target").cast("double").alias("target"), (F.col("copies") * F.col("size")).alias("taken"), "copies", "_h", "_n")


def apply_mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """The mix itself: the rows of `docs`, each as often as the mix takes it, with all their columns.

    Rows that agree in doc_id, source and text are numbered in the order of their other columns.
    """
    names = docs.columns
    copies = cut(mix(docs, weights, most).select("_h", "_n", "copies"))
    per = copies.groupBy("_h").agg(F.count("*").alias("_m"), F.sum("copies").alias("_copies")).where("_copies > 0")
    row = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)])
    taken = docs.select(row.alias("_row"), F.xxhash64("doc_id", "source", "text").alias("_h")).join(per, "_h")
    out = taken.where("_m = 1").select("_row", F.col("_copies").alias("copies"))
    if not per.where("_m > 1").isEmpty():
        # equal rows become one with their number before they are put in order
        forms = taken.where("_m > 1").groupBy("_h", F.xxhash64(F.to_json("_row")).alias("_form")).agg(F.first("_row").alias("_row"), F.count("*").alias("_c"))
        last = F.sum("_c").over(Window.partitionBy("_h").orderBy("_form"))
        forms = forms.withColumn("_last", last).withColumn("_n", F.explode(F.sequence(F.col("_last") - F.col("_c") + 1, F.col("_last"))))
        out = out.unionByName(forms.join(copies.where("copies > 0"), ["_h", "_n"]).select("_row", "copies"))
    repeated = out.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return repeated.select(*[F.col(f"_row.c{i}").alias(c) for i, c in enumerate(names)])


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
