"""Quality rules whose thresholds control the risk of rejecting good documents.

Base rules are fixed.  Each further rule is a ratio of a document and rejects values beyond a cutoff.
Cutoffs come from labelled documents, for each stratum (a band of lengths).  The rules' cutoffs are
tightened together, along a path of GRID steps from the mildest to the strictest, and the whole set of
documents that a step rejects is tested: the step holds while the exact binomial test says that it rejects
fewer than `risk` of good documents.  Tests in a fixed order up to the first failure need no correction
among themselves; for the strata the level is divided by their number (Bonferroni).  So with probability
1 - `level`, no stratum loses more than `risk` of its good documents at any step that holds.  Among these
steps the one is taken that parts the labels best (share of bad ones rejected less share of good ones; of
equal ones the mildest).  A test can't hold with too few labels: such strata are merged with the next
shorter one, by the numbers of their good labels alone.  If all are too few, or no step that holds rejects
a larger share of bad labels than of good ones, the rules stay off.

Everything is DataFrame expressions.  The features of a document are computed once, in its own row, so no
text is ever shuffled; labels meet a few numbers a document; the table of cutoffs has one row for each
of the STRATA and is the only thing broadcast.

Defined results: a null or empty text has no words, zeros everywhere and fails the base rules.  Rows
without doc_id are judged like the others; they have no label.  Repeated rows are judged one by one.
A doc_id with several labels counts as good only if all of them say so.  Without labels only the base
rules reject.  Further columns of the input, whatever their names, don't matter to `judge`; `keep`
returns them unchanged.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from recordspark.llm.common import SPACE, cut, stored, table

#: Upper ends (in words) of the strata; the last one is open.
BANDS = (100, 200, 500, 2000)
STRATA = len(BANDS) + 1
#: Rules: the ratio's largest value on the grid; a rule rejects ratios above its cutoff, or below it where `low`.
RULES = {"symbols": (0.5, False), "dup_lines": (1.0, False), "repeats": (0.5, False), "short_words": (6.0, True), "long_words": (24.0, False)}
GRID = 40
RISK, LEVEL = 0.02, 0.05
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (*(f"_{c}" for c in COUNTS), "_n_lines")


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with the further columns FEATURES, counts of each text.

    Every step is a column of its own: Spark keeps such steps apart where a later one uses them twice.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    step = docs.withColumns({"_words": F.array_remove(F.split(t, SPACE), ""), "_lines": F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^ \t\n\x0B\f\r]")), "_n_symbols": F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long")})
    words = F.col("_words")
    n = F.size(words)
    grams = F.when(n >= 3, F.transform(F.slice(words, 1, F.greatest(n - 2, F.lit(1))), lambda w, i: F.xxhash64(w, words[i + 1], words[i + 2]))).otherwise(F.array().cast("array<bigint>"))
    step = step.withColumn("_grams", grams)
    step = step.withColumn("_sorted", F.when(F.size(F.array_distinct("_grams")) < F.size("_grams"), F.sort_array(F.transform("_grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))))
    s = F.col("_sorted")
    twice = F.filter(s, lambda x, i: (x["g"] == F.get(s, i - 1)["g"]) | (x["g"] == F.get(s, i + 1)["g"]))
    step = step.withColumn("_starts", F.sort_array(F.transform(twice, lambda x: x["i"])))
    at = F.col("_starts")
    covered = F.aggregate(F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - p, F.lit(3)))), F.lit(0), lambda a, x: a + x)
    step = step.withColumns({
        "_n_words": n.cast("long"),
        "_word_chars": F.length(F.array_join(words, "")).cast("long"),
        "_n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
        "_n_lines": F.size("_lines").cast("long"),
    })
    return step.select(*docs.columns, *FEATURES)


def failed() -> Column:
    """The base rules: fewer than 50 words, or more than half of the words in repeated windows."""
    n = F.col("_n_words")
    return (n < 50) | (100 * F.col("_n_repeat_words") > 50 * n)


def stratum() -> Column:
    n = F.col("_n_words")
    return reduce(lambda rest, b: F.when(n < BANDS[b], b).otherwise(rest), reversed(range(len(BANDS))), F.lit(len(BANDS)))


def ratios() -> dict[str, Column]:
    at = lambda name: F.col(f"_{name}").cast("double")
    words, lines = F.greatest(at("n_words"), F.lit(1.0)), F.greatest(at("n_lines"), F.lit(1.0))
    mean = at("word_chars") / words
    return {"symbols": at("n_symbols") / words, "dup_lines": at("n_dup_lines") / lines, "repeats": at("n_repeat_words") / words, "short_words": mean, "long_words": mean}


def strictness(name: str, ratio: Column) -> Column:
    """How mild a cutoff may be and still reject the ratio: step 1 rejects only extreme values, step GRID the most."""
    top, low = RULES[name]
    scaled = ratio / F.lit(top)
    step = F.floor(scaled * GRID) + 1 if low else GRID + 1 - F.floor(scaled * GRID)
    return F.least(F.greatest(step, F.lit(1)), F.lit(GRID + 1)).cast("int")


def joint() -> Column:
    """The first step at which any of the rules rejects a document."""
    return F.least(*[strictness(k, r) for k, r in ratios().items()])


def log_gamma(x: Column) -> Column:
    """ln of the gamma function for x >= 1, by Stirling's series from x + 8 on."""
    z = x + 8.0
    shift = reduce(lambda a, i: a * (x + float(i)), range(1, 8), x)
    return (z - 0.5) * F.log(z) - z + 0.9189385332046727 + 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * F.pow(z, F.lit(5.0))) - F.log(shift)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(a binomial count of n trials at p is at most k), summed from k down; terms below 1e-16 of the sum are left out."""
    k, n = k.cast("double"), n.cast("double")
    first = log_gamma(n + 1) - log_gamma(k + 1) - log_gamma(n - k + 1) + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p))
    steps = F.sequence(F.lit(1), F.greatest(F.least(k, F.lit(60.0) + 12 * F.sqrt(k)), F.lit(1.0)).cast("int"))
    # the term of j - 1 is that of j times j / (n - j + 1) * (1 - p) / p
    down = F.aggregate(
        steps,
        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total")),
        lambda a, i: F.struct((a["term"] * F.greatest(k - i + 1, F.lit(0.0)) / (n - k + i) * ((1 - p) / p)).alias("term"), (a["total"] + a["term"] * F.greatest(k - i + 1, F.lit(0.0)) / (n - k + i) * ((1 - p) / p)).alias("total")),
    )
    return F.exp(first + F.log(down["total"]))


def merged(grid: DataFrame, least: int) -> DataFrame:
    """stratum and group: strata from the longest down, each group with at least `least` good labels if there are as many."""
    per = grid.groupBy("stratum").agg(F.sum("good").alias("n"))
    one = per.agg(F.reverse(F.sort_array(F.collect_list(F.struct("stratum", "n")))).alias("x"))  # STRATA items
    start = F.struct(F.array().cast("array<int>").alias("groups"), F.lit(0).alias("g"), F.lit(0).cast("long").alias("s"))

    def step(acc: Column, x: Column) -> Column:
        full = acc["s"] >= least
        g = acc["g"] + full.cast("int")
        return F.struct(F.concat(acc["groups"], F.array(g)).alias("groups"), g.alias("g"), F.when(full, x["n"]).otherwise(acc["s"] + x["n"]).alias("s"))

    def finish(acc: Column) -> Column:
        # what is left at the end joins the group before
        return F.transform(acc["groups"], lambda g: F.least(g, F.when((acc["s"] < least) & (acc["g"] > 0), acc["g"] - 1).otherwise(acc["g"])))

    return one.select(F.explode(F.arrays_zip(F.col("x.stratum").alias("stratum"), F.aggregate("x", start, step, finish).alias("group"))).alias("y")).select("y.*")


def thresholds(counted: DataFrame, labels: DataFrame, risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """One row for each stratum: `stratum`, `_cut` (the step of its cutoffs; 0: off), and good, bad, good_rejected and bad_rejected labels of its group.

    counted: doc_id and FEATURES of every document; labels: doc_id and quality.
    """
    quality = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    rows = counted.where(~failed()).select("doc_id", stratum().alias("stratum"), joint().alias("step")).join(quality, "doc_id")
    of = lambda q: F.count_if(F.col("quality") == q)
    seen = rows.groupBy("stratum", "step").agg(of(1).alias("good"), of(0).alias("bad"))
    every = counted.sparkSession.range(STRATA).select(F.col("id").cast("int").alias("stratum"), F.explode(F.sequence(F.lit(1), F.lit(GRID + 1))).alias("step"))
    grid = every.join(F.broadcast(seen), ["stratum", "step"], "left").select("stratum", "step", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "bad")])
    grid = cut(grid)  # STRATA * (GRID + 1) rows
    # fewer can't pass the test, even if no good one is rejected
    groups = cut(merged(grid, math.ceil(math.log(level / STRATA) / math.log1p(-risk))))
    upto = Window.partitionBy("group").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("group")
    tests = grid.join(F.broadcast(groups), "stratum").groupBy("group", "step").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    tests = tests.select("group", "step", *[F.sum(c).over(w).alias(n) for c, w, n in (("good", upto, "k"), ("good", whole, "n"), ("bad", upto, "b"), ("bad", whole, "m"))])
    passed = (F.col("n") > 0) & (F.col("k") < risk * F.col("n")) & (binomial_tail(F.col("k"), F.col("n"), risk) <= level / STRATA)
    gain = F.col("b") / F.greatest("m", F.lit(1)) - F.col("k") / F.greatest("n", F.lit(1))
    tests = tests.where(F.col("step") <= GRID).withColumn("held", F.min(passed.cast("int")).over(upto) == 1).withColumn("gain", gain)
    best = F.max(F.when(F.col("held") & (F.col("gain") > 0), F.struct("gain", (-F.col("step")).alias("step"), "k", "b")))
    chosen = tests.groupBy("group").agg(best.alias("x"), F.max("n").alias("good"), F.max("m").alias("bad"))
    chosen = chosen.select("group", F.coalesce(-F.col("x.step"), F.lit(0)).alias("_cut"), "good", "bad", F.coalesce("x.k", F.lit(0)).alias("good_rejected"), F.coalesce("x.b", F.lit(0)).alias("bad_rejected"))
    return groups.join(F.broadcast(chosen), "group").drop("group")


def with_verdict(counted: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """`counted` with the columns `_failed` and `_kept`.  cutoffs has STRATA rows, so it is broadcast."""
    cutoffs = cutoffs.select(F.col("stratum").alias("_stratum"), "_cut")
    joined = counted.withColumn("_stratum", stratum()).join(F.broadcast(cutoffs), "_stratum", "left")
    return joined.withColumn("_failed", failed()).withColumn("_kept", ~F.col("_failed") & (joint() > F.coalesce("_cut", F.lit(0))))


def judge(docs: DataFrame, labels: DataFrame, risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """doc_id, the five counts, base_failed and kept of every row of `docs`; texts are read once."""
    counted = cut(features(docs.select("doc_id", "text")).select("doc_id", *FEATURES))
    verdict = with_verdict(counted, thresholds(counted, labels, risk, level))
    return verdict.select("doc_id", *[F.col(f"_{c}").alias(c) for c in COUNTS], F.col("_failed").alias("base_failed"), F.col("_kept").alias("kept"))


def keep(docs: DataFrame, labels: DataFrame, risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """The rows of `docs` that the rules keep, with all their columns.

    Rows are written with their features to the shared folder, so that the features are computed once.
    """
    names = docs.columns
    row = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)]).alias("_row")
    counted = stored(features(docs.select("doc_id", "text", row)).drop("text"))
    kept = with_verdict(counted, thresholds(counted.drop("_row"), labels, risk, level)).where("_kept")
    return kept.select(*[F.col(f"_row.c{i}").alias(c) for i, c in enumerate(names)])


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
