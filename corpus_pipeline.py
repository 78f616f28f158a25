"""A corpus pipeline: quality rules, near-duplicate removal, secret redaction, mixing, tokenisation.

Every stage takes (spark, docs, sf_dir) and works on all documents that the stage before kept.  All but the
last return the columns of their input, whatever further columns there are.  `run` writes the output of each
stage but the last to the shared folder as Parquet, and the next stage reads it from there; a table that was
read to the end is deleted.

Defined results: null and empty texts fail the base rules of the first stage, so they are gone behind it.
Rows with a null doc_id are judged and redacted like others; they are nobody's near-duplicates, and are mixed
by their source.  Of rows repeated entirely one stays.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recordspark.llm import jaccard_join, mixing, quality_rules, secret_scan, segmentation
from recordspark.llm.common import discard, store, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; the labels of the tables set the cutoffs."""
    return quality_rules.keep(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that the n-gram Jaccard join links, the one with the smallest doc_id stays; no other document goes."""
    return jaccard_join.one_row_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mask; every document stays."""
    return secret_scan.redact(docs, secret_scan.train(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mixing.apply_mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations: doc_id, sample, ids, log_prob, log_inclusion and round_trip."""
    return segmentation.sample(docs, segmentation.Vocabulary.load())


STAGES = [("quality_rules", quality), ("jaccard_join", near_duplicates), ("secret_scan", secrets), ("mixing", mixture), ("segmentation", tokens)]
#: Sampled mixtures and segmentations are not SQL; tests/llm/test_pipeline.py holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    *first, (_, last) = STAGES
    for _, stage in first:
        docs, path = store(stage(spark, docs, sf_dir))
        if before:
            discard(spark, before)  # the next stage's table is whole by now
        before = path
    return last(spark, docs, sf_dir)
