"""The folder that the driver and all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that the session names.  Without one, sessions on one machine get a temporary folder; others fail."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder and not re.match(r"local(\[|$)", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(folder or f"file://{tempfile.mkdtemp(prefix='checkpoints-')}")
    return context._jsc.sc().getCheckpointDir().get()


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder; nothing is made there yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """The same rows from the checkpoint folder, with no lineage behind them."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def dealt(df: DataFrame) -> DataFrame:
    """The same rows for a join that is dealt out by its key at any size: what is broadcast passes through the driver, at each level of a search."""
    return df.hint("merge")
