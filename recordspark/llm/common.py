"""What the operators of this subpackage share: tables, folds and shared storage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The separators of words, as a Java regular expression: space and 0x09-0x0D.
SPACE = r"[ \t\n\x0B\f\r]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str | Column, folds: int) -> Column:
    """crc32 of the key's text modulo `folds`; null where the key is null."""
    key = F.col(key) if isinstance(key, str) else key
    return (F.crc32(key.cast("string").cast("binary")) % folds).cast("int")


def held_out(key: str | Column, folds: int, held: int) -> Column:
    """Whether a row is held out; rows without a key are learned from by nobody, so they are."""
    return F.coalesce(fold(key, folds) == held, F.lit(True))


def share(*keys: str | Column) -> Column:
    """A number in [0, 1) that depends only on the keys."""
    return F.shiftrightunsigned(F.xxhash64(*keys, F.lit("share")), 11) / F.lit(float(1 << 53))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, where they become Python objects."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that the session names in spark.checkpoint.dir.

    Where none is named, a temporary one is made, for sessions that run on one machine only: executors on
    other machines wouldn't see it.
    """
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder:
            if not context.master.startswith("local[") and context.master != "local":
                raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            folder = f"file://{tempfile.mkdtemp(prefix='checkpoints-')}"
        context.setCheckpointDir(folder)
    return context._jsc.sc().getCheckpointDir().get()


def store(df: DataFrame) -> tuple[DataFrame, str]:
    """The same rows from a table of compressed columns in the shared folder, and the table's path."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame) -> DataFrame:
    """The same rows from a table in the shared folder."""
    return store(df)[0]


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table that `store` wrote, once nothing reads it any more."""
    if "/table-" not in path:
        raise ValueError(f"not a stored table: {path}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def cut(df: DataFrame) -> DataFrame:
    """The same rows from reliable storage, with no lineage behind them."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
