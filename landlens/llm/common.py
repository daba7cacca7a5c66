"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import package_on_workers, stage_table

#: White space of the contracts: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACES = r"[\x20\x09-\x0D]+"
#: A word between such white space.
NON_SPACES = r"[^\x20\x09-\x0D]+"
#: Code points that are ASCII but neither digits nor lower-case letters.
ASCII_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Rows of an Arrow batch where the session leaves Spark's default: whole texts are wide, and a batch is held on both sides.
BATCH, ROWS, DEFAULT_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "1000", "10000"


def on_workers(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it (installed, or a folder all can see), and keep
    Arrow batches of texts small."""
    if spark.conf.get(BATCH) == DEFAULT_ROWS:
        spark.conf.set(BATCH, ROWS)
    return package_on_workers(spark)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return on_workers(spark).read.parquet(f"{folder}/{name}.parquet")


def pin(df: DataFrame) -> DataFrame:
    """Cut the lineage with a table in the cluster's shared folder."""
    on_workers(df.sparkSession)
    return stage_table(df)


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """A-Z only; ``lower`` would also change other scripts."""
    return F.translate(c, _UPPER, _LOWER)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
