"""Keyed tables in key-hash buckets: a batch rewrites only the buckets of its keys.

A table is a folder of Parquet partitions, one for each bucket of the key's hash. An upsert or a replacement by keys reads the touched buckets,
merges, and overwrites exactly those partitions (dynamic partition overwrite), so its cost follows the batch and not the table. The
merged rows are written to the shared folder first: nothing is overwritten while it is read, and a job that is tried again writes the same rows to
the same partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import state as S
from ..session import stage_table

BUCKET = "_bucket"


class BucketedTable:
    """The number of buckets belongs to the table's path, so it cannot be opened with another."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = 64):
        self.spark, self.key, self.buckets, self.path = spark, key, buckets, f"{path.rstrip('/')}/by-{key}-{buckets}"

    def bucket(self) -> F.Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame) -> None:
        (rows.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.path))

    def create(self, rows: DataFrame) -> None:
        rows.withColumn(BUCKET, self.bucket()).repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path).drop(BUCKET)

    def touched(self, keys: DataFrame) -> list[int]:
        """Buckets of the keys: at most as many as the table has."""
        return sorted(r[0] for r in keys.select(self.bucket().alias("b")).distinct().collect())

    def _merge(self, keys: DataFrame, merge) -> list[int]:
        buckets = self.touched(keys)
        if buckets:
            rows = self.spark.read.parquet(self.path)
            merged = stage_table(merge(rows.where(F.col(BUCKET).isin(buckets)).drop(BUCKET)).withColumn(BUCKET, self.bucket()))
            # a bucket whose last row goes has nothing to overwrite it with: its partition would stay
            left = {r[0] for r in merged.select(BUCKET).distinct().collect()}
            self._write(merged)
            for b in set(buckets) - left:
                self._clear(b)
        return buckets

    def _clear(self, bucket: int) -> None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{BUCKET}={bucket}")
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

    def upsert(self, batch: DataFrame, update: Sequence[str]) -> list[int]:
        """INSERT ... ON CONFLICT(key) DO UPDATE; a key given twice fails inside the job, before anything is overwritten. Returns the rewritten buckets.

        A repeated call changes nothing for rows with a key; rows without one are inserted by every call, as in the source."""
        batch = batch if set(batch.columns) <= set(self.read().columns) else batch.select(*[c for c in batch.columns if c in self.read().columns])
        return self._merge(batch, lambda old: S.upsert(old, batch, self.key, update, check="plan").select(*old.columns))

    def replace_keys(self, rows: DataFrame, keys: DataFrame) -> list[int]:
        """DELETE WHERE key = ANY(keys), INSERT the rows of those keys. Returns the rewritten buckets."""
        return self._merge(keys, lambda old: S.replace_keys(old, rows.select(*old.columns), keys, self.key))
