"""Parcel change detection: content hash, latest snapshot, change rows.

Parcels without an egrid are left out of snapshots and change rows (the
source keys snapshots by egrid; a NULL key would break it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import state as S
from ..session import stage_table
from ..sources.bucketed import BucketedTable


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def content_hash() -> Column:
    """md5 of zone type | building flag | rounded area | blocking | rounded score."""
    return F.md5(F.concat_ws(
        "|", _text(F.col("zone_type")), _text(F.col("is_building_zone")),
        _text(F.rint(F.col("area_m2")).cast("bigint")), _text(F.col("oereb_blocking")),
        _text(F.rint(F.col("opportunity_score")).cast("bigint"))))


def current_hashes(parcels: DataFrame) -> DataFrame:
    return parcels.where(F.col("egrid").isNotNull()).select("egrid", content_hash().alias("content_hash"))


def latest(snapshots: DataFrame) -> DataFrame:
    """Latest content hash per egrid (max_by over run_ts; partial aggregation)."""
    return snapshots.groupBy("egrid").agg(F.max_by("content_hash", "run_ts").alias("content_hash"))


class LastState:
    """The last content hash of every parcel, kept from run to run in key-hash buckets: a run reads this table and its own rows, never the log."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.table = BucketedTable(spark, path, "egrid", buckets)

    def start(self, snapshot: DataFrame) -> None:
        self.table.create(S.unique_or_error(snapshot.select("egrid", "run_ts", "content_hash"), "egrid"))

    def merge(self, snapshot: DataFrame) -> list[int]:
        """Take over one run's rows; a row older than the one held changes nothing. Returns the rewritten buckets."""
        held = self.table.read().select(F.col("egrid").alias("_e"), F.col("run_ts").alias("_held"))
        rows = snapshot.select("egrid", "run_ts", "content_hash")
        newer = rows.join(held, F.col("egrid") == F.col("_e"), "left").where(F.col("_held").isNull() | (F.col("run_ts") >= F.col("_held"))).select(*rows.columns)
        return self.table.upsert(stage_table(newer), ["run_ts", "content_hash"])

    def hashes(self) -> DataFrame:
        return self.table.read().select("egrid", "content_hash")


def diff(current: DataFrame, previous: DataFrame) -> DataFrame:
    """LEFT JOIN prev, keep IS DISTINCT FROM: (egrid, new_hash, old_hash)."""
    prev = previous.select("egrid", F.col("content_hash").alias("old_hash"), F.lit(True).alias("_seen"))
    j = current.select("egrid", F.col("content_hash").alias("new_hash")).join(prev, "egrid", "left")
    return j.where(~F.col("new_hash").eqNullSafe(F.col("old_hash")))


def detect_changes(parcels: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Change rows against a whole snapshot log; :func:`changes_since` against the last state gives the same."""
    return changes_since(parcels, latest(snapshots))


def changes_since(parcels: DataFrame, last: DataFrame) -> DataFrame:
    """Change rows ('new' / 'changed') with a JSON detail keeping NULLs; ``last``: egrid, content_hash."""
    d = diff(current_hashes(parcels), last)
    return d.select(
        "egrid",
        F.when(F.col("_seen").isNull(), "new").otherwise("changed").alias("change_type"),
        F.to_json(F.struct("new_hash", "old_hash"), {"ignoreNullFields": "false"}).alias("detail"))


def snapshot_rows(parcels: DataFrame, run_id: str, run_ts) -> DataFrame:
    return current_hashes(parcels).select(
        "egrid", F.lit(run_ts).cast("timestamp").alias("run_ts"), "content_hash",
        F.lit(run_id).alias("run_id"))
