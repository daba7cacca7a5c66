"""The raw layers of one run, resolved lazily from a table folder."""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..session import ensure_checkpoint_dir, stage_table, tune
from ..sources import derived as D
from ..sources import loaders as L
from ..sources import geojson as J
from . import changes as C
from . import parcels as P
from . import zones as Z

RUN1_TS, RUN2_TS, RUN3_TS = "2025-01-01 00:00:00", "2025-01-02 00:00:00", "2025-01-03 00:00:00"


class Layers:
    """raw.* layers derived from the driver tables in ``d`` (all lazy)."""

    def __init__(self, spark: SparkSession, d: str):
        self.spark = tune(spark)
        self.d = d

    def pin(self, df: DataFrame) -> DataFrame:
        """Materialise an intermediate that several branches reuse: a table in the
        shared ``spark.checkpoint.dir`` (cuts lineage, so a lost executor never
        forces the spatial joins to rerun; branches read only their columns)."""
        return stage_table(df)

    @cached_property
    def zoning_features(self) -> DataFrame:
        return G.mark_rect_only(
            D.zoning_features(self.spark, self.d).withColumn("shape", G.shape_from_rects("rects")))

    @cached_property
    def zoning(self) -> DataFrame:
        return L.load_zoning_cantonal(self.zoning_features)

    @cached_property
    def zoning_table(self) -> DataFrame:
        """The zoning layer as a stage table, for the products: they scan it several times, and its rows are costly to type."""
        return self.pin(self.zoning)

    @cached_property
    def parcels(self) -> DataFrame:
        return D.parcels(self.spark, self.d)

    @cached_property
    def buildings(self) -> DataFrame:
        return D.buildings(self.spark, self.d)

    @cached_property
    def forest(self) -> DataFrame:
        return D.forest(self.spark, self.d)

    @cached_property
    def planning(self) -> DataFrame:
        return D.planning_zones(self.spark, self.d)

    @cached_property
    def raisable(self) -> DataFrame:
        return D.surelevation(self.spark, self.d)

    @cached_property
    def restrictions(self) -> DataFrame:
        return D.restrictions(self.spark, self.d)

    # --- products ---------------------------------------------------------
    @cached_property
    def overlaid(self) -> DataFrame:
        return self.pin(P.overlay(P.base_parcels(self.parcels), self.zoning_table, self.planning, self.forest,
                                  self.buildings))

    @cached_property
    def enriched(self) -> DataFrame:
        return P.apply_restrictions(self.overlaid, self.restrictions)

    @cached_property
    def adjacent(self) -> DataFrame:
        return self.pin(P.adjacency(self.overlaid))

    @cached_property
    def scored(self) -> DataFrame:
        return self.pin(P.score(self.enriched, adjacent=self.adjacent))

    @cached_property
    def zones_a(self) -> DataFrame:
        return self.pin(Z.phase_a(self.zoning_table, self.forest, self.planning))

    @cached_property
    def zones_b(self) -> DataFrame:
        return Z.phase_b(self.zones_a, self.buildings, self.raisable)

    @cached_property
    def communes_a(self) -> DataFrame:
        return Z.communes(self.zones_a, "a")

    @cached_property
    def communes_b(self) -> DataFrame:
        return Z.communes(self.zones_b, "b")

    @cached_property
    def shortlist(self) -> DataFrame:
        return P.shortlist(self.scored)

    @cached_property
    def snapshots(self) -> DataFrame:
        """Two earlier runs of audit.parcel_snapshot derived from the parcels:
        run 1 hashes 'old' for all; run 2 the true hash except 'x' for every
        7th parcel; every 10th parcel (k % 10 = 9) is absent from both."""
        k = F.col("source_id").cast("bigint")
        cur = (self.scored.where(F.col("egrid").isNotNull() & (k % 10 != 9))
               .select("egrid", k.alias("_k"), C.content_hash().alias("h")))
        r1 = cur.select("egrid", F.lit(RUN1_TS).cast("timestamp").alias("run_ts"),
                        F.md5(F.lit("old")).alias("content_hash"))
        r2 = cur.select("egrid", F.lit(RUN2_TS).cast("timestamp").alias("run_ts"),
                        F.when(F.col("_k") % 7 == 0, F.md5(F.lit("x"))).otherwise(F.col("h")).alias("content_hash"))
        return r1.unionByName(r2)

    @cached_property
    def last_hashes(self) -> DataFrame:
        """What the two earlier runs left: the last state, merged run by run."""
        last = C.LastState(self.spark, f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/landlens-last-{uuid.uuid4().hex}", 16)
        for k, ts in enumerate((RUN1_TS, RUN2_TS)):
            rows = self.snapshots.where(F.col("run_ts") == F.lit(ts).cast("timestamp"))
            if k:
                last.merge(rows)
            else:
                last.start(rows)
        return last.hashes()

    @cached_property
    def changes(self) -> DataFrame:
        return C.changes_since(self.scored, self.last_hashes)

    @cached_property
    def zoning_parsed(self) -> DataFrame:
        """Zoning read back from landed FeatureCollection pages: a stage table, so that pages are parsed and repaired once."""
        return self.pin(J.to_features(J.explode_pages(D.zoning_pages(self.spark, self.d))))

    @cached_property
    def extracts(self) -> DataFrame:
        return D.restriction_extracts(self.spark, self.d)
