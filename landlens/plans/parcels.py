"""Parcel product: enrichment, scoring, shortlist.

Enrichment is one grid overlay of the parcels against the tagged union of
zoning, planning zones, forest and building footprints, reduced per parcel in
a single aggregation: dominant zone (argmax overlap, ties -> smallest zone_id)
via ``min(struct(-overlap, zone_id, ...))`` -- a partial aggregate, so no
parcel's candidates are ever sorted in one task -- plus the planning EXISTS and
the two overlap sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..operators.overlay import any_hit, is_kind, overlay_summary, sum_overlap
from ..operators.nearby import with_neighbour
from ..functions import geometry as G
from ..session import stage_table

PARCEL_CELL = 64.0
NEIGHBOUR_DISTANCE = 0.5


def parcel_key() -> F.Column:
    """Row key: the egrid, else the source id in a namespace egrids never use, else a hash of the shape."""
    source = F.when(F.coalesce(F.col("source_id"), F.lit("")) != "", F.concat(F.lit("~src:"), F.col("source_id")))
    return F.coalesce(F.col("egrid"), source, F.concat(F.lit("~geo:"), F.hex(F.xxhash64("shape"))))


def base_parcels(raw_parcels: DataFrame) -> DataFrame:
    """core.parcel base columns from raw parcels (area computed from geometry)."""
    return raw_parcels.select(
        parcel_key().alias("pkey"), "egrid", "source_id", "commune_bfs", "commune_name",
        "parcel_no", "shape", F.col("shape.area").alias("area_m2"))


def restriction_flags(restrictions: DataFrame) -> DataFrame:
    """Per checked egrid: blocking = any in-force restriction in a blocking theme."""
    blocking = F.col("theme_code").isin(*R.BLOCKING_THEMES) & (F.col("legal_state") == "inForce")
    return (restrictions.where(F.col("egrid").isNotNull()).groupBy("egrid")
            .agg(F.coalesce(F.max(blocking), F.lit(False)).alias("_blocking"))
            .select(F.col("egrid").alias("pkey"), F.lit(True).alias("_checked"), "_blocking"))


def overlay(parcels: DataFrame, zoning: DataFrame, planning: DataFrame, forest: DataFrame,
            buildings: DataFrame, cell: float = PARCEL_CELL) -> DataFrame:
    """Spatial part of the enrichment (everything but the legal flags)."""
    zcols = ["zone_id", "typ_kt", "hauptnutzung", "is_building_zone"]
    z = is_kind("zone")
    dominant = F.min(F.when(z, F.struct(
        (-F.col("overlap_m2")).alias("neg_overlap"), "zone_id", "typ_kt", "hauptnutzung",
        "is_building_zone"))).alias("_dom")
    aggs = [dominant, any_hit("plan", "in_planning_zone"),
            sum_overlap("forest", "forest_overlap_m2"), sum_overlap("bld", "building_footprint_m2")]
    layers = {"zone": zoning, "plan": planning, "forest": forest, "bld": buildings}
    p = overlay_summary(parcels, "pkey", layers, aggs, columns=zcols, cell=cell)
    has_key = F.col("egrid").isNotNull()  # keyed update: NULL egrid never matches
    p = p.select(
        *[c for c in parcels.columns],
        F.when(has_key, F.col("_dom.typ_kt")).alias("zone_type"),
        F.when(has_key, F.col("_dom.hauptnutzung")).alias("primary_use"),
        F.when(has_key, F.col("_dom.is_building_zone")).alias("is_building_zone"),
        F.when(has_key, F.col("_dom.zone_id")).alias("dominant_zone_id"),
        F.coalesce("in_planning_zone", F.lit(False)).alias("in_planning_zone"),
        F.coalesce("forest_overlap_m2", F.lit(0.0)).alias("forest_overlap_m2"),
        F.coalesce("building_footprint_m2", F.lit(0.0)).alias("building_footprint_m2"))
    area = F.col("area_m2")
    return (p.withColumn("developable_m2",
                         F.when(F.col("is_building_zone"), F.greatest(area - F.col("forest_overlap_m2"), F.lit(0.0)))
                         .otherwise(F.lit(0.0)))
            .withColumn("coverage_ratio", F.when(area > 0, F.col("building_footprint_m2") / area)))


def apply_restrictions(overlaid: DataFrame, restrictions: DataFrame) -> DataFrame:
    """oereb_checked / oereb_blocking for parcels whose egrid has restriction rows."""
    flags = restriction_flags(restrictions)
    return (overlaid.drop("oereb_checked", "oereb_blocking").join(flags, "pkey", "left")
            .withColumn("oereb_checked", F.coalesce("_checked", F.lit(False)))
            .withColumn("oereb_blocking", F.col("_blocking"))
            .drop("_checked", "_blocking"))


def enrich(parcels: DataFrame, zoning: DataFrame, planning: DataFrame, forest: DataFrame,
           buildings: DataFrame, restrictions: DataFrame, cell: float = PARCEL_CELL) -> DataFrame:
    """core.parcel after the enrichment steps (parcels = base_parcels output)."""
    return apply_restrictions(overlay(parcels, zoning, planning, forest, buildings, cell), restrictions)


def adjacency(enriched: DataFrame, distance: float = NEIGHBOUR_DISTANCE,
              cell: float = PARCEL_CELL) -> DataFrame:
    """DISTINCT a.egrid with a same-use building-zone neighbour within distance
    that a does not contain (the use class is part of the equi-join key)."""
    cand = (enriched.where(F.col("is_building_zone") & F.col("egrid").isNotNull()
                           & F.col("primary_use").isNotNull())
            .select("pkey", "primary_use", "shape"))
    # A neighbour only has to exist, and equal shapes contain each other: compare distinct shapes, stop at the first hit.
    form = F.xxhash64("primary_use", "shape")
    forms = stage_table(cand.select("primary_use", "shape").distinct().withColumn("_a", form))
    if G.is_rect_only(enriched, "shape"):
        forms = G.mark_rect_only(forms)
    hit = with_neighbour(forms, "_a", "primary_use", distance, cell)
    return cand.withColumn("_a", form).join(hit, "_a", "left_semi").select("pkey")


def score(enriched: DataFrame, distance: float = NEIGHBOUR_DISTANCE,
          cell: float = PARCEL_CELL, adjacent: DataFrame | None = None) -> DataFrame:
    """Signals and 0-100 opportunity score, recomputed from scratch.

    ``adjacent`` (output of :func:`adjacency`) can be passed when it is already
    known; it depends only on geometry and zoning, not on the legal flags.
    """
    bz, dev = F.col("is_building_zone"), F.col("developable_m2")
    cov = F.col("coverage_ratio")
    free = F.coalesce(F.col("oereb_blocking"), F.lit(False)) == False  # noqa: E712
    adj = (adjacent if adjacent is not None else adjacency(enriched, distance, cell)).withColumn("_adj", F.lit(True))
    p = enriched.join(adj, "pkey", "left")
    p = (p.withColumn("signal_underuse",
                      F.coalesce(bz & (dev > 0) & cov.isNotNull() & (cov < 0.25) & free, F.lit(False)))
         .withColumn("signal_servicing",
                     F.coalesce(bz & (dev > 0) & (F.coalesce(cov, F.lit(0.0)) < 0.03) & free, F.lit(False)))
         .withColumn("signal_assembly",
                     F.coalesce(F.col("_adj") & (dev > 0) & free, F.lit(False)))
         .drop("_adj"))
    raw = (F.least(dev, F.lit(5000.0)) / 5000.0 * 30
           + F.when(F.col("signal_underuse"), 25).otherwise(0)
           + F.when(F.col("signal_servicing"), 20).otherwise(0)
           + F.when(F.col("signal_assembly"), 20).otherwise(0)
           + F.when(F.col("in_planning_zone"), 5).otherwise(0))
    s = F.least(F.lit(100.0), F.greatest(F.lit(0.0), raw))
    # NOT NULL is NULL in the source WHERE clause; such rows have developable 0 anyway
    zero = F.coalesce(~bz, F.lit(False)) | ~free | (F.coalesce(dev, F.lit(0.0)) == 0)
    return (p.withColumn("score_raw", s).withColumn("score_zeroed", zero)
            .withColumn("opportunity_score", F.when(zero, F.lit(0.0)).otherwise(s)))


def shortlist(scored: DataFrame, n: int = 100) -> DataFrame:
    """Top-n scored parcels with an egrid (ties by egrid)."""
    return (scored.where(F.col("egrid").isNotNull() & (F.col("opportunity_score") > 0))
            .orderBy(F.col("opportunity_score").desc_nulls_last(), F.col("egrid").asc())
            .limit(n))
