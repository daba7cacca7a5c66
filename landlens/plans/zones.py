"""Zone product: Phase A zone quality, Phase B built-vs-permitted, communes.

Each UPDATE chain of the source pipeline is one projection over the previous
DataFrame; correlated spatial sub-queries become one overlay per phase.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import rules as R
from ..session import stage_table
from ..operators.overlay import any_hit, count_hits, is_kind, overlay_summary, sum_overlap

ZONE_CELL = 128.0

PHASE_B_DEFAULTS = {"n_buildings": "bigint", "built_footprint_m2": "double",
                    "built_floor_area_m2": "double", "avg_floors": "double",
                    "permitted_floor_m2": "double", "utilisation_pct": "double",
                    "coverage_pct": "double", "n_raisable": "bigint", "underuse_score": "double"}
PHASE_B_ZEROS = ("n_buildings", "n_raisable", "built_footprint_m2", "built_floor_area_m2")


def zone_base(zoning: DataFrame) -> DataFrame:
    """Building zones with geometry -> zone_opportunity base rows.

    The row key is the zone's id (it may be empty or given twice), a hash of the whole row and, for the copies of a row, their number: equal rows are counted
    and dealt out again, so the keys are the same in any order of the input, and no group of equal zones meets in a window."""
    names = [c for c in ("zone_id", "commune_bfs", "typ_kt", "hauptnutzung", "is_building_zone", "zone_code", "height_limit_m", "density_indice", "shape") if c in zoning.columns]
    once = (zoning.where(F.col("is_building_zone") & F.col("shape").isNotNull()).groupBy(*names).agg(F.count(F.lit(1)).alias("_copies"))
            .withColumn("_copy", F.explode(F.expr("sequence(1L, _copies)"))))
    key = F.concat_ws("#", F.coalesce(F.col("zone_id"), F.lit("")), F.hex(F.xxhash64(*names)), F.when(F.col("_copy") > 1, F.col("_copy").cast("string")))
    if G.is_rect_only(zoning):
        once = G.mark_rect_only(once)
    return once.select(key.alias("zone_uid"), "zone_id", "commune_bfs",
                       F.col("hauptnutzung").alias("commune_name"), F.col("typ_kt").alias("zone_type"),
                       F.col("hauptnutzung").alias("primary_use"), "zone_code", "height_limit_m",
                       "density_indice", "shape", F.col("shape.area").alias("area_m2"),
                       F.col("shape.nparts").alias("n_parts"))


def _trim_list(col: Column) -> Column:
    return F.btrim(col, F.lit(", "))


def reasons_a() -> Column:
    tier, code, h = F.col("zone_tier"), F.col("zone_code"), F.col("height_limit_m")
    return _trim_list(F.concat_ws(
        ", ",
        F.when(tier == "target", F.concat(F.lit("TARGET: mid-density apartment zone ("), code, F.lit(")"))),
        F.when(tier == "secondary", F.concat(F.lit("buildable ("), code, F.lit(")"))),
        F.when(tier == "avoid", F.lit("villa/protected — low development potential")),
        F.when(h.isNotNull(), F.concat(F.lit("height limit "), h.cast("string"), F.lit("m"))),
        F.when(F.col("signal_large_zone"), F.lit("workable site size")),
        F.when(F.col("developable_m2") > 100000, F.lit("very large (masterplan scale)")),
        F.when(F.col("signal_plan_revision"), F.lit("plan under revision"))))


def score_a() -> Column:
    tier, h, dev = F.col("zone_tier"), F.col("height_limit_m"), F.col("developable_m2")
    raw = ((F.when(tier == "target", 50).when(tier == "secondary", 22).otherwise(0))
           + (F.when(h >= 21, 25).when(h >= 15, 20).when(h >= 12, 12).when(h.isNull(), 8).otherwise(0))
           + (F.when(F.col("signal_large_zone"), 15).when(dev.between(1000, 3000), 7).otherwise(0))
           + F.when(F.col("signal_low_fragment"), 5).otherwise(0)
           + F.when(F.col("signal_plan_revision"), 5).otherwise(0)
           + F.when(tier == "avoid", -20).otherwise(0))
    return F.greatest(F.lit(0), F.least(F.lit(100), raw)).cast("double")


def phase_a(zoning: DataFrame, forest: DataFrame, planning: DataFrame,
            cell: float = ZONE_CELL) -> DataFrame:
    """core.zone_opportunity after the Phase A build."""
    base = stage_table(zone_base(zoning))  # counted by cell, placed and joined back: built once
    z = overlay_summary(base, "zone_uid", {"forest": forest, "plan": planning},
                        [sum_overlap("forest", "forest_overlap_m2"), any_hit("plan", "in_planning_zone")],
                        cell=cell)
    dev = F.col("developable_m2")
    z = (z.withColumn("forest_overlap_m2", F.coalesce("forest_overlap_m2", F.lit(0.0)))
         .withColumn("in_planning_zone", F.coalesce("in_planning_zone", F.lit(False)))
         .withColumn("developable_m2", F.greatest(F.col("area_m2") - F.col("forest_overlap_m2"), F.lit(0.0)))
         .withColumn("zone_tier", R.zone_tier("zone_code"))
         .withColumn("signal_large_zone", F.coalesce(dev.between(3000, 30000), F.lit(False)))
         .withColumn("signal_plan_revision", F.col("in_planning_zone"))
         .withColumn("signal_low_fragment", F.coalesce((F.col("n_parts") == 1) & (dev > 1000), F.lit(False))))
    z = (z.withColumn("opportunity_score", score_a())
         .withColumn("score_reasons", reasons_a())
         .withColumn("opportunity_score",
                     F.when(F.coalesce(dev, F.lit(0.0)) == 0, F.lit(0.0)).otherwise(F.col("opportunity_score"))))
    return z


def with_phase_b_defaults(zones: DataFrame) -> DataFrame:
    """Phase B columns as the additive migration leaves them (0 / NULL)."""
    out = zones
    for c, t in PHASE_B_DEFAULTS.items():
        if c not in out.columns:
            out = out.withColumn(c, (F.lit(0) if c in PHASE_B_ZEROS else F.lit(None)).cast(t))
    return out


def target_extent(zones: DataFrame) -> DataFrame:
    """ST_Extent of target/secondary zones (one row; NULLs when none)."""
    t = zones.where(F.col("zone_tier").isin("target", "secondary"))
    return t.agg(F.min("shape.xmin").alias("xmin"), F.min("shape.ymin").alias("ymin"),
                 F.max("shape.xmax").alias("xmax"), F.max("shape.ymax").alias("ymax"))


def within_envelope(layer: DataFrame, xmin, ymin, xmax, ymax) -> DataFrame:
    """Rows whose shape meets the closed envelope: box test first, then the exact predicate for shapes that are not rectangles."""
    inside = layer.where((F.col("shape.xmin") <= xmax) & (F.col("shape.xmax") >= xmin)
                         & (F.col("shape.ymin") <= ymax) & (F.col("shape.ymax") >= ymin))
    as_col = lambda v: v if isinstance(v, Column) else F.lit(float(v))
    boxed = inside.withColumns({"_ex1": as_col(xmin), "_ey1": as_col(ymin), "_ex2": as_col(xmax), "_ey2": as_col(ymax)})
    boxed = boxed.withColumn("_env", G.shape_from_box("_ex1", "_ey1", "_ex2", "_ey2"))
    exact = F.expr(G.intersects_sql("shape", "_env", G.is_rect_only(layer)))
    return boxed.where(exact).drop("_ex1", "_ey1", "_ex2", "_ey2", "_env")


def reasons_b() -> Column:
    tier, code, h = F.col("zone_tier"), F.col("zone_code"), F.col("height_limit_m")
    util, nb, nr = F.col("utilisation_pct"), F.col("n_buildings"), F.col("n_raisable")
    util_txt = F.round(util.cast("decimal(38,10)"), 0).cast("decimal(38,0)").cast("string")
    return _trim_list(F.concat_ws(
        ", ",
        F.when(tier == "target", F.concat(F.lit("TARGET "), code)),
        F.when(tier == "secondary", F.concat(F.lit("buildable "), code)),
        F.when(tier == "avoid", F.lit("villa/protected")),
        F.when((nb == 0) & (F.col("developable_m2") > 0), F.lit("EMPTY — no buildings on site")),
        F.when(util.isNotNull() & (nb > 0),
               F.concat(F.lit("only "), util_txt, F.lit("% of permitted density built"))),
        F.when(nr > 0, F.concat(nr.cast("string"), F.lit(" building(s) the canton says CAN BE RAISED"))),
        F.when(h.isNotNull(), F.concat(F.lit("height limit "), h.cast("string"), F.lit("m"))),
        F.when(F.col("signal_large_zone"), F.lit("workable site size"))))


def phase_b(zones_a: DataFrame, buildings: DataFrame, raisable: DataFrame,
            cell: float = ZONE_CELL, envelope: tuple | None = None) -> DataFrame:
    """Phase B on Phase A zones.

    Buildings are read only inside the envelope (given, or that of target/secondary zones). With
    no such zone, or no building inside the envelope, the zones keep their
    Phase A scores; ``phase_b_applied`` says which. The envelope is one row, and the buildings inside it a stage table, each made once
    before the overlay is planned; the zones' Phase A values ride along.
    """
    box = envelope or target_extent(zones_a).first()
    if box[0] is None:
        bld = buildings.where(F.lit(False))
    else:
        bld = stage_table(within_envelope(buildings, *box))
        bld = G.mark_rect_only(bld) if G.is_rect_only(buildings) else bld
    applied = bld.agg(F.count(F.lit(1)) > 0).scalar()
    zones_a = zones_a.withColumns({"_a_opportunity_score": F.col("opportunity_score"), "_a_score_reasons": F.col("score_reasons")})

    ov, fl = F.col("overlap_m2"), F.col("floors")
    b = is_kind("bld")
    aggs = [F.count_if(b).alias("n_buildings"),
            F.sum(F.when(b, ov)).alias("built_footprint_m2"),
            F.sum(F.when(b, ov * F.coalesce(F.nullif(fl, F.lit(0)), F.lit(2)))).alias("built_floor_area_m2"),
            F.avg(F.when(b, F.nullif(fl, F.lit(0)))).alias("avg_floors"),
            count_hits("raise", "n_raisable")]
    z = overlay_summary(zones_a, "zone_uid", {"bld": bld, "raise": raisable}, aggs,
                        columns=["floors"], cell=cell)
    dev, h = F.col("developable_m2"), F.col("height_limit_m")
    permitted = (F.when((dev > 0) & h.isNotNull(),
                        dev * 0.35 * F.greatest(F.floor(h / 3.0), F.lit(1)))
                 .when(dev > 0, dev * 0.35 * 3))
    z = (z.withColumn("n_buildings", F.coalesce("n_buildings", F.lit(0)).cast("bigint"))
         .withColumn("built_footprint_m2", F.coalesce("built_footprint_m2", F.lit(0.0)))
         .withColumn("built_floor_area_m2", F.coalesce("built_floor_area_m2", F.lit(0.0)))
         .withColumn("n_raisable", F.coalesce("n_raisable", F.lit(0)).cast("bigint"))
         .withColumn("permitted_floor_m2", permitted.cast("double")))
    perm = F.col("permitted_floor_m2")
    z = (z.withColumn("utilisation_pct",
                      F.when(F.coalesce(perm, F.lit(0.0)) > 0,
                             F.least(F.lit(100.0), 100.0 * F.col("built_floor_area_m2") / perm)))
         .withColumn("coverage_pct",
                     F.when(F.coalesce(dev, F.lit(0.0)) > 0,
                            F.least(F.lit(100.0), 100.0 * F.col("built_footprint_m2") / dev))))
    util, nr = F.col("utilisation_pct"), F.col("n_raisable")
    underuse = F.greatest(F.lit(0.0), F.least(F.lit(100.0),
        F.when(util.isNull(), F.lit(35.0)).otherwise(0.70 * (100.0 - util))
        + F.when(nr > 0, F.least(F.lit(30), nr * 10)).otherwise(0)))
    z = z.withColumn("underuse_score", underuse.cast("double"))
    blended = F.greatest(F.lit(0.0), F.least(F.lit(100.0),
        0.55 * F.col("opportunity_score") + 0.45 * F.coalesce(F.col("underuse_score"), F.lit(35.0))))
    z = (z.withColumn("opportunity_score",
                      F.when(F.col("zone_tier").isin("target", "secondary"), blended)
                      .otherwise(F.col("opportunity_score")))
         .withColumn("score_reasons", reasons_b()))
    names = [*PHASE_B_DEFAULTS, "opportunity_score", "score_reasons"]
    plain = {c: F.lit(0.0 if t == "double" else 0).cast(t) if c in PHASE_B_ZEROS else F.lit(None).cast(t) for c, t in PHASE_B_DEFAULTS.items()}
    z = z.withColumn("phase_b_applied", applied)
    for c in names:
        z = z.withColumn(c, F.when(F.col("phase_b_applied"), F.col(c)).otherwise(plain[c] if c in plain else F.col(f"_a_{c}")))
    return z.drop("_a_opportunity_score", "_a_score_reasons")


def communes(zones: DataFrame, phase: str = "a") -> DataFrame:
    """core.commune_opportunity rollup (weights/headline per phase)."""
    t = F.col("zone_tier") == "target"
    dev, score = F.col("developable_m2"), F.col("opportunity_score")
    if phase == "a":
        w_top, w_n = 0.55, 0.30
        third = F.count_if(F.col("in_planning_zone")).alias("n_in_plan_revision")
    else:
        w_top, w_n = 0.60, 0.25
        third = F.coalesce(F.sum("n_raisable"), F.lit(0)).cast("bigint").alias("n_in_plan_revision")
    g = (zones.groupBy(F.coalesce(F.col("commune_bfs"), F.lit(-1)).alias("commune_bfs"))
         .agg(F.max("commune_name").alias("commune_name"),
              F.count_if(t).alias("n_building_zones"),
              F.sum(F.when(t, dev)).alias("total_developable_m2"),
              third,
              F.max(F.when(t, dev)).alias("largest_zone_m2"),
              F.max(score).alias("top_zone_score"),
              F.max(F.when(t, score)).alias("_top_target"),
              F.sum(F.when(t, dev)).alias("_dev_target")))
    n = F.col("n_building_zones")
    cscore = F.least(F.lit(100.0),
                     w_top * F.coalesce(F.col("_top_target"), F.lit(0.0))
                     + w_n * F.least(F.lit(100.0), n * 8.0)
                     + 0.15 * F.least(F.lit(100.0), F.coalesce(F.col("_dev_target"), F.lit(0.0)) / 3000.0))
    ha = F.round((F.coalesce(F.col("total_developable_m2"), F.lit(0.0)) / 10000.0)
                 .cast("decimal(38,10)"), 1).cast("decimal(38,1)").cast("string")
    if phase == "a":
        headline = F.concat(n.cast("string"), F.lit(" target (D4A/D4B) zones, "), ha, F.lit(" ha"))
    else:
        nr = F.col("n_in_plan_revision")
        headline = F.concat(n.cast("string"), F.lit(" target zones, "), ha, F.lit(" ha"),
                            F.when(nr > 0, F.concat(F.lit(", "), nr.cast("string"),
                                                    F.lit(" raisable buildings"))).otherwise(F.lit("")))
    return (g.withColumn("commune_score", F.when(n == 0, F.lit(0.0)).otherwise(cscore))
            .withColumn("headline", headline)
            .drop("_top_target", "_dev_target"))
