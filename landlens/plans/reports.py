"""Promoter-facing report tables over the zone / commune products.

Every report is one aggregate or one top-k (TakeOrderedAndProject); ranks are
numbered only inside the bounded top-k result, never over a whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TOP_SHORTLIST, TOP_COMMUNES, TOP_LEADS, TOP_PDF_LEADS = 100, 15, 20, 15
UNDERBUILT_PCT, BARELY_PCT, FULL_PCT = 40, 20, 80


def half_up(c: Column, scale: int = 0) -> Column:
    """round(x::numeric, scale): decimal rounding, half away from zero."""
    return F.round(c.cast("decimal(38,10)"), scale)


def half_even(c: Column) -> Column:
    """round(double precision): nearest integer, ties to even."""
    return F.rint(c)


def ha_text(m2: Column) -> Column:
    return half_up(F.coalesce(m2, F.lit(0.0)) / 10000.0, 1).cast("decimal(38,1)").cast("string")


def top_k(df: DataFrame, n: int, order: list[Column], rank: str | None = "rank") -> DataFrame:
    """ORDER BY ... LIMIT n (a bounded TakeOrderedAndProject), optionally numbered 1..n."""
    out = df.orderBy(*order).limit(n)
    if rank:
        out = out.withColumn(rank, F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    return out


def commune_label() -> Column:
    return F.coalesce(F.col("commune_name"),
                      F.concat(F.lit("(bfs "), F.col("commune_bfs").cast("string"), F.lit(")")))


def lead_status(util_rounded: Column | None = None) -> Column:
    """EMPTY / barely built / underbuilt / '—', plus ' · N raisable'."""
    util = util_rounded if util_rounded is not None else half_up(F.col("utilisation_pct"))
    nb, nr = F.coalesce(F.col("n_buildings"), F.lit(0)), F.col("n_raisable")
    base = (F.when(nb == 0, "EMPTY").when(util.isNotNull() & (util < BARELY_PCT), "barely built")
            .when(util.isNotNull(), "underbuilt").otherwise("—"))
    return F.concat(base, F.when(F.coalesce(nr, F.lit(0)) != 0,
                                 F.concat(F.lit(" · "), nr.cast("string"), F.lit(" raisable")))
                    .otherwise(F.lit("")))


def kpis(zones: DataFrame) -> DataFrame:
    return zones.agg(
        F.count(F.lit(1)).alias("n_zones"),
        F.count_if(F.col("opportunity_score") > 0).alias("n_scored"),
        F.coalesce(half_even(F.sum("developable_m2") / 10000.0).cast("bigint"), F.lit(0)).alias("developable_ha"),
        F.countDistinct("commune_bfs").alias("n_communes"))


def top_communes(communes: DataFrame, n: int = TOP_COMMUNES) -> DataFrame:
    score = F.coalesce(F.col("commune_score"), F.lit(0.0))
    c = communes.where(score > 0).select(
        "commune_bfs", "commune_score", commune_label().alias("commune_label"),
        half_up(score).cast("bigint").alias("score_rounded"),
        F.coalesce(F.col("n_building_zones"), F.lit(0)).alias("n_zones"),
        ha_text(F.col("total_developable_m2")).alias("developable_ha"))
    return top_k(c, n, [F.col("commune_score").desc(), F.col("commune_bfs").asc()])


def _target_leads(zones: DataFrame) -> DataFrame:
    return zones.where((F.col("opportunity_score") > 0) & (F.col("zone_tier") == "target"))


def top_leads(zones: DataFrame, n: int = TOP_LEADS) -> DataFrame:
    z = _target_leads(zones).select(
        "zone_id", "commune_name", "zone_code", "height_limit_m", "opportunity_score",
        half_even(F.col("developable_m2")).alias("developable_m2"),
        half_up(F.col("opportunity_score")).cast("bigint").alias("score_rounded"),
        half_up(F.col("utilisation_pct")).cast("bigint").alias("util_rounded"),
        "n_buildings", "n_raisable", "score_reasons")
    return top_k(z, n, [F.col("opportunity_score").desc(), F.col("zone_id").asc()])


def underuse_summary(zones: DataFrame) -> DataFrame:
    t, nb, util = F.col("zone_tier") == "target", F.col("n_buildings"), F.col("utilisation_pct")
    return zones.agg(
        F.count_if(t & (nb == 0)).alias("n_empty"),
        F.count_if(t & (util < UNDERBUILT_PCT) & (nb > 0)).alias("n_underbuilt"),
        F.count_if(t & (util >= FULL_PCT)).alias("n_full"),
        F.coalesce(F.sum("n_raisable"), F.lit(0)).cast("bigint").alias("n_raisable"))


def zone_mix(zones: DataFrame) -> DataFrame:
    mix = (zones.groupBy("zone_tier", "zone_code")
           .agg(F.count(F.lit(1)).alias("n_zones"),
                half_up(F.sum("developable_m2") / 10000.0).cast("bigint").alias("developable_ha")))
    # (tier, code) groups are bounded by the zone-code vocabulary
    order = [F.col("zone_tier").asc(), F.col("n_zones").desc(), F.col("zone_code").asc()]
    return mix.orderBy(*order)


def pdf_kpis(zones: DataFrame) -> DataFrame:
    t, nb, util = F.col("zone_tier") == "target", F.col("n_buildings"), F.col("utilisation_pct")
    return zones.agg(
        F.count_if(t).alias("n_target"),
        F.count_if(t & (nb == 0)).alias("n_empty"),
        F.count_if(t & (util < UNDERBUILT_PCT) & (nb > 0)).alias("n_underbuilt"),
        F.count_if(t & (util >= FULL_PCT)).alias("n_full"),
        F.coalesce(F.sum("n_raisable"), F.lit(0)).cast("bigint").alias("n_raisable"),
        F.coalesce(half_up(F.sum(F.when(t, F.col("developable_m2"))) / 10000.0).cast("bigint"),
                   F.lit(0)).alias("target_ha"))


def pdf_leads(zones: DataFrame, n: int = TOP_PDF_LEADS) -> DataFrame:
    util = half_up(F.col("utilisation_pct")).cast("bigint")
    h = F.col("height_limit_m")
    z = _target_leads(zones).select(
        "zone_id", "opportunity_score", "commune_name", "zone_code",
        half_up(F.col("developable_m2")).cast("bigint").alias("developable_m2"),
        F.concat(F.when(h.isNull() | (h == 0), F.lit("?")).otherwise(h.cast("string")), F.lit(" m"))
        .alias("height_txt"),
        F.concat(F.coalesce(util.cast("string"), F.lit("0")), F.lit("%")).alias("built_txt"),
        lead_status(util).alias("status"))
    return top_k(z, n, [F.col("opportunity_score").desc(), F.col("zone_id").asc()])
