"""Data-profiling operators over feature layers (the diagnostics, as tables)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values (diagnostic defaults of the source pipeline) --------------
LOW_CARD_MAX = 15
LOW_CARD_MAX_ZONING = 40
CAPABILITY_KEYWORDS = ("zone_affectation", "affectation", "zone")
CRS_DEGREE_LIMIT = 200
# ---------------------------------------------------------------------------


def property_keys(features: DataFrame) -> DataFrame:
    return features.select(F.explode(F.map_keys("properties")).alias("key")).distinct()


def value_counts(features: DataFrame) -> DataFrame:
    """Every value of every property key in long form: key, value, n, n_distinct (values of the key).

    A reader picks low-cardinality keys by ``n_distinct`` (the source prints those of at most ``LOW_CARD_MAX``, or ``LOW_CARD_MAX_ZONING``
    values). NULL values count as the text 'None', as printed by the source.
    """
    kv = features.select(F.explode("properties").alias("key", "v")).select("key", F.coalesce("v", F.lit("None")).alias("value"))
    counts = kv.groupBy("key", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(counts.groupBy("key").agg(F.count(F.lit(1)).alias("n_distinct")), "key").select("key", "value", "n", "n_distinct")


def value_mix(df: DataFrame, col: str, order: str, target: str) -> DataFrame:
    """Value counts of ``col`` plus the 1-based position (by ``order``, nulls last) of the first row holding
    ``target`` (NULL when it never occurs). Among rows of equal order the target's come first. Nothing runs while the plan is built: the
    position is one aggregation by order value below the target's first, as a scalar subquery."""
    counts = df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    hit = df.where(F.col(col) == target)
    first = hit.agg(F.min(order).alias("k")).select("k").scalar()
    occurs = hit.agg(F.count(F.lit(1)).alias("n")).select("n").scalar() > 0
    before = df.agg(F.count_if(F.when(first.isNull(), F.col(order).isNotNull()).otherwise(F.col(order) < first)).alias("n")).select("n").scalar()
    return counts.withColumn("first_pos", F.when((F.col("value") == target) & occurs, before + 1).cast("bigint"))


def crs_of(features: DataFrame, geom: str = "geom") -> DataFrame:
    """Per feature: 'WGS84' when |x of the first vertex| <= 200, else 'LV95'."""
    x = F.expr(f"{geom}[0][0][0].x")
    return features.select("id", F.when(F.abs(x) <= CRS_DEGREE_LIMIT, "WGS84").otherwise("LV95").alias("crs"))


def only_value(df: DataFrame, col: str, value: str) -> DataFrame:
    """Does a filtered sample contain only the wanted value (and any row)?"""
    return df.agg(F.count(F.lit(1)).alias("n"),
                  (F.coalesce(F.bool_and(F.col(col) == value), F.lit(False))
                   & (F.count(F.lit(1)) > 0)).alias("only_value"))


def keyword_hits(df: DataFrame, key: str, body: str, words: Sequence[str] = CAPABILITY_KEYWORDS) -> DataFrame:
    """Which keywords occur (case-insensitive) in each whole document."""
    low = F.lower(F.col(body))
    hits = F.filter(F.array(*[F.lit(w) for w in words]), lambda w: low.contains(w))
    return df.select(key, F.array_join(hits, "|").alias("hits"), F.size(hits).alias("n_hits"))
