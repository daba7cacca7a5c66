"""Boundary rows: thresholds exactly at their limits (FIXTURES.md section 4)."""

import pytest
from pyspark.sql import functions as F

from landlens.functions import geometry as G
from landlens.plans import changes as C
from landlens.plans import parcels as P
from landlens.plans import reports as RP
from landlens.plans import zones as Z

X, Y = 2600000.0, 1200000.0


def boxes(spark, rows, schema):
    df = spark.createDataFrame(rows, schema + ", x1 double, y1 double, x2 double, y2 double")
    return G.mark_rect_only(df.withColumn("shape", G.shape_from_box("x1", "y1", "x2", "y2")).drop("x1", "y1", "x2", "y2"))


def test_parcel_thresholds(spark):
    # four 100 x 100 parcels in one building zone; coverage exactly 0.25 / 0.03 / just below; NULL egrid
    parcels = boxes(spark, [
        ("a", "E-A", X, Y, X + 100, Y + 100),
        ("b", "E-B", X + 200, Y, X + 300, Y + 100),
        ("c", "E-C", X + 400, Y, X + 500, Y + 100),
        ("d", None, X + 600, Y, X + 700, Y + 100),
        ("e", "E-E", X + 700.5, Y, X + 800, Y + 100),        # gap exactly 0.5 m to d, 100 m to nothing else
    ], "source_id string, egrid string").withColumn("commune_bfs", F.lit(1)).withColumn(
        "commune_name", F.lit("c")).withColumn("parcel_no", F.lit("1"))
    zoning = boxes(spark, [("Z", "Zone", "use", True, X - 10, Y - 10, X + 900, Y + 110)],
                   "zone_id string, typ_kt string, hauptnutzung string, is_building_zone boolean")
    buildings = boxes(spark, [
        ("b1", X, Y, X + 50, Y + 50),          # 2500 / 10000 = 0.25 exactly
        ("b2", X + 200, Y, X + 230, Y + 10),   # 300 / 10000 = 0.03 exactly
        ("b3", X + 400, Y, X + 429.75, Y + 10),  # 297.5 -> 0.02975
    ], "bld_id string").withColumn("floors", F.lit(None).cast("int"))
    empty = boxes(spark, [], "pz_id string")
    restr = spark.createDataFrame([], "egrid string, theme_code string, theme_text string, sub_theme string, legal_state string")
    base = P.base_parcels(parcels.select("source_id", "egrid", "commune_bfs", "commune_name", "parcel_no", "shape"))
    s = P.score(P.enrich(base, zoning, empty, empty.withColumnRenamed("pz_id", "fg_id"), buildings, restr, cell=64.0),
                cell=64.0)
    r = {x["source_id"]: x for x in s.collect()}
    assert r["a"]["coverage_ratio"] == 0.25 and not r["a"]["signal_underuse"] and not r["a"]["signal_servicing"]
    assert r["b"]["coverage_ratio"] == 0.03 and r["b"]["signal_underuse"] and not r["b"]["signal_servicing"]
    assert r["c"]["signal_underuse"] and r["c"]["signal_servicing"]
    assert r["d"]["zone_type"] is None and r["d"]["opportunity_score"] == 0        # NULL egrid: keyed update misses
    assert r["e"]["signal_assembly"] is False                                      # its only neighbour has no egrid
    ch = C.detect_changes(s, spark.createDataFrame([], "egrid string, run_ts timestamp, content_hash string"))
    assert sorted(x["egrid"] for x in ch.collect()) == ["E-A", "E-B", "E-C", "E-E"]


def test_zone_score_thresholds(spark):
    def z(zid, code, h, w, hgt=100.0):
        return (zid, code, h, X, Y + 1000 * int(zid), X + w, Y + 1000 * int(zid) + hgt)
    zoning = boxes(spark, [z("1", "D4A", 12, 30.0), z("2", "D4A", 15, 10.0), z("3", "D4A", 21, 300.0),
                           z("4", "D4A", None, 40.0), z("5", "D4A", 10, 29.0)],
                   "zone_id string, zone_code string, height_limit_m int").select(
        "zone_id", "zone_code", "height_limit_m", F.lit(True).alias("is_building_zone"), F.lit("Zone").alias("typ_kt"),
        F.lit("c").alias("hauptnutzung"), F.lit(1).alias("commune_bfs"), F.lit("7").alias("density_indice"), "shape")
    zoning = G.mark_rect_only(zoning)
    forest = boxes(spark, [("f", X, Y + 3000, X + 40, Y + 3100)], "fg_id string")   # zone 3 loses 4000
    empty = boxes(spark, [], "pz_id string")
    a = {r["zone_id"]: r for r in Z.phase_a(zoning, forest, empty, cell=100.0).collect()}
    # dev 3000 -> large (15); 1000 -> 7; height 12 -> 12, 15 -> 20, 21 -> 25, NULL -> 8, 10 -> 0
    assert a["1"]["developable_m2"] == 3000 and a["1"]["opportunity_score"] == 50 + 12 + 15 + 5
    assert a["2"]["developable_m2"] == 1000 and a["2"]["opportunity_score"] == 50 + 20 + 7
    assert a["3"]["developable_m2"] == 26000 and a["3"]["opportunity_score"] == 50 + 25 + 15 + 5
    assert a["4"]["developable_m2"] == 4000 and a["4"]["opportunity_score"] == 50 + 8 + 15 + 5
    assert a["5"]["developable_m2"] == 2900 and a["5"]["opportunity_score"] == 50 + 0 + 7 + 5
    assert "height limit 12m" in a["1"]["score_reasons"] and "workable site size" in a["1"]["score_reasons"]


def test_zero_developable_zone_reblended(spark):
    zoning = boxes(spark, [("1", "D4A", X, Y, X + 10, Y + 10)], "zone_id string, zone_code string").select(
        "zone_id", "zone_code", F.lit(None).cast("int").alias("height_limit_m"), F.lit(True).alias("is_building_zone"),
        F.lit("Zone").alias("typ_kt"), F.lit("c").alias("hauptnutzung"), F.lit(1).alias("commune_bfs"),
        F.lit("7").alias("density_indice"), "shape")
    zoning = G.mark_rect_only(zoning)
    forest = boxes(spark, [("f", X - 1, Y - 1, X + 11, Y + 11)], "fg_id string")
    empty = boxes(spark, [], "pz_id string")
    za = Z.phase_a(zoning, forest, empty, cell=50.0)
    assert za.first()["opportunity_score"] == 0
    bld = boxes(spark, [("b", X + 1000, Y, X + 1001, Y + 1)], "bld_id string").withColumn("floors", F.lit(2))
    zb = Z.phase_b(za, bld, empty.withColumnRenamed("pz_id", "objectid"), cell=50.0, envelope=(X - 5, Y - 5, X + 2000, Y + 5))
    r = zb.first()
    assert r["utilisation_pct"] is None and r["opportunity_score"] == pytest.approx(0.45 * 35)   # 15.75
    assert r["score_reasons"] == "TARGET D4A"


def test_lead_status_rounding(spark):
    df = spark.createDataFrame([(1, 19.4, 0), (2, 19.6, 0), (3, None, 2), (0, None, 0), (4, 50.0, 1)],
                               "n_buildings int, utilisation_pct double, n_raisable int")
    got = [r[0] for r in df.select(RP.lead_status()).collect()]
    assert got == ["barely built", "underbuilt", "— · 2 raisable", "EMPTY", "underbuilt · 1 raisable"]
