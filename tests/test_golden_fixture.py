"""The source pipeline's hand-made fixture: 5 square parcels, 2 zones, one
planning zone, 3 buildings, one blocking restriction. Expected values derived
by hand from the rules (FIXTURES.md section 1)."""

import pytest
from pyspark.sql import functions as F

from landlens.functions import geometry as G
from landlens.plans import changes as C
from landlens.plans import parcels as P


def boxes(spark, rows, cols):
    df = spark.createDataFrame(rows, cols + ["x1", "y1", "x2", "y2"])
    return G.mark_rect_only(df.withColumn("shape", G.shape_from_box("x1", "y1", "x2", "y2"))
                            .drop("x1", "y1", "x2", "y2"))


@pytest.fixture(scope="module")
def scored(spark):
    s = 44.72
    parcels = boxes(spark, [
        ("P1", "CH100000000001", 5586, "Lausanne", "101", 2538000.0, 1152000.0, 2538000 + s, 1152000 + s),
        ("P2", "CH100000000002", 5586, "Lausanne", "102", 2538000 + s, 1152000.0, 2538000 + 2 * s, 1152000 + s),
        ("P3", "CH100000000003", 5586, "Lausanne", "103", 2538200.0, 1152200.0, 2538200 + s, 1152200 + s),
        ("P4", "CH100000000004", 5586, "Lausanne", "104", 2538300.0, 1152000.0, 2538300 + s, 1152000 + s),
        ("P5", "CH100000000005", 5586, "Lausanne", "105", 2538400.0, 1152000.0, 2538400 + s, 1152000 + s),
    ], ["source_id", "egrid", "commune_bfs", "commune_name", "parcel_no"])
    zoning = boxes(spark, [
        ("Z-RES", 5586, "Zone village", "Wohnzonen", True, 2537990.0, 1151990.0, 2538460.0, 1152060.0),
        ("Z-AGR", 5586, "Zone agricole", "Landwirtschaftszonen", False, 2538190.0, 1152190.0, 2538260.0, 1152260.0),
    ], ["zone_id", "commune_bfs", "typ_kt", "hauptnutzung", "is_building_zone"])
    planning = boxes(spark, [("PZ-1", 2538395.0, 1151995.0, 2538450.0, 1152055.0)], ["pz_id"])
    forest = planning.where(F.lit(False)).withColumnRenamed("pz_id", "fg_id")
    buildings = boxes(spark, [
        ("B1", 2538005.0, 1152005.0, 2538019.14, 1152019.14),
        ("B2", 2538050.0, 1152005.0, 2538064.14, 1152019.14),
        ("B4", 2538302.0, 1152002.0, 2538340.7, 1152040.7),
    ], ["bld_id"])
    restrictions = spark.createDataFrame(
        [("CH100000000002", "GroundwaterProtectionZones", "Zone de protection des eaux", None, "inForce")],
        "egrid string, theme_code string, theme_text string, sub_theme string, legal_state string")
    enriched = P.enrich(P.base_parcels(parcels), zoning, planning, forest, buildings, restrictions, cell=50.0)
    return P.score(enriched, cell=50.0)


EXPECTED = {  # source_id: (building zone, planning, blocked, underuse, servicing, assembly, score)
    "P1": (True, False, None, True, False, True, 56.9992704),
    "P2": (True, False, True, False, False, False, 0.0),
    "P3": (False, False, None, False, False, False, 0.0),
    "P4": (True, False, None, False, False, False, 11.9992704),
    "P5": (True, True, None, True, True, False, 61.9992704),
}


def test_scores(scored):
    rows = {r["source_id"]: r for r in scored.collect()}
    assert set(rows) == set(EXPECTED)
    for sid, (bz, plan, blocked, under, serv, asm, score) in EXPECTED.items():
        r = rows[sid]
        assert r["is_building_zone"] is bz, sid
        assert r["in_planning_zone"] is plan, sid
        assert r["oereb_blocking"] is blocked, sid
        assert (r["signal_underuse"], r["signal_servicing"], r["signal_assembly"]) == (under, serv, asm), sid
        assert r["opportunity_score"] == pytest.approx(score, abs=1e-6), sid


def test_coverage_and_developable(scored):
    rows = {r["source_id"]: r for r in scored.collect()}
    area = 44.72 * 44.72
    assert rows["P1"]["developable_m2"] == pytest.approx(area, abs=1e-6)
    assert rows["P3"]["developable_m2"] == 0
    assert rows["P4"]["building_footprint_m2"] == pytest.approx(38.7 * 38.7, abs=1e-6)
    assert rows["P5"]["coverage_ratio"] == 0


def test_change_detection_idempotent(spark, scored):
    empty = spark.createDataFrame([], "egrid string, run_ts timestamp, content_hash string")
    first = C.detect_changes(scored, empty)
    assert sorted(r["change_type"] for r in first.collect()) == ["new"] * 5
    snap = C.snapshot_rows(scored, "r1", "2025-01-01 00:00:00").drop("run_id")
    assert C.detect_changes(scored, snap).count() == 0
