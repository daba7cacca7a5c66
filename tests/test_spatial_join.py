"""Grid-cell join == brute force, for several cell sizes, no duplicate pairs."""

import random

import pytest
from pyspark.sql import functions as F

from landlens.functions import geometry as G
from landlens.operators.overlay import exists_flag, hit_count, overlap_sum
from landlens.operators.spatial_join import spatial_join


def rects(rnd, n, span, smax):
    out = []
    for i in range(n):
        x, y = rnd.randint(0, span * 4) / 4, rnd.randint(0, span * 4) / 4
        out.append((i, x, y, x + rnd.randint(1, smax * 4) / 4, y + rnd.randint(1, smax * 4) / 4))
    return out


def layer(spark, rows, key):
    df = spark.createDataFrame(rows, f"{key} int, x1 double, y1 double, x2 double, y2 double")
    return G.mark_rect_only(df.withColumn("shape", G.shape_from_box("x1", "y1", "x2", "y2"))
                            .drop("x1", "y1", "x2", "y2"))


def brute(a, b, d=0.0):
    out = set()
    for i, ax1, ay1, ax2, ay2 in a:
        for j, bx1, by1, bx2, by2 in b:
            gx = max(ax1 - bx2, bx1 - ax2, 0)
            gy = max(ay1 - by2, by1 - ay2, 0)
            if gx * gx + gy * gy <= d * d:
                out.add((i, j))
    return out


@pytest.mark.parametrize("cell", [3.0, 10.0, 50.0, "auto"])
def test_intersects_and_dwithin(spark, cell):
    rnd = random.Random(hash(str(cell)) % 1000)
    a, b = rects(rnd, 150, 60, 12), rects(rnd, 200, 60, 6)
    la, lb = layer(spark, a, "i"), layer(spark, b, "j")
    got = [(r["i"], r["j"]) for r in spatial_join(la, lb, cell=cell).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(a, b)
    got = [(r["i"], r["j"]) for r in spatial_join(la, lb, predicate="dwithin", distance=1.5, cell=cell).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(a, b, 1.5)


def test_general_path_join_matches(spark):
    rnd = random.Random(3)
    a, b = rects(rnd, 80, 40, 10), rects(rnd, 80, 40, 10)
    la = layer(spark, a, "i")
    lb = spark.createDataFrame(b, "j int, x1 double, y1 double, x2 double, y2 double")
    lb = lb.withColumn("g", G.envelope("x1", "y1", "x2", "y2")).select("j", G.shape("g", general=True).alias("shape"))
    got = spatial_join(la, lb, cell=7.0, with_overlap=True).collect()
    assert {(r["i"], r["j"]) for r in got} == brute(a, b)
    ref = {(i, j): max(0, min(ax2, bx2) - max(ax1, bx1)) * max(0, min(ay2, by2) - max(ay1, by1))
           for i, ax1, ay1, ax2, ay2 in a for j, bx1, by1, bx2, by2 in b}
    for r in got:
        assert r["overlap_m2"] == ref[(r["i"], r["j"])]


def test_overlay_helpers(spark):
    rnd = random.Random(11)
    a, b = rects(rnd, 60, 40, 10), rects(rnd, 90, 40, 5)
    la, lb = layer(spark, a, "i"), layer(spark, b, "j")
    pairs = brute(a, b)
    s = {r["i"]: r["s"] for r in overlap_sum(la, "i", lb, "s", cell=8.0).collect()}
    f = {r["i"]: r["f"] for r in exists_flag(la, "i", lb, "f", cell=8.0).collect()}
    n = {r["i"]: r["n"] for r in hit_count(la, "i", lb, "n", cell=8.0).collect()}
    bb = {j: (x1, y1, x2, y2) for j, x1, y1, x2, y2 in b}
    for i, ax1, ay1, ax2, ay2 in a:
        js = [j for (ii, j) in pairs if ii == i]
        assert n[i] == len(js) and f[i] == bool(js)
        exp = sum(max(0, min(ax2, bb[j][2]) - max(ax1, bb[j][0])) * max(0, min(ay2, bb[j][3]) - max(ay1, bb[j][1]))
                  for j in js)
        assert s[i] == pytest.approx(exp)


def test_hot_cell_of_stacked_copies(spark):
    """A third of one side is stacked copies in one cell: result stays whole."""
    a = [(i, 0.0, 0.0, 2.0, 2.0) for i in range(100)] + [(100 + i, 5.0 * i, 10.0, 5.0 * i + 1, 11.0) for i in range(200)]
    b = [(0, 1.0, 1.0, 3.0, 3.0), (1, 7.0, 10.0, 8.0, 10.5)]
    got = spatial_join(layer(spark, a, "i"), layer(spark, b, "j"), cell=4.0).count()
    assert got == len(brute(a, b)) == 100


def test_adjacency_of_stacked_boxes(spark):
    """20,000 parcels stacked in one cell: copies of two boxes, one beside the other, and one far away."""
    from landlens.plans import parcels as P
    rows = spark.range(20000).select(
        F.concat(F.lit("P"), F.col("id")).alias("pkey"), F.concat(F.lit("P"), F.col("id")).alias("egrid"), F.lit("u").alias("primary_use"), F.lit(True).alias("is_building_zone"),
        F.when(F.col("id") < 10000, 0.0).when(F.col("id") < 19999, 10.25).otherwise(40.0).alias("x"))
    rows = rows.withColumn("_x2", F.col("x") + 10).withColumn("_y", F.lit(0.0)).withColumn("_y2", F.lit(10.0))
    df = G.mark_rect_only(rows.withColumn("shape", G.shape_from_box("x", "_y", "_x2", "_y2")).select("pkey", "egrid", "primary_use", "is_building_zone", "shape"))
    got = {r["pkey"] for r in P.adjacency(df).collect()}
    assert got == {f"P{i}" for i in range(19999)}
