"""General-polygon path (edge-pair overlap, segment predicates) against an
independent reference: for rectilinear polygons with integer vertices the
overlap area equals the number of unit cells whose centre lies in both."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from landlens.functions import geometry as G

# polygons as lists of parts; part = list of rings; ring = list of (x, y), open
SHAPES = {
    "square": [[[(0, 0), (6, 0), (6, 6), (0, 6)]]],
    "L": [[[(0, 0), (8, 0), (8, 3), (3, 3), (3, 8), (0, 8)]]],
    "U_cw": [[[(1, 1), (1, 7), (3, 7), (3, 3), (6, 3), (6, 7), (8, 7), (8, 1)]]],   # clockwise input
    "donut": [[[(0, 0), (9, 0), (9, 9), (0, 9)], [(3, 3), (3, 6), (6, 6), (6, 3)]]],
    "two": [[[(10, 0), (12, 0), (12, 2), (10, 2)]], [[(0, 10), (3, 10), (3, 12), (0, 12)]]],
    "bar": [[[(2, -1), (4, -1), (4, 11), (2, 11)]]],
    "far": [[[(30, 30), (31, 30), (31, 31), (30, 31)]]],
    "touch": [[[(6, 0), (7, 0), (7, 6), (6, 6)]]],
}


def _inside(px, py, parts):
    for part in parts:
        c = 0
        for ring in part:
            n = len(ring)
            for i in range(n):
                (x1, y1), (x2, y2) = ring[i], ring[(i + 1) % n]
                if (y1 > py) != (y2 > py) and px < x1 + (py - y1) * (x2 - x1) / (y2 - y1):
                    c += 1
        if c % 2:
            return True
    return False


def ref_overlap(a, b):
    pts = [p for part in a + b for ring in part for p in ring]
    xs, ys = [p[0] for p in pts], [p[1] for p in pts]
    return sum(1 for x in range(min(xs), max(xs)) for y in range(min(ys), max(ys))
               if _inside(x + .5, y + .5, a) and _inside(x + .5, y + .5, b))


def geom(parts):
    """Python value of a closed multipolygon (data, never SQL literals)."""
    return [[[{"x": float(x), "y": float(y)} for x, y in list(r) + [r[0]]] for r in part] for part in parts]


def frame(spark, **geoms):
    names = list(geoms)
    schema = ", ".join(f"{n} {G.GEOM_T}" for n in names)
    return spark.createDataFrame([tuple(geom(geoms[n]) for n in names)], schema)


@pytest.fixture(scope="module")
def pairs(spark):
    names = sorted(SHAPES)
    rows = [(a, b, geom(SHAPES[a]), geom(SHAPES[b])) for a, b in itertools.product(names, names)]
    df = spark.createDataFrame(rows, f"a string, b string, ga {G.GEOM_T}, gb {G.GEOM_T}")
    df = df.withColumn("sa", G.shape("ga", general=True)).withColumn("sb", G.shape("gb", general=True))
    out = df.select("a", "b", F.expr(G.overlap_area_sql("sa", "sb")).alias("ov"),
                    F.expr(G.intersects_sql("sa", "sb")).alias("hit"),
                    F.expr(G.dwithin_sql("sa", "sb", 1.0)).alias("near"),
                    F.expr(G.contains_sql("sa", "sb")).alias("contains"),
                    G.area("ga").alias("area_a"))
    return {(r["a"], r["b"]): r for r in out.collect()}


def test_area(pairs):
    for n, parts in SHAPES.items():
        assert pairs[(n, n)]["area_a"] == ref_overlap(parts, parts), n


def test_overlap_matches_cell_count(pairs):
    for (a, b), r in pairs.items():
        assert r["ov"] == pytest.approx(ref_overlap(SHAPES[a], SHAPES[b]), abs=1e-9), (a, b)


def test_overlap_symmetric_and_bounded(pairs):
    for (a, b), r in pairs.items():
        assert r["ov"] == pytest.approx(pairs[(b, a)]["ov"], abs=1e-9)
        assert r["ov"] <= min(pairs[(a, a)]["area_a"], pairs[(b, b)]["area_a"]) + 1e-9


def test_predicates(pairs):
    assert pairs[("square", "touch")]["hit"] and pairs[("square", "touch")]["ov"] == 0  # closed: touching counts
    assert not pairs[("square", "far")]["hit"] and not pairs[("square", "far")]["near"]
    assert pairs[("donut", "square")]["hit"]
    assert not pairs[("square", "two")]["hit"] and not pairs[("square", "two")]["near"]
    assert pairs[("square", "two")]["ov"] == 0
    assert pairs[("L", "U_cw")]["hit"]
    for (a, b), r in pairs.items():
        if r["ov"] > 0:
            assert r["hit"] and r["near"], (a, b)
        assert r["hit"] == pairs[(b, a)]["hit"]
    assert pairs[("square", "square")]["contains"]
    assert not pairs[("square", "bar")]["contains"] and not pairs[("donut", "square")]["contains"]


def test_hole_excludes_inner_point(spark):
    hole = [[[(0, 0), (9, 0), (9, 9), (0, 9)], [(3, 3), (3, 6), (6, 6), (6, 3)]]]
    inner = [[[(4, 4), (5, 4), (5, 5), (4, 5)]]]
    r = frame(spark, g1=hole, g2=inner).select(
        G.shape("g1").alias("s1"), G.shape("g2", general=True).alias("s2")).select(
        F.expr(G.intersects_sql("s1", "s2")).alias("hit"), F.expr(G.dwithin_sql("s1", "s2", 1.0)).alias("d1"),
        F.expr(G.dwithin_sql("s1", "s2", 0.9)).alias("d09")).first()
    assert r["hit"] is False and r["d1"] is True and r["d09"] is False


def test_triangles(spark):
    df = frame(spark, t=[[[(0, 0), (4, 0), (0, 4)]]], s=[[[(0, 0), (2, 0), (2, 2), (0, 2)]]],
               p=[[[(1, 0), (3, 0), (3, 1), (1, 1)]]], c=[[[(3, 3), (5, 3), (5, 5), (3, 5)]]]).select(
        G.shape("t").alias("t"), G.shape("s").alias("s"), G.shape("p").alias("p"), G.shape("c").alias("c"))
    r = df.select(F.expr(G.overlap_area_sql("t", "s")).alias("ts"), F.expr(G.overlap_area_sql("t", "p")).alias("tp"),
                  F.expr(G.intersects_sql("t", "c")).alias("tc"), F.expr("t.area").alias("area"),
                  F.expr(G.dwithin_sql("t", "c", 1.5)).alias("near"),
                  F.expr(G.dwithin_sql("t", "c", 1.4)).alias("not_near")).first()
    assert r["area"] == 8 and r["ts"] == pytest.approx(4) and r["tp"] == pytest.approx(2)
    assert r["tc"] is False and r["near"] is True and r["not_near"] is False   # gap = sqrt(2)


def test_rect_fast_path_equals_general(spark):
    rnd = random.Random(7)
    rows = []
    for _ in range(300):
        a = (rnd.randint(0, 40) / 4, rnd.randint(0, 40) / 4)
        b = (rnd.randint(0, 40) / 4, rnd.randint(0, 40) / 4)
        rows.append((a[0], a[1], a[0] + rnd.randint(1, 20) / 4, a[1] + rnd.randint(1, 20) / 4,
                     b[0], b[1], b[0] + rnd.randint(1, 20) / 4, b[1] + rnd.randint(1, 20) / 4))
    df = spark.createDataFrame(rows, "ax1 double, ay1 double, ax2 double, ay2 double, "
                                     "bx1 double, by1 double, bx2 double, by2 double")
    df = (df.withColumn("fa", G.shape_from_box("ax1", "ay1", "ax2", "ay2"))
          .withColumn("fb", G.shape_from_box("bx1", "by1", "bx2", "by2"))
          .withColumn("ga", G.envelope("ax1", "ay1", "ax2", "ay2")).withColumn("gb", G.envelope("bx1", "by1", "bx2", "by2"))
          .withColumn("sa", G.shape("ga", general=True)).withColumn("sb", G.shape("gb", general=True)))
    out = df.select(F.expr(G.overlap_area_sql("fa", "fb", True)).alias("o1"), F.expr(G.overlap_area_sql("sa", "sb")).alias("o2"),
                    F.expr(G.intersects_sql("fa", "fb", True)).alias("i1"), F.expr(G.intersects_sql("sa", "sb")).alias("i2"),
                    F.expr(G.dwithin_sql("fa", "fb", 0.5, True)).alias("d1"), F.expr(G.dwithin_sql("sa", "sb", 0.5)).alias("d2"))
    for r in out.collect():
        assert r["o1"] == r["o2"] and r["i1"] == r["i2"] and r["d1"] == r["d2"]


def test_wgs84_to_lv95_reference_point(spark):
    # published worked example of the approximate formulas:
    # 46deg02'38.87"N 8deg43'49.79"E -> E 2 699 999.76, N 1 099 999.97
    lon, lat = 8 + 43 / 60 + 49.79 / 3600, 46 + 2 / 60 + 38.87 / 3600
    g = [[[(lon, lat), (lon + 0.001, lat), (lon + 0.001, lat + 0.001)]]]
    r = frame(spark, g=g).select(G.to_lv95("g").alias("h")).select(
        F.expr("h[0][0][0].x").alias("x"), F.expr("h[0][0][0].y").alias("y")).first()
    assert r["x"] == pytest.approx(2699999.76, abs=0.05) and r["y"] == pytest.approx(1099999.97, abs=0.05)


def test_batches_agree_with_expressions(spark):
    """Random stars, holes and boxes: the Arrow batches of operators.pairs against the SQL expressions."""
    import math
    import random

    from landlens.operators import pairs as PAIR

    rng = random.Random(7)

    def star(cx, cy):
        n = rng.randint(3, 9)
        pts = [(cx + rng.uniform(2, 9) * math.cos(2 * math.pi * k / n), cy + rng.uniform(2, 9) * math.sin(2 * math.pi * k / n)) for k in range(n)]
        return [{"x": x, "y": y} for x, y in [*pts, pts[0]]]

    def box(cx, cy, r):
        return [{"x": cx + x * r, "y": cy + y * r} for x, y in ((-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1))]

    def geom():
        cx, cy = rng.uniform(0, 25), rng.uniform(0, 25)
        return rng.choice([lambda: [[star(cx, cy)]], lambda: [[star(cx, cy)], [star(cx + 30, cy)]], lambda: [[box(cx, cy, 6), box(cx, cy, 3)]], lambda: [[box(cx, cy, 4)]]])()
    kind = "array<array<array<struct<x:double,y:double>>>>"
    df = spark.createDataFrame([(i, geom(), geom()) for i in range(300)], f"id int, g {kind}, h {kind}").repartition(3)
    df = df.select("id", G.shape("g", general=True).alias("a"), G.shape("h", general=True).alias("b"))
    df = df.withColumns({"sa": F.expr(G._segs_of("a")), "sb": F.expr(G._segs_of("b")), "pa": F.expr(G._probes_of("a")), "pb": F.expr(G._probes_of("b"))})
    sa, sb, pa_, pb = (F.col(c) for c in ("sa", "sb", "pa", "pb"))
    df = df.withColumns({"o2": PAIR.overlap(sa, sb), "m2": PAIR.near(sa, sb, pa_, pb), "d2": PAIR.near(sa, sb, pa_, pb, 2.0)})
    got = df.select("o2", "m2", "d2", F.expr(G.overlap_area_sql("a", "b")).alias("o"), F.expr(G._general_intersects("a", "b")).alias("m"), F.expr(G.dwithin_sql("a", "b", 2.0)).alias("d")).collect()
    assert len({r["m"] for r in got}) == 2
    for r in got:
        assert abs(r["o"] - r["o2"]) < 1e-7 and r["m"] == r["m2"] and r["d"] == r["d2"]
