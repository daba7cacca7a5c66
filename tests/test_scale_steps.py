"""Joins of rows that are copied by cell: never a broadcast, and the same pairs."""

from landlens.functions import geometry as G
from landlens.operators.clipped import clipped_pairs
from landlens.operators.overlay import any_hit, overlay_summary
from landlens.operators.spatial_join import spatial_join
from pyspark.sql import functions as F


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def squares(spark, key, n, rect=True):
    """n squares in a row; with ``rect`` False every third one is a triangle."""
    rows = spark.range(n).withColumns({"_x": F.col("id") * 40.0, key: F.col("id").cast("string")})
    boxes = rows.withColumn("shape", G.shape_from_box("_x", "0", "_x + 100", "100")).select(key, "shape")
    if rect:
        return G.mark_rect_only(boxes)
    tri = rows.withColumn("g", F.expr("array(array(array(named_struct('x', _x, 'y', 0D), named_struct('x', _x + 100, 'y', 0D), named_struct('x', _x, 'y', 100D), named_struct('x', _x, 'y', 0D))))"))
    third = F.col(key).cast("bigint") % 3 == 0
    return boxes.where(~third).unionByName(tri.where(third).select(key, G.shape("g").alias("shape")))


def test_joins_of_copied_rows_never_broadcast(spark):
    """A row goes to every cell it covers, so the planner's size of a side is far from what a broadcast would hold in the driver."""
    a, b = squares(spark, "a", 30), squares(spark, "b", 20)
    assert "BroadcastHashJoin" not in plan(spatial_join(a, b.withColumnRenamed("shape", "s"), right_shape="s", with_overlap=True, cell=64.0))
    mixed = squares(spark, "b", 20, rect=False)
    assert "BroadcastHashJoin" not in plan(clipped_pairs(a, mixed, "a", "b", 64.0))
    p = plan(overlay_summary(a, "a", {"x": mixed}, [any_hit("x", "hit")], cell=64.0, join_back=False))
    assert "BroadcastHashJoin" not in p


def test_unfolded_boxes_give_the_same_pairs(spark):
    """Rectangles against triangles, on either side: areas in closed form."""
    a, mixed = squares(spark, "a", 12), squares(spark, "b", 12, rect=False)
    want = {}
    for i in range(12):
        for j in range(12):
            lo, hi, x = max(i, j) * 40, min(i, j) * 40 + 100, j * 40
            if lo <= hi:
                under = lambda t: 100 * (t - x) - (t - x) ** 2 / 2  # noqa: E731  below the hypotenuse, up to t
                want[str(i), str(j)] = under(hi) - under(lo) if j % 3 == 0 else (hi - lo) * 100.0
    got = {(r["a"], r["b"]): r["overlap_m2"] for r in clipped_pairs(a, mixed, "a", "b", 64.0).collect()}
    back = {(r["a"], r["b"]): r["overlap_m2"] for r in clipped_pairs(mixed, a, "b", "a", 64.0).collect()}
    assert got.keys() == want.keys() == back.keys()
    assert all(abs(got[k] - v) < 1e-6 and abs(back[k] - v) < 1e-6 for k, v in want.items())
