"""A layer along the curve: the box filter reaches the scan and skips row groups."""

import random

import pyarrow.parquet as pq
from landlens.functions import geometry as G
from landlens.sources import layout as LY
from pyspark.sql import functions as F

from test_spatial_join import layer


def scan_metrics(df):
    """Rows that the file scan of an executed plan gave out, and the plan's text."""
    rows = df._jdf.queryExecution().executedPlan()
    todo, found = [rows], None
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        if "Scan" in node.getClass().getSimpleName() and node.metrics().contains("numOutputRows"):
            found = node.metrics().apply("numOutputRows").value()
        todo.extend(node.children().apply(k) for k in range(node.children().size()))
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return found, df._jdf.queryExecution().explainString(mode)


def test_box_filter_skips_row_groups(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, x, y, x + rng.randint(1, 60) / 4, y + rng.randint(1, 60) / 4) for i, (x, y) in enumerate((rng.randint(0, 40000) / 4, rng.randint(0, 40000) / 4) for _ in range(40000))]
    path = str(tmp_path / "layer")
    LY.write_layer(layer(spark, rows, "k"), path, (0.0, 0.0), files=6, group_bytes=64 << 10)
    groups = [pq.ParquetFile(p).metadata for p in (tmp_path / "layer").glob("*.parquet")]
    assert len(groups) == 6 and sum(m.num_row_groups for m in groups) >= 12
    box = (2000.0, 3000.0, 2400.0, 3300.0)
    got = LY.read_box(spark, path, *box, rect_only=True)
    assert {r["k"] for r in got.collect()} == {k for k, x1, y1, x2, y2 in rows if x1 <= box[2] and x2 >= box[0] and y1 <= box[3] and y2 >= box[1]}
    read, plan = scan_metrics(got)
    assert "LessThanOrEqual(xmin,2400.0)" in plan and "GreaterThanOrEqual(ymax,3000.0)" in plan
    hit = 0
    for m in groups:
        for g in range(m.num_row_groups):
            stat = {m.row_group(g).column(c).path_in_schema: m.row_group(g).column(c).statistics for c in range(m.num_columns)}
            hit += stat["xmin"].min <= box[2] and stat["xmax"].max >= box[0] and stat["ymin"].min <= box[3] and stat["ymax"].max >= box[1]
    assert hit < sum(m.num_row_groups for m in groups) / 3 and read < len(rows) / 3


def test_shapes_that_are_not_rectangles(spark, tmp_path):
    point = lambda x, y: {"x": float(x), "y": float(y)}
    ring = [(0, 0), (10, 0), (0, 10), (0, 0)]
    df = spark.createDataFrame([(1, [[[point(*p) for p in ring]]]), (2, None)], f"k int, g {G.GEOM_T}")
    df = df.select("k", F.when(F.col("g").isNotNull(), G.shape("g")).alias("shape"))
    path = str(tmp_path / "layer")
    LY.write_layer(df, path, (-5.0, -5.0), files=2)
    assert spark.read.parquet(path).count() == 2
    assert [r["k"] for r in LY.read_box(spark, path, 1, 1, 2, 2).collect()] == [1]
    assert LY.read_box(spark, path, 8, 8, 9, 9).count() == 0  # in the box, not in the triangle


def test_empty_layer(spark, tmp_path):
    LY.write_layer(layer(spark, [], "k"), str(tmp_path / "none"), (0.0, 0.0))
    assert LY.read_box(spark, str(tmp_path / "none"), 0, 0, 1, 1, rect_only=True).count() == 0


def test_curve_keeps_neighbours_together(spark):
    got = spark.createDataFrame([(x, y) for x in map(float, range(4)) for y in map(float, range(4))], "x double, y double").select("x", "y", LY.curve(F.col("x"), F.col("y"), 0.0, 0.0).alias("z")).collect()
    want = {(x, y): sum((x >> b & 1) << 2 * b | (y >> b & 1) << 2 * b + 1 for b in range(2)) for x in range(4) for y in range(4)}
    assert {(r["x"], r["y"]): r["z"] for r in got} == want
