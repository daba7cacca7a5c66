"""Cells cut by density, blocks of stacked rows, and the neighbour semi join."""

import random
from collections import Counter
from statistics import median

import pytest
from landlens.functions import geometry as G
from landlens.operators import grid as grids
from landlens.operators import nearby
from landlens.operators.spatial_join import spatial_join
from pyspark.sql import functions as F

from test_spatial_join import brute, layer


def clustered(rng, n, near, far):
    """Shapes of which most lie in a few small clusters, far denser than a cell."""
    out = []
    for i in range(n):
        x, y = (rng.choice(near) if i % 4 else (rng.uniform(0, far), rng.uniform(0, far)))
        x, y = x + rng.randint(0, 40) / 64, y + rng.randint(0, 40) / 64
        out.append((i, x, y, x + rng.randint(1, 8) / 64, y + rng.randint(1, 8) / 64))
    return out


@pytest.mark.parametrize("limit,distance", [(20, 0.0), (20, 0.3), (7, 0.0), (None, 0.0)])
def test_cut_cells_give_the_same_pairs(spark, limit, distance):
    rng = random.Random(limit or 1)
    near = [(3.0, 3.0), (-5.25, 17.5), (30.0, -2.0)]
    a, b = clustered(rng, 240, near, 60), clustered(rng, 260, near, 60) + [(1000 + i, -20.0, -20.0, 80.0, 80.0) for i in range(25)]
    predicate = {"predicate": "dwithin", "distance": distance} if distance else {}
    got = [(r["i"], r["j"]) for r in spatial_join(layer(spark, a, "i"), layer(spark, b, "j"), cell=16.0, split_above=limit, **predicate).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(a, b, distance)


def test_stacked_and_clustered_shapes_are_spread(spark):
    """20,000 shapes, half on top of each other, half in one cluster: no task holds more than 4 times the median."""
    rng = random.Random(2)
    a = [(i, 100.0, 100.0, 110.0, 110.0) for i in range(10000)]
    a += [(10000 + i, x, y, x + 0.25, y + 0.25) for i, (x, y) in enumerate((200 + rng.randint(0, 400) / 16, 300 + rng.randint(0, 400) / 16) for _ in range(10000))]
    b = [(i, 90.0 + i / 4, 105.0, 90.5 + i / 4, 105.5) for i in range(100)] + [(100 + i, 200 + i / 8, 300 + i / 8, 200.5 + i / 8, 300.5 + i / 8) for i in range(200)]
    la, lb = layer(spark, a, "i"), layer(spark, b, "j")
    limit = 400
    grid = grids.build(la, lb, "shape", "shape", 64.0, 0.0, limit)
    assert grid.splits and grid.stacks is not None
    held = grid.place(la, "shape", True).groupBy(*grid.keys).count().collect()
    assert max(r["count"] for r in held) <= 1.5 * limit
    before, conf = spark.conf.get("spark.sql.adaptive.enabled"), "spark.sql.adaptive.enabled"
    spark.conf.set(conf, "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        placed = grid.place(la, "shape", True).repartition(12, *grid.keys)
        tasks = [r["count"] for r in placed.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.set(conf, before)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(tasks) == 12 and max(tasks) <= 4 * median(tasks)
    got = spatial_join(la, lb, cell=64.0, split_above=limit).groupBy("i", "j").count().collect()
    assert all(r["count"] == 1 for r in got) and {(r["i"], r["j"]) for r in got} == brute(a, b)


def test_equal_points_end_in_blocks(spark):
    a, b = [(i, 5.0, 5.0, 5.0, 5.0) for i in range(300)], [(i, 5.0, 5.0, 5.0, 5.0) for i in range(90)]
    la, lb = layer(spark, a, "i"), layer(spark, b, "j")
    assert grids.build(la, lb, "shape", "shape", 16.0, 0.0, 50).stacks is not None
    got = Counter((r["i"], r["j"]) for r in spatial_join(la, lb, cell=16.0, split_above=50).collect())
    assert len(got) == 300 * 90 and set(got.values()) == {1}


def polygon(spark, rows):
    """(key, class, ring) -> shapes of concave rings."""
    df = spark.createDataFrame([(k, u, [[[{"x": float(x), "y": float(y)} for x, y in [*ring, ring[0]]]]]) for k, u, ring in rows], f"k int, u string, g {G.GEOM_T}")
    return df.select("k", "u", G.shape("g").alias("shape"))


def test_neighbours_of_concave_shapes(spark):
    """L, U and slanted shapes against the interpreted expressions, pair by pair."""
    rng = random.Random(8)
    forms = [lambda x, y: [(x, y), (x + 6, y), (x + 6, y + 2), (x + 2, y + 2), (x + 2, y + 6), (x, y + 6)],
             lambda x, y: [(x, y), (x + 6, y), (x + 6, y + 6), (x + 4, y + 6), (x + 4, y + 2), (x + 2, y + 2), (x + 2, y + 6), (x, y + 6)],
             lambda x, y: [(x, y), (x + 3, y + 1), (x + 1, y + 3)],
             lambda x, y: [(x, y), (x + 1, y), (x + 1, y + 1), (x, y + 1)]]
    rows = [(i, rng.choice("ab"), rng.choice(forms)(rng.randint(0, 160) / 4, rng.randint(0, 160) / 4)) for i in range(90)]
    rows += [(200, "a", forms[3](100, 100)), (201, "a", [(99, 99), (103, 99), (103, 103), (99, 103)])]  # 201 contains 200
    shapes = polygon(spark, rows)
    for limit in (grids.LIMIT, 12):
        got = sorted(r["k"] for r in nearby.with_neighbour(shapes, "k", "u", 0.5, 8.0, split_above=limit).collect())
        other = shapes.select(F.col("k").alias("k2"), F.col("u").alias("u2"), F.col("shape").alias("s2"))
        want = (shapes.join(other, F.expr(f"u = u2 AND k <> k2 AND {G.dwithin_sql('shape', 's2', 0.5)} AND NOT {G.contains_sql('shape', 's2')}")).select("k").distinct().collect())
        assert got == sorted(r["k"] for r in want) and 200 in got and 201 not in got
