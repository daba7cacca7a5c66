"""Rings that cross themselves: crossings, loops and areas."""

import time

import numpy as np
import pytest
from landlens.operators import repair as R
from landlens.sources import geojson as J
from pyspark.sql import functions as F


def close(points):
    return np.array([*points, points[0]], float)


def areas(parts):
    return sorted(round(abs(R._area(p[0])) - sum(abs(R._area(h)) for h in p[1:]), 9) for p in parts)


def test_crossings_equal_all_pairs():
    rng = np.random.default_rng(1)
    for n in (2, 20, 90):
        for _ in range(40):
            e = rng.integers(0, 40, (n, 4)).astype(float)
            e[n // 2:] += rng.random((n - n // 2, 4))
            i, j = np.triu_indices(n, 1)
            assert (R.crossings(e) == np.stack([i, j], axis=1)[R._cross(e[i], e[j])]).all()


def test_closed_forms():
    assert areas(R.uncrossed([close([(0, 0), (10, 10), (10, 0), (0, 10)])])) == [25, 25]
    assert areas(R.uncrossed([close([(0, 0), (8, 6), (16, 0), (16, 6), (8, 0), (0, 6)])])) == [12, 12, 24]  # two crossings
    turn = np.arange(5) * 4 * np.pi / 5
    star = R.uncrossed([close(np.stack([np.cos(turn), np.sin(turn)], axis=1))])
    inner = np.cos(2 * np.pi / 5) / np.cos(np.pi / 5)
    tips = 5 * (np.sin(np.pi / 5) * inner - np.sin(2 * np.pi / 5) / 2 * inner ** 2)
    assert len(star) == 1 and len(star[0]) == 2 and areas(star)[0] == pytest.approx(tips)
    # two overlapping squares in one part: the common square counts twice, so it is a hole
    assert areas(R.uncrossed([close([(0, 0), (4, 0), (4, 4), (0, 4)]), close([(2, 2), (6, 2), (6, 6), (2, 6)])])) == [24]
    # a hole that crosses itself becomes two holes
    got = R.uncrossed([close([(0, 0), (20, 0), (20, 20), (0, 20)]), close([(5, 5), (15, 15), (15, 5), (5, 15)])])
    assert len(got) == 1 and len(got[0]) == 3 and areas(got) == [350]
    assert R.uncrossed([close([(0, 0), (4, 0), (4, 4), (2, 0), (0, 4)])]) is None  # touches itself


def test_ten_thousand_vertices_in_seconds():
    t = np.linspace(0, 2 * np.pi, 10_000, endpoint=False)
    began = time.time()
    assert R.uncrossed([close(np.stack([100 * np.cos(t) + 5 * np.cos(40 * t), 100 * np.sin(t)], axis=1))]) is None
    k = 7  # lobes of a figure that crosses itself k - 1 times on its axis
    got = R.uncrossed([close(np.stack([100 * np.cos(t + 0.0001), 50 * np.sin(k * (t + 0.0001))], axis=1))])
    assert got is not None and sum(len(p) - 1 for p in got) >= 0
    spikes = [(x, 0 if x % 2 else 1000) for x in range(2500)] + [(x, 1 if x % 2 else 1001) for x in range(2499, -1, -1)]
    assert R.uncrossed([close(spikes)]) is None
    assert time.time() - began < 30


def test_screen_repairs_and_keeps(spark):
    def poly(*rings):
        text = ",".join("[" + ",".join(f"[{x + 1000},{y}]" for x, y in r) + "]" for r in rings)
        return f'{{"type":"Polygon","coordinates":[{text}]}}'
    rows = [("bow", poly([(0, 0), (10, 10), (10, 0), (0, 10), (0, 0)])), ("twice", poly([(0, 0), (8, 6), (16, 0), (16, 6), (8, 0), (0, 6), (0, 0)])),
            ("fine", poly([(0, 0), (9, 0), (9, 9), (5, 4), (0, 9), (0, 0)])), ("box", poly([(0, 0), (9, 0), (9, 9), (0, 9), (0, 0)])),
            ("holed", poly([(0, 0), (20, 0), (20, 20), (0, 20), (0, 0)], [(5, 5), (15, 15), (15, 5), (5, 15), (5, 5)])), ("flat", poly([(0, 0), (5, 5), (9, 9), (0, 0)]))]
    raw = spark.createDataFrame(rows, "id string, geometry string").withColumn("properties", F.create_map().cast("map<string,string>"))
    got = {r["id"]: r for r in J.to_features(raw.withColumn("geom", J.geometry("geometry"))).select("id", "status", "reason", "shape.area", "shape.nparts").collect()}
    assert {k: (r["status"], r["area"], r["nparts"]) for k, r in got.items()} == {
        "bow": ("repaired", 50.0, 2), "twice": ("repaired", 48.0, 3), "fine": ("ok", 58.5, 1), "box": ("ok", 81.0, 1), "holed": ("repaired", 350.0, 1), "flat": ("rejected", None, None)}
    assert got["flat"]["reason"] == "zero-area ring"
