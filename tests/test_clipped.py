"""Shapes cut along cells: areas and pairs against closed forms and whole-shape evaluation."""

import random

import numpy as np
import pytest
from landlens.functions import geometry as G
from landlens.operators import clipped as C
from landlens.operators import pairs as P
from pyspark.sql import functions as F


def segs_of(*rings):
    """Oriented edges: the first ring counter-clockwise, the others clockwise."""
    out = []
    for k, ring in enumerate(rings):
        n = len(ring)
        area = sum(ring[i][0] * ring[(i + 1) % n][1] - ring[(i + 1) % n][0] * ring[i][1] for i in range(n))
        ring = ring if (area > 0) == (k == 0) else ring[::-1]
        out += [(*ring[i], *ring[(i + 1) % n]) for i in range(n)]
    return np.array(out, float)


def shoelace(segs):
    return float((segs[:, 0] * segs[:, 3] - segs[:, 2] * segs[:, 1]).sum() / 2)


def square(x, y, w, h):
    return [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]


COMB = [(0, 0), (64, 0), (64, 40), (56, 40), (56, 8), (40, 8), (40, 40), (32, 40), (32, 8), (8, 8), (8, 40), (0, 40)]
SLANT = [(-31.5, 2.25), (40.75, -20.5), (70.25, 33.0), (12.0, 18.5), (-8.25, 55.75)]


@pytest.mark.parametrize("rings", [[COMB], [SLANT], [square(-5, -5, 100, 90), square(10, 10, 20, 30), square(50, 3, 30, 70)], [square(1, 1, 3, 3)], [square(0, 0, 64, 48)]])
@pytest.mark.parametrize("cell", [4.0, 7.0, 16.0, 1000.0])
def test_pieces_add_up(rings, cell):
    segs, area, seen = segs_of(*rings), 0.0, set()
    for columns, rows, piece, edges in C.cut(segs, cell):
        cells = set(zip(columns.tolist(), rows.tolist()))
        assert not cells & seen
        seen |= cells
        if piece is None:
            area += len(cells) * cell * cell
        else:
            (x, y), = cells
            assert (piece[:, [0, 2]] >= x * cell).all() and (piece[:, [0, 2]] <= (x + 1) * cell).all()
            assert (piece[:, [1, 3]] >= y * cell).all() and (piece[:, [1, 3]] <= (y + 1) * cell).all()
            area += C._area(piece, y * cell)
            inside = ((segs[:, [0, 2]].min(1) <= (x + 1) * cell) & (segs[:, [0, 2]].max(1) >= x * cell) & (segs[:, [1, 3]].min(1) <= (y + 1) * cell) & (segs[:, [1, 3]].max(1) >= y * cell))
            assert {tuple(e) for e in edges} <= {tuple(e) for e in segs[inside]}
    assert area == pytest.approx(shoelace(segs), rel=1e-12)


def test_a_wide_shape_costs_edges_and_cells():
    """20 km, 400 vertices, cells of 50 m: pieces with edges stay in the order of the outline."""
    angle = np.linspace(0, 2 * np.pi, 400, endpoint=False)
    ring = [(10000 + 10000 * np.cos(a), 10000 + (9000 + 1000 * np.cos(7 * a)) * np.sin(a)) for a in angle]
    segs, full, rows, carried, area = segs_of(ring), 0, 0, 0, 0.0
    for columns, lines, piece, edges in C.cut(segs, 50.0):
        if piece is None:
            full += len(columns)
            area += len(columns) * 2500.0
        else:
            rows += 1
            carried += len(piece) + len(edges)
            area += C._area(piece, float(lines[0]) * 50.0)
    assert area == pytest.approx(shoelace(segs), rel=1e-9)
    assert full > 100_000 and rows < 2500 and carried < 10 * rows


def frame(spark, rows):
    point = lambda x, y: {"x": float(x), "y": float(y)}
    geom = [(k, [[[point(*p) for p in [*r, r[0]]] for r in part] for part in parts]) for k, parts in rows]
    return spark.createDataFrame(geom, f"k int, g {G.GEOM_T}").select("k", G.shape("g").alias("shape"))


def shapes(rng, n, span):
    out = []
    for k in range(n):
        x, y, s = rng.randint(-span * 4, span * 4) / 4, rng.randint(-span * 4, span * 4) / 4, rng.choice([1, 1, 4, 16]) / 4
        at = lambda ring: [(x + a * s, y + b * s) for a, b in ring]  # noqa: E731, B023
        kind = k % 5
        parts = {0: [[at(COMB)]], 1: [[at(SLANT)]], 2: [[at(square(0, 0, 40, 30)), at(square(8, 8, 16, 12))]], 3: [[at(square(0, 0, 24, 16))]],
                 4: [[at(square(0, 0, 12, 12))], [at([(20, 0), (32, 4), (24, 16)])]]}[kind]
        out.append((k, parts))
    return out


@pytest.mark.parametrize("cell", [8.0, 64.0])
def test_pairs_equal_whole_shapes(spark, cell):
    rng = random.Random(int(cell))
    a, b = frame(spark, shapes(rng, 40, 60)), frame(spark, shapes(rng, 45, 60) + [(900, [[square(-500, -500, 1000, 1000), square(-30, -30, 60, 50)]]), (901, [[square(-400, -400, 1, 1)]])])
    got = {(r["i"], r["j"]): r["overlap_m2"] for r in C.clipped_pairs(a.withColumnRenamed("k", "i"), b.withColumnRenamed("k", "j"), "i", "j", cell).collect()}
    joined = a.select(F.col("k").alias("i"), F.col("shape").alias("p")).crossJoin(b.select(F.col("k").alias("j"), F.col("shape").alias("q")))
    want = {(r["i"], r["j"]): r["o"] for r in joined.where(F.expr(G.intersects_sql("p", "q"))).select("i", "j", F.expr(G.overlap_area_sql("p", "q")).alias("o")).collect()}
    assert set(got) == set(want) and len(want) > 100
    assert all(got[k] == pytest.approx(want[k], rel=1e-9, abs=1e-6) for k in want)


def test_touching_and_holes(spark):
    frame_shape = [[square(0, 0, 100, 100), square(20, 20, 60, 60)]]
    a = frame(spark, [(1, frame_shape)]).withColumnRenamed("k", "i")
    b = frame(spark, [(1, [[square(30, 30, 10, 10)]]), (2, [[square(20, 30, 10, 10)]]), (3, [[square(100, 50, 5, 5)]]), (4, [[square(100.25, 50, 5, 5)]]), (5, [[square(2, 2, 3, 3)]]),
                      (6, [[[(100, 100), (110, 105), (105, 110)]]])]).withColumnRenamed("k", "j")
    got = {r["j"]: r["overlap_m2"] for r in C.clipped_pairs(a, b, "i", "j", 16.0).collect()}
    assert got == {2: 0.0, 3: 0.0, 5: 9.0, 6: 0.0}


def test_touching_on_cell_lines(spark):
    """Corners that meet exactly where cells meet."""
    a = frame(spark, [(1, [[[(0, 0), (32, 16), (0, 32)]]]), (2, [[[(64, 0), (80, 16), (64, 32), (48, 16)]]])]).withColumnRenamed("k", "i")
    b = frame(spark, [(k, [[square(x, y, w, h)]]) for k, (x, y, w, h) in enumerate([(-16, -16, 16, 16), (-16, 32, 16, 16), (32, 16, 16, 16), (32, 0, 16, 16), (80, 16, 16, 16), (64, 32, 5, 5), (64, -16, 16, 16), (81, 16, 9, 9)])])
    got = {(r["i"], r["j"]): r["overlap_m2"] for r in C.clipped_pairs(a, b.withColumnRenamed("k", "j"), "i", "j", 16.0).collect()}
    assert got == dict.fromkeys([(1, 0), (1, 1), (1, 2), (1, 3), (2, 2), (2, 3), (2, 4), (2, 5), (2, 6)], 0.0)


def test_points_by_edges_above():
    import pyarrow as pa
    rng = random.Random(1)
    segs = segs_of(COMB)
    points = [{"x": rng.uniform(-5, 70), "y": rng.uniform(-5, 45)} for _ in range(300)]
    column, b = pa.array([[p] for p in points]), (np.full(300, len(segs)), np.arange(300) * len(segs), np.tile(segs, (300, 1)))
    assert (P._under(column, b) == P._inside(column, b)).all()
