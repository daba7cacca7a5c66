"""Which shapes have a neighbour: an early-stopping semi join by distance.

A shape counts as soon as one other shape of its class comes within the distance without lying inside it; which one does not matter. Rectangles
are settled by a left semi join on closed-form expressions. What is left, and every shape that is not a rectangle, meets the shapes of its
grid cells in Arrow batches: each round evaluates a few candidates of every undecided shape at once (operators.pairs), and
decided shapes take no part in the next.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from . import grid as grids
from . import pairs

#: Candidates of a shape in the first round; twice as many in each further one.
FIRST_ROUND = 2
_BOX = ("xmin", "ymin", "xmax", "ymax")


def with_neighbour(shapes: DataFrame, key: str, on: str, distance: float, cell: float, shape: str = "shape", split_above: int | None = grids.LIMIT) -> DataFrame:
    """The ``key`` values of ``shapes`` (unique; class in ``on``) that another shape of the class comes within ``distance`` of and that do not contain it."""
    rect_only = G.is_rect_only(shapes, shape)
    grid = grids.build(shapes, shapes, shape, shape, cell, distance, split_above)
    slim = shapes.select(F.col(key).alias("_a"), F.col(on).alias("_ua"), F.col(shape).alias("_ls"))
    other = shapes.select(F.col(key).alias("_b"), F.col(on).alias("_ub"), F.col(shape).alias("_rs"))
    boxes = lambda df, s: df if rect_only else df.where(F.expr(G._all_rect(s)))
    narrow = lambda df, s: boxes(df, s).withColumn(s, G.slim(s))
    a, b = grid.place(narrow(slim, "_ls"), "_ls", True), grid.place(narrow(other, "_rs"), "_rs", False)
    b = b.withColumnsRenamed({k: f"{k}_b" for k in grid.keys})
    same = " AND ".join(f"{k} = {k}_b" for k in grid.keys)
    beside = F.expr(f"_ua = _ub AND {same} AND _a <> _b AND {G.bbox_intersects_sql('_ls', '_rs', distance)}"
                    f" AND {G.dwithin_sql('_ls', '_rs', distance, True)} AND NOT {G.contains_sql('_ls', '_rs', True)}")
    found = a.join(b, beside, "left_semi").select(F.col("_a").alias(key)).distinct()
    if rect_only:
        return found
    # undecided rectangles against the other shapes, the other shapes against all
    undecided = slim.join(found.withColumnRenamed(key, "_a"), "_a", "left_anti")
    general = F.expr(f"NOT {G._all_rect('_s')}")
    plain = lambda df, k, u, s: df.select(F.col(k).alias("_k"), F.col(u).alias("_u"), F.col(s).alias("_s"))
    left = _flat(grid.place(plain(undecided, "_a", "_ua", "_ls"), "_s", True), grid.keys, general)
    right = _flat(grid.place(plain(other, "_b", "_ub", "_rs"), "_s", False), grid.keys, general)
    key_type = shapes.schema[key].dataType.simpleString()
    near = left.groupBy(*grid.keys, "_u").cogroup(right.groupBy(*grid.keys, "_u")).applyInArrow(_decide(distance), f"_k {key_type}")
    return found.unionByName(near.select(F.col("_k").alias(key))).distinct()


def _flat(df: DataFrame, keys: list[str], general) -> DataFrame:
    return df.select(*keys, "_u", "_k", *[F.col(f"_s.{c}").alias(c) for c in _BOX], F.col("_s.area").alias("area"), general.alias("general"),
                     F.expr(G._segs_of("_s")).alias("segs"), F.expr(G._probes_of("_s")).alias("probes"))


def _numpy(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).combine_chunks().to_numpy(zero_copy_only=False)


def _decide(distance: float):
    def run(left, right):
        keys = left.column("_k").combine_chunks() if left.num_rows else left.column("_k").cast(left.schema.field("_k").type).combine_chunks()
        hit = np.zeros(left.num_rows, bool)
        if left.num_rows and right.num_rows:
            for i, j in _rounds(left, right, distance, hit):
                take = lambda t, name, at: t.column(name).combine_chunks().take(pa.array(at))
                sa, sb = take(left, "segs", i), take(right, "segs", j)
                near = np.asarray(pairs._near_batch(sa, sb, take(left, "probes", i), take(right, "probes", j), distance))
                k = np.flatnonzero(near)
                if len(k):  # a shape that lies inside does not count
                    area = _numpy(right, "area")[j[k]]
                    common = np.asarray(pairs._overlap_batch(sa.take(pa.array(k)), sb.take(pa.array(k))))
                    beside = ~((area > 0) & (common >= area - 1e-9 * np.maximum(area, 1)))
                    hit[i[k[beside]]] = True
        return pa.table({"_k": keys.filter(pa.array(hit))})

    return run


def _rounds(left: pa.Table, right: pa.Table, distance: float, hit: np.ndarray):
    """Candidate pairs, box against box, a few a round for every left row not yet hit."""
    la, rb = ([_numpy(t, c) for c in _BOX] for t in (left, right))
    general_a, general_b = _numpy(left, "general"), _numpy(right, "general")
    own, others = left.column("_k").to_pylist(), right.column("_k").to_pylist()
    order = np.argsort(rb[0], kind="stable")
    low = rb[0][order]
    reach = np.maximum.accumulate(rb[2][order])  # the farthest right end so far
    ranges = np.stack([np.searchsorted(reach, la[0] - distance), np.searchsorted(low, la[2] + distance, side="right")], axis=1)
    at, step = ranges[:, 0].copy(), FIRST_ROUND
    while True:
        open_ = np.flatnonzero(~hit & (at < ranges[:, 1]))
        if not len(open_):
            return
        n = np.minimum(ranges[open_, 1] - at[open_], step)
        i = np.repeat(open_, n)
        j = order[np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(at[open_], n)]
        at[open_] += n
        step *= 2
        keep = (general_a[i] | general_b[j]) & (la[0][i] - distance <= rb[2][j]) & (rb[0][j] <= la[2][i] + distance) & (la[1][i] - distance <= rb[3][j]) & (rb[1][j] <= la[3][i] + distance)
        i, j = i[keep], j[keep]
        keep = np.fromiter((own[x] != others[y] for x, y in zip(i.tolist(), j.tolist())), bool, len(i))
        if keep.any():
            yield i[keep], j[keep]
