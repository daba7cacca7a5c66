"""Pairs and overlap areas of polygons of any size, cell by cell.

A shape much larger than a grid cell must not be sent whole to every cell it covers. Here it is cut along the cells' lines: a
cell gets the edges that lie in it, and a cell inside the shape one row without edges. A shape of E edges over C cells costs
O(E + C) rows and bytes (times the depth of the cutting), whatever its extent. Pieces that meet in a cell give a part of the pair's overlap area and
whether the shapes meet there; one aggregation by pair sums the parts.

Cutting works on oriented edges (outer rings counter-clockwise), without rings: over the x-range of a cell, what lies above or below it is moved
onto its border, where opposite edges cancel. Upright edges bound no area over x and are left out there; the edge lists for
meeting tests hold whole edges, upright ones too.

Pairs of two rectangle shapes are closed-form expressions in the density-cut grid of operators.spatial_join.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from . import grid as grids
from . import pairs
from .spatial_join import spatial_join

_PIECE = f"_cx bigint, _cy bigint, segs array<{G.SEG_T}>, edges array<{G.SEG_T}>"
_SEG = pa.struct([(c, pa.float64()) for c in ("x1", "y1", "x2", "y2")])


def _at(s: np.ndarray, a: int, v: float) -> np.ndarray:
    """The other coordinate where segments cross the line (coordinate ``a``) = v."""
    b = 1 - a
    return s[:, b] + (v - s[:, a]) * (s[:, b + 2] - s[:, b]) / (s[:, a + 2] - s[:, a])


def _halves(s: np.ndarray, a: int, v: float) -> tuple[np.ndarray, np.ndarray]:
    """Segments below and above the line (coordinate ``a``) = v, crossing ones cut; those on the line are in both."""
    first, last = s[:, a], s[:, a + 2]
    low, high = s[(first <= v) & (last <= v)], s[(first >= v) & (last >= v)]
    cross = s[((first < v) & (last > v)) | ((first > v) & (last < v))]
    if not len(cross):
        return low, high
    point = np.empty((len(cross), 2))
    point[:, a], point[:, 1 - a] = v, _at(cross, a, v)
    begin, end = np.hstack([cross[:, :2], point]), np.hstack([point, cross[:, 2:]])
    up = cross[:, a] < v
    return np.vstack([low, begin[up], end[~up]]), np.vstack([high, end[up], begin[~up]])


def _flattened(s: np.ndarray, y: float) -> np.ndarray:
    """Segments moved onto the line y, opposite ones cancelled: the net runs, in the direction of their sign."""
    left, right, sign = np.minimum(s[:, 0], s[:, 2]), np.maximum(s[:, 0], s[:, 2]), np.sign(s[:, 2] - s[:, 0])
    at, change = np.concatenate([left, right]), np.concatenate([sign, -sign])
    place, where = np.unique(at, return_inverse=True)
    net = np.cumsum(np.bincount(where, weights=change, minlength=len(place)))[:-1]
    runs = [(a, b, n) for a, b, n in zip(place[:-1], place[1:], net) if n]
    out = [(a, y, b, y) if n > 0 else (b, y, a, y) for a, b, n in runs for _ in range(int(abs(n)))]
    return np.array(out).reshape(-1, 4)


def _area(s: np.ndarray, y: float) -> float:
    """Area that oriented edges bound above the line y."""
    return float(-(((s[:, 1] - y) + (s[:, 3] - y)) / 2 * (s[:, 2] - s[:, 0])).sum())


def cut(segs: np.ndarray, cell: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None, np.ndarray]]:
    """Pieces of a shape's oriented edges: (columns, rows, segs, edges) of cells; segs None: the cells lie inside the shape."""
    if not len(segs):
        return
    number = lambda v: int(np.floor(v / cell))
    xs, ys = segs[:, [0, 2]], segs[:, [1, 3]]
    whole = (number(xs.min()), number(xs.max()), number(ys.min()), number(ys.max()))
    numbered = np.hstack([segs, np.arange(len(segs))[:, None]])
    todo = [(*whole, segs[segs[:, 0] != segs[:, 2]], numbered)]
    none = np.zeros((0, 4))
    while todo:
        x0, x1, y0, y1, area, edges = todo.pop()
        low, high = y0 * cell, (y1 + 1) * cell
        if not len(edges):
            border = ((area[:, 1] == area[:, 3]) & ((area[:, 1] == low) | (area[:, 1] == high))).all()
            size = _area(area, low)
            if not len(area) or (border and size == 0):
                continue
            if border and size == (x1 + 1 - x0) * cell * (high - low):
                columns, rows = np.meshgrid(np.arange(x0, x1 + 1), np.arange(y0, y1 + 1))
                yield columns.ravel(), rows.ravel(), None, none
                continue
        if x0 == x1 and y0 == y1:
            yield np.array([x0]), np.array([y0]), area, segs[np.unique(edges[:, 4].astype(np.int64))]
        elif x1 - x0 >= y1 - y0:
            mid = (x0 + x1 + 1) // 2
            for (a, b), part, own in zip(((x0, mid - 1), (mid, x1)), _halves(area, 0, mid * cell), _sides(edges, 0, mid * cell)):
                todo.append((a, b, y0, y1, part[part[:, 0] != part[:, 2]], own))
        else:
            mid = (y0 + y1 + 1) // 2
            v = mid * cell
            below, above = _halves(area, 1, v)
            flat = (area[:, 1] == v) & (area[:, 3] == v)  # in both halves, once each after the runs are netted
            inner = [p[~((p[:, 1] == v) & (p[:, 3] == v))] for p in (below, above)]
            own = _sides(edges, 1, v)
            todo.append((x0, x1, y0, mid - 1, np.vstack([inner[0], _flattened(np.vstack([inner[1], area[flat]]), v)]), own[0]))
            todo.append((x0, x1, mid, y1, np.vstack([inner[1], _flattened(np.vstack([inner[0], area[flat]]), v)]), own[1]))


def _sides(edges: np.ndarray, a: int, v: float) -> tuple[np.ndarray, np.ndarray]:
    """Parts of numbered edges on both closed sides of a line; an edge that only ends on it leaves that point on the other side."""
    first, last = edges[:, a], edges[:, a + 2]
    out = []
    for low, high in ((first, last), (last, first)):  # ending, then beginning on the line
        ends = edges[(high == v) & (low != v)]
        k = 2 if high is last else 0
        out.append(np.hstack([ends[:, k:k + 2], ends[:, k:k + 2], ends[:, 4:]])[:, :5] if len(ends) else edges[:0])
    points = np.vstack(out)
    low, high = np.vstack([edges[(first <= v) & (last <= v)], points]), np.vstack([edges[(first >= v) & (last >= v)], points])
    cross = edges[((first < v) & (last > v)) | ((first > v) & (last < v))]
    if not len(cross):
        return low, high
    point = np.empty((len(cross), 2))
    point[:, a], point[:, 1 - a] = v, _at(cross, a, v)
    begin, end = np.hstack([cross[:, :2], point, cross[:, 4:]]), np.hstack([point, cross[:, 2:]])
    up = cross[:, a] < v
    return np.vstack([low, begin[up], end[~up]]), np.vstack([high, end[up], begin[~up]])


def _lists(parts: list[np.ndarray | None]) -> pa.Array:
    """list<struct<x1, y1, x2, y2>>; None is a null list."""
    sizes = [0 if p is None else len(p) for p in parts]
    flat = np.vstack([p for p in parts if p is not None and len(p)] or [np.zeros((0, 4))])
    values = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, k])) for k in range(4)], fields=list(_SEG))
    ends = np.cumsum([0, *sizes]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32(), mask=np.array([p is None for p in parts] + [False])), values)


def pieces(df: DataFrame, key: str, shape: str, cell: float) -> DataFrame:
    """key, _cx, _cy, segs (null: the whole cell), edges: the shapes of ``df`` (with segments) cut along the cells."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, firsts, values = pairs._segments(batch.column("segs"))
            held, rows = [[], [], [], [], []], 0

            def out():
                keys = batch.column("key").take(pa.array(np.concatenate(held[0])))
                return pa.RecordBatch.from_arrays([keys, pa.array(np.concatenate(held[1]), pa.int64()), pa.array(np.concatenate(held[2]), pa.int64()), _lists(held[3]), _lists(held[4])],
                                                  names=["key", "_cx", "_cy", "segs", "edges"])

            for k in range(batch.num_rows):
                for columns, lines, segs, edges in cut(values[firsts[k]:firsts[k] + lengths[k]], cell):
                    for a in range(0, len(columns), 1 << 14):
                        n = len(columns[a:a + (1 << 14)])
                        for h, v in zip(held, (np.full(n, k), columns[a:a + n], lines[a:a + n], None, None)):
                            if v is not None:
                                h.append(v)
                        held[3].extend([segs] * n)
                        held[4].extend([edges] * n)
                        rows += n
                        if rows >= 1 << 14:
                            yield out()
                            held, rows = [[], [], [], [], []], 0
            if rows:
                yield out()

    kind = df.schema[key].dataType.simpleString()
    flat = df.select(F.col(key).alias("key"), F.expr(G._segs_of(shape)).alias("segs"))
    return flat.mapInArrow(run, f"key {kind}, {_PIECE}")


def _cell_box(c: float) -> str:
    return f"named_struct('xmin', _cx * {c}, 'ymin', _cy * {c}, 'xmax', (_cx + 1) * {c}, 'ymax', (_cy + 1) * {c})"


def _ring(r: str) -> str:
    points = [(f"{r}.xmin", f"{r}.ymin"), (f"{r}.xmax", f"{r}.ymin"), (f"{r}.xmax", f"{r}.ymax"), (f"{r}.xmin", f"{r}.ymax")]
    return "array(" + ", ".join(f"named_struct('x1', {a}, 'y1', {b}, 'x2', {x}, 'y2', {y})" for (a, b), (x, y) in zip(points, points[1:] + points[:1])) + ")"


def _side(df: DataFrame, key: str, shape: str, cell: float, general: Column) -> tuple[DataFrame, DataFrame]:
    """(pieces of the general shapes, pieces of the rectangle shapes): key, _cx, _cy, segs, edges, probes (those that the cell owns), box. A rectangle
    shape's piece travels as its ``box`` alone, and gets the lists after the join (:func:`_unfolded`)."""
    low = lambda v: grids.at_level(v, cell)
    other = df.where(general)
    kept = other.select(F.col(key).alias("key"), F.expr(G._probes_of(shape)).alias("_points"))
    cut_up = pieces(other, key, shape, cell).withColumn("segs", F.expr(f"coalesce(segs, {_ring(_cell_box(cell))})"))
    # probes ride by key: the cutting sees edges only
    own = kept.select("key", F.explode("_points").alias("p")).groupBy("key", F.expr(low("p.x")).alias("_cx"), F.expr(low("p.y")).alias("_cy")).agg(F.collect_set("p").alias("probes"))
    cut_up = cut_up.join(own.hint("merge"), ["key", "_cx", "_cy"], "left").withColumn("probes", F.coalesce("probes", F.array().cast(f"array<{G.POINT_T}>")))
    plain = grids.covered(df.where(~general).select(F.col(key).alias("key"), G.slim(shape).alias("box")), "box", cell, 0.0)
    return cut_up.withColumn("box", F.lit(None).cast(plain.schema["box"].dataType)), plain


def _unfolded(df: DataFrame, segs: str, edges: str, probes: str, box: str, cell: float) -> DataFrame:
    """Rectangle pieces with their lists. A rectangle's piece: its parts within the cell; its edges whole."""
    low = lambda v: grids.at_level(v, cell)
    cell_box, corners = _cell_box(cell), f"transform({G._rects_of(box)}, vq_ -> named_struct('x', vq_.xmin, 'y', vq_.ymin))"
    inside = (f"filter(transform({G._rects_of(box)}, r_ -> named_struct('xmin', greatest(r_.xmin, {cell_box}.xmin), 'ymin', greatest(r_.ymin, {cell_box}.ymin),"
              f" 'xmax', least(r_.xmax, {cell_box}.xmax), 'ymax', least(r_.ymax, {cell_box}.ymax))), r_ -> r_.xmin <= r_.xmax AND r_.ymin <= r_.ymax)")
    ring = lambda rects: f"flatten(transform({rects}, q_ -> {_ring('q_')}))"
    own = f"filter({corners}, p_ -> {low('p_.x')} = _cx AND {low('p_.y')} = _cy)"
    lists = {segs: ring(inside), edges: ring(G._rects_of(box)), probes: own}
    return df.withColumns({c: F.coalesce(c, F.expr(f"CASE WHEN {box} IS NOT NULL THEN {v} END")) for c, v in lists.items()}).drop(box)


def _meet(*columns: str) -> Column:
    """hit and area of pairs of pieces, given as segs, edges and probes of both."""
    @F.arrow_udf("struct<hit:boolean,area:double>")
    def meet(sa: pa.Array, sb: pa.Array, ea: pa.Array, eb: pa.Array, qa: pa.Array, qb: pa.Array) -> pa.Array:
        a, b, whole_a, whole_b = pairs._segments(ea), pairs._segments(eb), pairs._segments(sa), pairs._segments(sb)
        hit = pairs._under(qa, whole_b) | pairs._under(qb, whole_a)
        for start, end in pairs._slices(a[0], b[0]):
            pair, i, j = pairs._edges(a, b, start, end)
            hit[start:end] |= np.bincount(pair, weights=pairs._meet(a[2][i], b[2][j]), minlength=end - start) > 0
        return pa.StructArray.from_arrays([pa.array(hit), pairs._overlap_batch(sa, sb)], names=["hit", "area"])

    return meet(*columns)


def clipped_pairs(left: DataFrame, right: DataFrame, left_key: str, right_key: str, cell: float, left_shape: str = "shape", right_shape: str = "shape",
                  carry: Sequence[str] = ()) -> DataFrame:
    """left_key, right_key, overlap_m2 of all pairs whose shapes meet (touching counts). Keys must be unique on their side; null shapes meet nothing.
    ``carry``: columns of the right side that come along. Pairs of rectangles bring them from their cell; only the others are joined back for them."""
    left, right = left.where(F.col(left_shape).isNotNull()), right.where(F.col(right_shape).isNotNull())
    general = lambda s: F.expr(f"NOT {G._all_rect(s)}")
    flat = lambda df, key, s, name, more: G.mark_rect_only(df.where(~general(s)).select(F.col(key).alias(name), F.col(s).alias("shape"), *more))
    boxes = spatial_join(flat(left, left_key, left_shape, "_l", ()), flat(right, right_key, right_shape, "_r", carry), cell=cell, with_overlap=True).select("_l", "_r", "overlap_m2", *carry)
    gen_l, rect_l = _side(left, left_key, left_shape, cell, general(left_shape))
    gen_r, rect_r = _side(right, right_key, right_shape, cell, general(right_shape))
    right_name = lambda df: df.withColumnsRenamed({"key": "_r", "segs": "_sb", "edges": "_eb", "probes": "_qb", "box": "_bb"})
    left_name = lambda df: df.withColumnsRenamed({"key": "_l", "segs": "_sa", "edges": "_ea", "probes": "_qa", "box": "_ba"})
    # never broadcast: the planner's estimate knows neither the pieces nor the rows that cover several cells
    met = _unfolded(left_name(gen_l).join(right_name(gen_r.unionByName(rect_r, allowMissingColumns=True)).hint("merge"), ["_cx", "_cy"]).drop("_ba"), "_sb", "_eb", "_qb", "_bb", cell)
    flat_l = left_name(rect_l).withColumns({f"_{k}a": F.lit(None).cast(f"array<{t}>") for k, t in (("s", G.SEG_T), ("e", G.SEG_T), ("q", G.POINT_T))})
    met = met.unionByName(_unfolded(flat_l.join(right_name(gen_r).hint("merge"), ["_cx", "_cy"]).drop("_bb"), "_sa", "_ea", "_qa", "_ba", cell))
    parts = met.select("_l", "_r", _meet("_sa", "_sb", "_ea", "_eb", "_qa", "_qb").alias("m")).select("_l", "_r", "m.hit", "m.area")
    summed = parts.groupBy("_l", "_r").agg(F.max("hit").alias("hit"), F.sum("area").alias("overlap_m2")).where("hit").drop("hit")
    if carry:
        summed = summed.join(right.select(F.col(right_key).alias("_r"), *carry).hint("merge"), "_r")
    return boxes.unionByName(summed).withColumnsRenamed({"_l": left_key, "_r": right_key})
