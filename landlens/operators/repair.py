"""Rings that cross themselves or each other: all crossings found, and the part rebuilt from simple loops.

Crossings are searched in a sweep over square cells, from one for the whole outline down: cells that hold many edges are cut finer, level by level, with all
their edges at once, and only edges that share a cell of few are compared. At every crossing the outline is cut, and the two
passages are joined the other way round, which leaves loops that touch but do not cross. By the even-odd rule a loop inside an even number of others is
an outer ring, inside an odd number a hole of the smallest one around it. A bow-tie becomes two triangles, a pentagram a star with a
hole. Geometries come as Arrow lists; only those with crossings are built anew.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import geometry as G

#: Edges in a cell before it is cut into SPLIT x SPLIT, how often that can be, and edge pairs compared at once.
CROWD, SPLIT, DEPTH, PAIRS = 16, 4, 12, 1 << 20


def _finer(edges: np.ndarray, own: np.ndarray, column: np.ndarray, row: np.ndarray, x: float, y: float, size: float, split: int):
    """(edge, column, row) of the cells of ``size`` that edges run through, inside the cells (``split`` as wide) where they are listed; all cells at once."""
    own = np.repeat(own, split)
    column = np.repeat(column, split) * split + np.tile(np.arange(split), len(column))
    low, high = np.repeat(row, split) * split, np.repeat(row, split) * split + split - 1
    s = edges[own]
    begin, end = x + column * size, x + (column + 1) * size
    slack = 1e-9 * size  # rounding must not lose a cell
    wide = s[:, 2] > s[:, 0]
    slope = np.where(wide, (s[:, 3] - s[:, 1]) / np.where(wide, s[:, 2] - s[:, 0], 1), 0)
    at = lambda v: s[:, 1] + (np.clip(v, s[:, 0], s[:, 2]) - s[:, 0]) * slope
    a, b = np.where(wide, at(begin), s[:, 1]), np.where(wide, at(end), s[:, 3])
    low = np.maximum(low, np.floor((np.minimum(a, b) - y - slack) / size).astype(np.int64))
    high = np.minimum(high, np.floor((np.maximum(a, b) - y + slack) / size).astype(np.int64))
    n = np.where((s[:, 0] <= end + slack) & (s[:, 2] >= begin - slack), np.maximum(high - low + 1, 0), 0)
    part = np.repeat(np.arange(len(own)), n)
    return own[part], column[part], np.arange(len(part)) - np.repeat(np.cumsum(n) - n, n) + low[part]


def crossings(edges: np.ndarray) -> np.ndarray:
    """Pairs (i, j), i < j, of edges that properly cross."""
    n, found = len(edges), [np.zeros((0, 2), np.int64)]
    left = np.where(edges[:, :1] <= edges[:, 2:3], edges, edges[:, [2, 3, 0, 1]])
    x, y = left[:, 0].min(), left[:, [1, 3]].min()
    extent = max(left[:, 2].max() - x, left[:, [1, 3]].max() - y, 1e-9) * (1 + 1e-9)
    own, column, row, size = np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int64), extent
    for depth in range(DEPTH + 1):
        order = np.lexsort((row, column))
        own, column, row = own[order], column[order], row[order]
        begin = np.flatnonzero(np.concatenate([[True], (column[1:] != column[:-1]) | (row[1:] != row[:-1])])) if len(own) else np.zeros(0, np.int64)
        sizes = np.diff(np.append(begin, len(own)))
        done = np.ones(len(sizes), bool) if depth == DEPTH else sizes <= CROWD
        for k in np.unique(sizes[done]).tolist():  # all cells of k edges at once
            i, j = np.triu_indices(k, 1)
            cells = begin[done & (sizes == k)]
            for at in range(0, len(cells) if k > 1 else 0, max(1, PAIRS // max(1, len(i)))):
                members = own[cells[at:at + max(1, PAIRS // len(i)), None] + np.arange(k)]
                a, b = members[:, i].ravel(), members[:, j].ravel()
                hit = _cross(edges[a], edges[b])
                found.append(np.stack([a[hit], b[hit]], axis=1))
        crowded = np.repeat(~done, sizes)
        if not crowded.any():
            break
        size /= SPLIT
        own, column, row = _finer(left, own[crowded], column[crowded], row[crowded], x, y, size, SPLIT)
    return np.unique(np.sort(np.vstack(found), axis=1), axis=0)


def _cross(e: np.ndarray, f: np.ndarray) -> np.ndarray:
    def side(s, x, y):
        return np.sign((s[:, 2] - s[:, 0]) * (y - s[:, 1]) - (s[:, 3] - s[:, 1]) * (x - s[:, 0]))
    return (side(e, f[:, 0], f[:, 1]) * side(e, f[:, 2], f[:, 3]) < 0) & (side(f, e[:, 0], e[:, 1]) * side(f, e[:, 2], e[:, 3]) < 0)


def loops(rings: list[np.ndarray], pairs: np.ndarray, edges: np.ndarray) -> list[np.ndarray]:
    """Closed loops (first point repeated) of rings whose edges are numbered in order and cross in ``pairs``."""
    p, q = edges[pairs[:, 0]], edges[pairs[:, 1]]
    d, g = p[:, 2:] - p[:, :2], q[:, 2:] - q[:, :2]
    base = d[:, 0] * g[:, 1] - d[:, 1] * g[:, 0]
    gap = q[:, :2] - p[:, :2]
    t, u = (gap[:, 0] * g[:, 1] - gap[:, 1] * g[:, 0]) / base, (gap[:, 0] * d[:, 1] - gap[:, 1] * d[:, 0]) / base
    points = p[:, :2] + t[:, None] * d
    on: dict[int, list] = {}
    for k, (i, j) in enumerate(pairs.tolist()):
        on.setdefault(i, []).append((t[k], k, 0))
        on.setdefault(j, []).append((u[k], k, 1))
    place, after, visit = [], [], {}  # points of the walk, the next place of each, and both places of a crossing
    number = 0
    for ring in rings:
        first = len(place)
        for k in range(len(ring) - 1):
            place.append(ring[k])
            for _, c, which in sorted(on.get(number, ())):
                visit[c, which] = len(place)
                place.append(points[c])
            number += 1
        after.extend([*range(first + 1, len(place)), first])
    for c in range(len(pairs)):
        a, b = visit[c, 0], visit[c, 1]
        after[a], after[b] = after[b], after[a]
    out, seen = [], np.zeros(len(place), bool)
    for start in range(len(place)):
        walk, at = [], start
        while not seen[at]:
            seen[at] = True
            walk.append(place[at])
            at = after[at]
        if len(walk) > 2:
            loop = np.array([*walk, walk[0]])
            loop = loop[np.concatenate([[True], (loop[1:] != loop[:-1]).any(axis=1)])]
            if len(loop) > 3 and _area(loop):
                out.append(loop)
    return out


def _area(r: np.ndarray) -> float:
    x, y = (r - r[0]).T
    return float((x[:-1] * y[1:] - x[1:] * y[:-1]).sum() / 2)


def _inside(x: float, y: float, ring: np.ndarray) -> bool:
    a, b = ring[:-1], ring[1:]
    up = (a[:, 1] > y) != (b[:, 1] > y)
    rise = np.where(up, b[:, 1] - a[:, 1], 1)
    return bool(np.count_nonzero(up & (x < a[:, 0] + (y - a[:, 1]) * (b[:, 0] - a[:, 0]) / rise)) % 2)


def _point(ring: np.ndarray) -> tuple[float, float]:
    """A point within a simple loop: the middle of the widest crossing of a level between two vertices' heights."""
    heights = np.unique(ring[:, 1])
    gap = int(np.argmax(np.diff(heights)))
    y = (heights[gap] + heights[gap + 1]) / 2
    a, b = ring[:-1], ring[1:]
    up = (a[:, 1] > y) != (b[:, 1] > y)
    xs = np.sort(a[up, 0] + (y - a[up, 1]) * (b[up, 0] - a[up, 0]) / (b[up, 1] - a[up, 1]))
    k = int(np.argmax(xs[1::2] - xs[::2])) * 2
    return (xs[k] + xs[k + 1]) / 2, y


def nested(rings: list[np.ndarray]) -> list[list[np.ndarray]]:
    """Polygons (outer ring first) of loops that do not cross, by the even-odd rule."""
    size = [abs(_area(r)) for r in rings]
    boxes = np.array([[*r.min(axis=0), *r.max(axis=0)] for r in rings])
    around = []
    for k, r in enumerate(rings):
        x, y = _point(r)
        near = np.flatnonzero((boxes[:, 0] < x) & (x < boxes[:, 2]) & (boxes[:, 1] < y) & (y < boxes[:, 3]))
        around.append([j for j in near.tolist() if j != k and size[j] > size[k] and _inside(x, y, rings[j])])
    out = {k: [r] for k, r in enumerate(rings) if len(around[k]) % 2 == 0}
    for k, r in enumerate(rings):
        if len(around[k]) % 2:
            out[min(around[k], key=lambda j: size[j])].append(r)
    return list(out.values())


def uncrossed(rings: list[np.ndarray]) -> list[list[np.ndarray]] | None:
    """Polygons of a part whose rings cross; None where nothing crosses."""
    edges = np.vstack([np.hstack([r[:-1], r[1:]]) for r in rings])
    pairs = crossings(edges)
    return nested(loops(rings, pairs, edges)) if len(pairs) else None


def uncross(geom: Column) -> Column:
    """The geometry (clean, closed rings) without crossings; null where it has none, or the geometry is null."""
    point = pa.struct([("x", pa.float64()), ("y", pa.float64())])
    kind = pa.list_(pa.list_(pa.list_(point)))

    @F.arrow_udf(G.GEOM_T)
    def fix(geoms: pa.Array) -> pa.Array:
        if geoms.null_count == len(geoms):
            return pa.nulls(len(geoms), kind)
        out = []
        for g in geoms:
            if not g.is_valid:
                out.append(None)
                continue
            parts, crossed = [], False
            for part in g.values:
                rings = []
                for ring in part.values:
                    p = ring.values
                    rings.append(np.stack([np.asarray(p.field("x")), np.asarray(p.field("y"))], axis=1))
                done = uncrossed(rings)
                crossed |= done is not None
                parts.extend([rings] if done is None else done)
            out.append([[[{"x": x, "y": y} for x, y in r.tolist()] for r in rings] for rings in parts] if crossed else None)
        return pa.array(out, kind)

    # Said to be not deterministic so that no filter above is rewritten to call it, and it runs once a row.
    return fix.asNondeterministic()(geom)
