"""Exact predicates and overlap area of polygon pairs, a batch of pairs at a time.

General polygons need every edge of one shape against every edge of the other. Evaluated as nested SQL lambdas that is interpreted
code per edge pair; here a batch of pairs comes as Arrow lists of segments and numpy works on all their
edge pairs at once, in slices of bounded size. Spark still partitions, joins and filters the pairs; rectangles never come here.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Edge pairs evaluated at once.
SLICE = 1 << 18


def _segments(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths and first positions of a list<struct<x1, y1, x2, y2>> column, and its (n, 4) segments. A null list has length 0."""
    lengths = np.asarray(column.value_lengths().fill_null(0))
    flat = column.flatten()
    values = np.stack([np.asarray(flat.field(c)) for c in ("x1", "y1", "x2", "y2")], axis=1) if len(flat) else np.zeros((0, 4))
    return lengths, np.cumsum(lengths) - lengths, values


def _slices(na: np.ndarray, nb: np.ndarray):
    """Ranges of pairs whose edge pairs add up to about SLICE."""
    work, start = na.astype(np.int64) * nb, 0
    upto = np.cumsum(work)
    while start < len(work):
        done = upto[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(upto, done + SLICE, side="right")))
        yield start, end
        start = end


def _edges(a, b, start: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of pairs start..end: number of the pair (from 0) and rows of both segments for every edge pair."""
    (na, fa, _), (nb, fb, _) = a, b
    na, nb = na[start:end], nb[start:end]
    work = na * nb
    pair = np.repeat(np.arange(end - start), work)
    k = np.arange(len(pair)) - np.repeat(np.cumsum(work) - work, work)
    return pair, fa[start:end][pair] + k // nb[pair], fb[start:end][pair] + k % nb[pair]


def _area(e: np.ndarray, f: np.ndarray) -> np.ndarray:
    """Signed area under the lower of two edges over their common x-range (vertical edges have none)."""
    def ordered(s):
        left = s[:, 0] < s[:, 2]
        return np.where(left, s[:, 0], s[:, 2]), np.where(left, s[:, 2], s[:, 0]), np.where(left, s[:, 1], s[:, 3]), np.where(left, s[:, 3], s[:, 1]), np.sign(s[:, 2] - s[:, 0])
    exl, exr, eyl, eyr, es = ordered(e)
    fxl, fxr, fyl, fyr, fs = ordered(f)
    lo, hi = np.maximum(exl, fxl), np.minimum(exr, fxr)
    out = np.zeros(len(e))
    k = np.flatnonzero((hi > lo) & (es * fs != 0))
    if not len(k):
        return out
    lo, hi = lo[k], hi[k]
    at = lambda x, xl, xr, yl, yr: yl[k] + (x - xl[k]) * (yr[k] - yl[k]) / (xr[k] - xl[k])
    el, er, fl, fr = at(lo, exl, exr, eyl, eyr), at(hi, exl, exr, eyl, eyr), at(lo, fxl, fxr, fyl, fyr), at(hi, fxl, fxr, fyl, fyr)
    dl, dr = el - fl, er - fr
    same = (hi - lo) * (np.minimum(el, fl) + np.minimum(er, fr)) / 2
    crossing = dl * dr < 0
    t = np.where(crossing, dl / np.where(crossing, dl - dr, 1), 0)
    xc, yc = t * (hi - lo), el + t * (er - el)
    split = xc * (np.minimum(el, fl) + yc) / 2 + (hi - lo - xc) * (yc + np.minimum(er, fr)) / 2
    out[k] = es[k] * fs[k] * np.where(crossing, split, same)
    return out


def _meet(e: np.ndarray, f: np.ndarray) -> np.ndarray:
    def side(s, x, y):
        return np.sign((s[:, 2] - s[:, 0]) * (y - s[:, 1]) - (s[:, 3] - s[:, 1]) * (x - s[:, 0]))
    boxes = np.ones(len(e), bool)
    for c in (0, 1):
        boxes &= np.minimum(e[:, c], e[:, c + 2]) <= np.maximum(f[:, c], f[:, c + 2])
        boxes &= np.minimum(f[:, c], f[:, c + 2]) <= np.maximum(e[:, c], e[:, c + 2])
    return boxes & (side(e, f[:, 0], f[:, 1]) * side(e, f[:, 2], f[:, 3]) <= 0) & (side(f, e[:, 0], e[:, 1]) * side(f, e[:, 2], e[:, 3]) <= 0)


def _gap2(e: np.ndarray, f: np.ndarray) -> np.ndarray:
    """Squared distance of two segments that do not meet."""
    def point(x, y, s):
        dx, dy = s[:, 2] - s[:, 0], s[:, 3] - s[:, 1]
        size = dx * dx + dy * dy
        t = np.where(size == 0, 0, np.clip(((x - s[:, 0]) * dx + (y - s[:, 1]) * dy) / np.where(size == 0, 1, size), 0, 1))
        return (x - s[:, 0] - t * dx) ** 2 + (y - s[:, 1] - t * dy) ** 2
    return np.minimum(np.minimum(point(e[:, 0], e[:, 1], f), point(e[:, 2], e[:, 3], f)), np.minimum(point(f[:, 0], f[:, 1], e), point(f[:, 2], f[:, 3], e)))


def _inside(points: pa.Array, b) -> np.ndarray:
    """Whether any of a row's points lies in the row's polygon b (crossing number)."""
    nb, fb, segs = b
    lengths = np.asarray(points.value_lengths().fill_null(0))
    flat = points.flatten()
    out = np.zeros(len(points), bool)
    if not len(flat):
        return out
    xy = np.stack([np.asarray(flat.field("x")), np.asarray(flat.field("y"))], axis=1)
    row = np.repeat(np.arange(len(points)), lengths)
    for start, end in _slices(np.ones(len(row), np.int64), nb[row]):
        r = row[start:end]
        work = nb[r]
        k = np.repeat(np.arange(end - start), work)
        s = segs[fb[r][k] + np.arange(len(k)) - np.repeat(np.cumsum(work) - work, work)]
        x, y = xy[start:end][k].T
        rise = np.where(s[:, 3] == s[:, 1], 1, s[:, 3] - s[:, 1])
        hit = ((s[:, 1] > y) != (s[:, 3] > y)) & (x < s[:, 0] + (y - s[:, 1]) * (s[:, 2] - s[:, 0]) / rise)
        odd = np.bincount(k, weights=hit, minlength=end - start) % 2 == 1
        np.logical_or.at(out, r, odd)
    return out


def _under(points: pa.Array, b) -> np.ndarray:
    """Whether any of a row's points lies in the row's edge set b, by the edges above it: needs no upright edges."""
    nb, fb, segs = b
    lengths = np.asarray(points.value_lengths().fill_null(0))
    flat = points.flatten()
    out = np.zeros(len(points), bool)
    if not len(flat):
        return out
    xy = np.stack([np.asarray(flat.field("x")), np.asarray(flat.field("y"))], axis=1)
    row = np.repeat(np.arange(len(points)), lengths)
    for start, end in _slices(np.ones(len(row), np.int64), nb[row]):
        r = row[start:end]
        work = nb[r]
        k = np.repeat(np.arange(end - start), work)
        s = segs[fb[r][k] + np.arange(len(k)) - np.repeat(np.cumsum(work) - work, work)]
        x, y = xy[start:end][k].T
        run = np.where(s[:, 2] == s[:, 0], 1, s[:, 2] - s[:, 0])
        hit = ((s[:, 0] > x) != (s[:, 2] > x)) & (s[:, 1] + (x - s[:, 0]) * (s[:, 3] - s[:, 1]) / run > y)
        odd = np.bincount(k, weights=hit, minlength=end - start) % 2 == 1
        np.logical_or.at(out, r, odd)
    return out


def _overlap_batch(sa: pa.Array, sb: pa.Array) -> pa.Array:
    a, b = _segments(sa), _segments(sb)
    out = np.zeros(len(sa))
    for start, end in _slices(a[0], b[0]):
        pair, i, j = _edges(a, b, start, end)
        e, f = a[2][i], b[2][j]
        if len(pair):  # near the pair's own corner products stay small and, on a fine lattice, exact
            corner = np.full((end - start, 2), np.inf)
            for c in (0, 1):
                np.minimum.at(corner[:, c], pair, np.minimum(np.minimum(e[:, c], e[:, c + 2]), np.minimum(f[:, c], f[:, c + 2])))
            shift = np.tile(corner[pair], 2)
            out[start:end] = np.bincount(pair, weights=_area(e - shift, f - shift), minlength=end - start)
    return pa.array(np.maximum(out, 0), mask=~np.asarray(sa.is_valid()))


def _near_batch(sa: pa.Array, sb: pa.Array, pa_: pa.Array, pb: pa.Array, distance: float) -> pa.Array:
    a, b = _segments(sa), _segments(sb)
    out = _inside(pa_, b) | _inside(pb, a)
    for start, end in _slices(a[0], b[0]):
        pair, i, j = _edges(a, b, start, end)
        e, f = a[2][i], b[2][j]
        hit = _meet(e, f)
        if distance > 0:
            hit |= _gap2(e, f) <= distance * distance
        out[start:end] |= np.bincount(pair, weights=hit, minlength=end - start) > 0
    return pa.array(out, mask=~np.asarray(sa.is_valid()))


def overlap(segments_a: Column, segments_b: Column) -> Column:
    """Area of the intersection; null segments (a pair settled otherwise) give null."""
    @F.arrow_udf("double")
    def area(a: pa.Array, b: pa.Array) -> pa.Array:
        return _overlap_batch(a, b)
    return area(segments_a, segments_b)


def near(segments_a: Column, segments_b: Column, points_a: Column, points_b: Column, distance: float = 0.0) -> Column:
    """Whether two polygons meet, or come as close as ``distance``; points: one vertex of every part."""
    @F.arrow_udf("boolean")
    def close(a: pa.Array, b: pa.Array, p: pa.Array, q: pa.Array) -> pa.Array:
        return _near_batch(a, b, p, q, distance)
    return close(segments_a, segments_b, points_a, points_b)
