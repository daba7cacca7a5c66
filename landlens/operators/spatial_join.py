"""Grid-cell spatial join expressed only with DataFrame operations.

Theta joins on geometry (ST_Intersects / ST_DWithin) would plan as a
BroadcastNestedLoopJoin, O(n*m). Instead every row is replicated into the grid
cells its bounding box covers (the left box grown by the search distance), the
two sides are equi-joined on the cell id (plus optional extra equality keys),
and each candidate pair is kept only in its *owner cell*: the cell holding the
lower-left corner of the two boxes' intersection. Both sides cover that cell,
so every qualifying pair is produced exactly once -- no DISTINCT, no extra
shuffle. The exact predicate runs last, on the surviving pairs only.

Scale notes
-----------
* Cells that many rows cover are cut further, and rows lying on top of each other dealt into blocks (operators.grid), so no join key holds
  more than about ``split_above`` rows of a side.
* Replication is bounded by ceil(w/c + 1) * ceil(h/c + 1) per row; choose ``cell``
  near the typical size of the larger layer. Shapes much larger than a cell belong into operators.clipped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from . import grid as grids
from . import pairs as pair

def auto_cell(left: DataFrame, right: DataFrame, left_shape: str = "shape", right_shape: str = "shape",
              floor: float = 1.0) -> float:
    """Grid size from the data: the median box extent (larger side) of the two
    layers, so a typical row covers about four cells. One small aggregate over
    the shape columns only (approximate percentile, bounded memory)."""
    def med(df, s):
        ext = F.greatest(F.col(f"{s}.xmax") - F.col(f"{s}.xmin"), F.col(f"{s}.ymax") - F.col(f"{s}.ymin"))
        return df.agg(F.percentile_approx(ext, 0.5, 1000).alias("m"), F.count(F.lit(1)).alias("n")).first()
    a, b = med(left, left_shape), med(right, right_shape)
    cands = [r["m"] for r in (a, b) if r["m"] is not None]
    return max(max(cands) if cands else floor, floor)


def _general(pairs: DataFrame, predicate: str, d: float, with_overlap: bool) -> DataFrame:
    """Pairs of rectangles in closed form, pair by pair; all others in Arrow batches (see operators.pairs)."""
    boxes = F.expr(f"{G._all_rect('_ls')} AND {G._all_rect('_rs')}")
    others = lambda sql: F.when(~boxes, F.expr(sql))
    inputs = {"_sa": others(G._segs_of("_ls")), "_sb": others(G._segs_of("_rs")), "_pa": others(G._probes_of("_ls")), "_pb": others(G._probes_of("_rs"))}
    pairs = pairs.withColumns(inputs | {"_boxes": boxes})
    boxes = F.col("_boxes")
    if predicate != "bbox":
        closed = G.intersects_sql("_ls", "_rs", True) if predicate == "intersects" else G.dwithin_sql("_ls", "_rs", d, True)
        pairs = pairs.withColumn("_near", pair.near(*[F.col(c) for c in inputs], d))
        pairs = pairs.where(F.when(boxes, F.expr(closed)).otherwise(F.col("_near"))).drop("_near")
    if with_overlap:
        pairs = (pairs.withColumn("_area", pair.overlap(F.col("_sa"), F.col("_sb")))
                 .withColumn("overlap_m2", F.when(boxes, F.expr(G.overlap_area_sql("_ls", "_rs", True))).otherwise(F.col("_area"))).drop("_area"))
    return pairs.drop(*inputs, "_boxes")


def spatial_join(left: DataFrame, right: DataFrame, *, left_shape: str = "shape",
                 right_shape: str = "shape", predicate: str = "intersects",
                 distance: float = 0.0, cell: float | str = 100.0, on: Sequence[str] = (),
                 with_overlap: bool = False, keep_shapes: bool = False, split_above: int | None = grids.LIMIT) -> DataFrame:
    """Pairs (left row, right row) satisfying the spatial predicate.

    predicate: 'intersects' (closed), 'dwithin' (planar distance <= distance),
               'bbox' (closed bounding-box test only).
    on:        extra equality keys present on both sides (pushed into the
               equi-join, e.g. a shared use class).
    The shape columns come back as ``_ls`` / ``_rs`` when ``keep_shapes``;
    ``with_overlap`` adds ``overlap_m2`` = ST_Area(ST_Intersection).
    When both shape columns are marked rectangle-only (column metadata, see
    ``geometry.mark_rect_only``) only closed-form rectangle expressions are
    planned; otherwise every pair gets the general exact path.
    Column names of the two sides must be disjoint apart from ``on``.
    ``cell="auto"`` sizes the grid from the data (see :func:`auto_cell`). Cells that more than ``split_above`` rows of a side
    cover are cut (one count of boxes by cell while the join is planned); ``None`` leaves the grid as it is.
    """
    d = float(distance) if predicate == "dwithin" else 0.0
    c = auto_cell(left, right, left_shape, right_shape) if cell == "auto" else float(cell)
    ro = G.is_rect_only(left, left_shape) and G.is_rect_only(right, right_shape)
    grid = grids.build(left, right, left_shape, right_shape, c, d, split_above)
    left, right = left.withColumnRenamed(left_shape, "_ls"), right.withColumnRenamed(right_shape, "_rs")
    if ro and not keep_shapes:
        left, right = left.withColumn("_ls", G.slim("_ls")), right.withColumn("_rs", G.slim("_rs"))
    lq, rq = grid.place(left, "_ls", True), grid.place(right, "_rs", False)
    # never broadcast: the planner's estimate knows neither the copies a row has by cell nor how far its file is compressed
    pairs = lq.join(rq.hint("merge"), [*grid.keys, *on]).where(grid.owner("_ls", "_rs") & F.expr(G.bbox_intersects_sql("_ls", "_rs", d)))
    if predicate not in ("intersects", "dwithin", "bbox"):
        raise ValueError(f"unknown predicate {predicate!r}")
    if ro:
        if predicate == "intersects":
            pairs = pairs.where(F.expr(G.intersects_sql("_ls", "_rs", True)))
        elif predicate == "dwithin":
            pairs = pairs.where(F.expr(G.dwithin_sql("_ls", "_rs", d, True)))
        if with_overlap:
            pairs = pairs.withColumn("overlap_m2", F.expr(G.overlap_area_sql("_ls", "_rs", True)))
    else:
        pairs = _general(pairs, predicate, d, with_overlap)
    pairs = pairs.drop(*grid.keys)
    return pairs if keep_shapes else pairs.drop("_ls", "_rs")
