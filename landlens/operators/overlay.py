"""Per-feature summaries of spatial relations (correlated SUM / EXISTS / COUNT).

The source pipeline asks several correlated sub-queries per target row
(forest overlap sum, planning EXISTS, building footprint sum, ...). Here all
right-hand layers are tagged and unioned, joined to the targets in ONE grid
join, reduced in ONE ``groupBy(key)`` (partial aggregation map-side, so a hot
key never gathers its rows in one task) and attached with ONE left join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..session import stage_table
from .clipped import clipped_pairs
from .spatial_join import spatial_join

KIND = "_kind"


def tagged_union(layers: Mapping[str, DataFrame], columns: Sequence[str] = (),
                 shape: str = "shape") -> DataFrame:
    """Union layers as (_kind, shape, *columns); columns a layer lacks are NULL.

    Column types are taken from the first layer that has the column.
    """
    types = {}
    for df in layers.values():
        for f in df.schema.fields:
            types.setdefault(f.name, f.dataType)
    out = None
    for kind, df in layers.items():
        sel = [F.lit(kind).alias(KIND), F.col(shape).alias("shape")]
        for c in columns:
            sel.append(F.col(c) if c in df.columns else F.lit(None).cast(types[c]).alias(c))
        part = df.select(*sel)
        out = part if out is None else out.unionByName(part)
    if all(G.is_rect_only(df, shape) for df in layers.values()):
        out = G.mark_rect_only(out, "shape")
    return out


def is_kind(kind: str) -> Column:
    return F.col(KIND) == kind


def overlay_summary(targets: DataFrame, key: str, layers: Mapping[str, DataFrame],
                    aggs: Sequence[Column], columns: Sequence[str] = (), cell: float = 100.0,
                    shape: str = "shape", join_back: bool = True) -> DataFrame:
    """Targets left-joined with aggregates over their intersecting layer rows.

    ``aggs`` see per pair: ``_kind``, ``overlap_m2``, the listed ``columns``
    and the target ``key``. Targets without any hit get NULL aggregates.
    """
    right = tagged_union(layers, columns)
    left = targets.select(key, F.col(shape).alias("_tshape"))
    if G.is_rect_only(targets, shape):
        left = G.mark_rect_only(left, "_tshape")
    if G.is_rect_only(left, "_tshape") and G.is_rect_only(right):
        pairs = spatial_join(left, right,
                             left_shape="_tshape", right_shape="shape", with_overlap=True, cell=cell)
    else:  # shapes of any form and size, cut along the cells
        right = stage_table(right.withColumn("_rid", F.monotonically_increasing_id()))
        pairs = clipped_pairs(stage_table(left), right, key, "_rid", cell, "_tshape", "shape", carry=[c for c in right.columns if c not in ("_rid", "shape")])
    summary = pairs.groupBy(key).agg(*aggs)
    return targets.join(summary, key, "left") if join_back else summary


def sum_overlap(kind: str, name: str) -> Column:
    return F.coalesce(F.sum(F.when(is_kind(kind), F.col("overlap_m2"))), F.lit(0.0)).alias(name)


def any_hit(kind: str, name: str) -> Column:
    return F.coalesce(F.max(is_kind(kind)), F.lit(False)).alias(name)


def count_hits(kind: str, name: str) -> Column:
    return F.count_if(is_kind(kind)).alias(name)


def overlap_sum(targets: DataFrame, key: str, layer: DataFrame, name: str = "overlap_m2_sum",
                cell: float = 100.0) -> DataFrame:
    """COALESCE((SELECT SUM(ST_Area(ST_Intersection(l, t))) ... ), 0) per target."""
    out = overlay_summary(targets, key, {"x": layer}, [sum_overlap("x", name)], cell=cell)
    return out.withColumn(name, F.coalesce(F.col(name), F.lit(0.0)))


def exists_flag(targets: DataFrame, key: str, layer: DataFrame, name: str = "hit",
                cell: float = 100.0) -> DataFrame:
    """EXISTS (SELECT 1 FROM layer WHERE ST_Intersects(layer, target))."""
    out = overlay_summary(targets, key, {"x": layer}, [any_hit("x", name)], cell=cell)
    return out.withColumn(name, F.coalesce(F.col(name), F.lit(False)))


def hit_count(targets: DataFrame, key: str, layer: DataFrame, name: str = "n_hits",
              cell: float = 100.0) -> DataFrame:
    """COALESCE((SELECT COUNT(*) ... WHERE ST_Intersects), 0) per target."""
    out = overlay_summary(targets, key, {"x": layer}, [count_hits("x", name)], cell=cell)
    return out.withColumn(name, F.coalesce(F.col(name), F.lit(0)).cast("bigint"))
