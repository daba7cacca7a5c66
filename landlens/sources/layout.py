"""Layers stored along a space-filling curve, read by box.

A layer is written as Parquet in the order of a Z-curve over its shapes' middles, with the box as top-level columns. Neighbours in space are
neighbours in the file, so row groups cover small boxes, and a box filter on the four columns skips row groups (and files) by their
minima and maxima. Rows are dealt by ranges of the curve, so a dense area fills more files instead of a larger one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G

BOX = ("xmin", "ymin", "xmax", "ymax")
#: Metres of a step of the curve, and bits a coordinate: steps below 2^21 m from the origin of the curve.
STEP, BITS = 1.0, 21
#: Bytes of a row group: small enough to be skipped one by one, large enough to scan fast.
GROUP_BYTES = 16 << 20


def _spread(c: Column) -> Column:
    """The low 21 bits of a BIGINT with a zero after each."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        c = c.bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
    return c


def curve(x: Column, y: Column, x0: float, y0: float) -> Column:
    """Place of a point on the Z-curve."""
    def number(c: Column, origin: float) -> Column:
        return F.least(F.greatest(F.floor((c - origin) / STEP), F.lit(0)), F.lit((1 << BITS) - 1)).cast("bigint")
    pair = F.struct(number(x, x0).alias("x"), number(y, y0).alias("y"))
    # a one-element array binds both numbers once
    return F.transform(F.array(pair), lambda p: _spread(p["x"]).bitwiseOR(F.shiftleft(_spread(p["y"]), 1)))[0]


def write_layer(layer: DataFrame, path: str, origin: tuple[float, float], files: int | None = None, group_bytes: int = GROUP_BYTES, shape: str = "shape") -> None:
    """Write ``layer`` along the curve from ``origin``. Rows without a shape are kept, with null boxes, first."""
    n = files or max(1, int(layer.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    boxed = layer.withColumns({c: F.col(f"{shape}.{c}") for c in BOX})
    place = curve((F.col("xmin") + F.col("xmax")) / 2, (F.col("ymin") + F.col("ymax")) / 2, *origin)
    dealt = boxed.withColumn("_curve", place).withColumn("_salt", F.rand(1)).repartitionByRange(n, "_curve", "_salt").sortWithinPartitions("_curve")
    dealt.drop("_curve", "_salt").write.mode("overwrite").option("parquet.block.size", group_bytes).parquet(path)


def read_box(spark: SparkSession, path: str, xmin: float, ymin: float, xmax: float, ymax: float, shape: str = "shape", rect_only: bool = False) -> DataFrame:
    """Rows whose shape meets the closed box. The box test reaches the Parquet scan; the exact test follows for shapes that are not rectangles."""
    rows = spark.read.parquet(path)
    if rect_only:
        rows = G.mark_rect_only(rows, shape)
    near = rows.where((F.col("xmin") <= xmax) & (F.col("xmax") >= xmin) & (F.col("ymin") <= ymax) & (F.col("ymax") >= ymin))
    env = G.shape_from_box(*[f"{v!r}D" for v in map(float, (xmin, ymin, xmax, ymax))])
    exact = near.withColumn("_env", env).where(F.expr(G.intersects_sql(shape, "_env", rect_only)))
    return exact.drop("_env", *BOX)
