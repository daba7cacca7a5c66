"""Grid cells for spatial equi-joins, split where rows are dense.

The plane is cut into square cells of one size. A cell that more than ``limit`` rows of a side cover is cut into four, and so on down, a
quadtree built from counts. Where cutting does not help, because the rows lie on top of each other, the cell's rows are dealt into blocks instead:
the left side into ``kl`` parts, the right side into ``kr``, and every left part meets every right part in a block of its own. So no join key holds more
than about ``limit`` rows of a side, whatever the data; a pair still meets in one place only.

A cell is (``_lv``, ``_cell``, ``_block``): its level, its packed column and row at that level, and the block.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage_table

#: Column and row are packed into one BIGINT.
CELL_SHIFT = 4294967296
#: Rows of a side that a cell may hold, and levels below the first grid.
LIMIT, LEVELS = 8192, 8
#: A cut is worth it if it leaves at most this share of the cell's row pairs, or hardly multiplies its rows: then finer cuts may separate them.
WORK, COPIES = 0.9, 1.2
KEYS = ["_lv", "_cell", "_block"]


def at_level(coordinate: str, c: float, level: str = "0") -> str:
    """Column or row number of a coordinate. Halving cells is exact in binary, so children lie inside their parents."""
    scale = f" * cast(shiftleft(1L, {level}) AS double)" if level != "0" else ""
    return f"cast(floor(({coordinate}) / {c}{scale}) AS bigint)"


def packed(cx: str, cy: str) -> str:
    return f"({cx} * {CELL_SHIFT} + {cy})"


def covered(df: DataFrame, s: str, c: float, d: float) -> DataFrame:
    """One row per covered cell of the first grid: _cx, _cy."""
    def span(axis):
        return F.explode(F.expr(f"sequence({at_level(f'{s}.{axis}min - {d}', c)}, {at_level(f'{s}.{axis}max + {d}', c)})"))
    return df.withColumn("_cx", span("x")).withColumn("_cy", span("y"))


def _children(df: DataFrame, s: str, c: float, d: float | str, level: int) -> DataFrame:
    """Rows of cells of ``level - 1`` -> one row per child that the row's box covers."""
    def span(axis, own):
        low, high = at_level(f"{s}.{axis}min - {d}", c, str(level)), at_level(f"{s}.{axis}max + {d}", c, str(level))
        return F.explode(F.expr(f"sequence(greatest({low}, 2 * {own}), least({high}, 2 * {own} + 1))"))
    return df.withColumn("_x", span("x", "_cx")).withColumn("_cy", span("y", "_cy")).withColumn("_cx", F.col("_x")).drop("_x")


@dataclass
class Grid:
    """``splits``: for each level the cells that are cut (_cx, _cy). ``stacks``: _lv, _cx, _cy, kl, kr of cells dealt into blocks, if any."""

    cell: float
    distance: float
    splits: list[DataFrame]
    stacks: DataFrame | None

    @property
    def plain(self) -> bool:
        return not self.splits and self.stacks is None

    def place(self, df: DataFrame, s: str, left: bool) -> DataFrame:
        """One row per cell (and block) that a row's box covers; the left side's boxes are grown by the distance."""
        c, d = self.cell, self.distance if left else 0.0
        out = covered(df, s, c, d)
        if self.plain:
            return out.withColumn("_cell", F.expr(packed("_cx", "_cy"))).drop("_cx", "_cy")
        done, names = None, df.columns
        for level, cut in enumerate([*self.splits, None]):
            out = out.withColumn("_lv", F.lit(level))
            if cut is None:
                leaf = out
            else:  # hot cells by definition: the cut cells were written, so a hot one can be split on this side
                marked = out.join(cut.withColumn("_cut", F.lit(True)), ["_cx", "_cy"], "left")
                leaf = marked.where("_cut is null").drop("_cut")
                out = _children(marked.where("_cut").drop("_cut", "_lv"), s, c, d, level + 1)
            leaf = leaf.select(*names, "_lv", "_cx", "_cy")
            done = leaf if done is None else done.unionByName(leaf)
        own, other = ("kl", "kr") if left else ("kr", "kl")
        if self.stacks is None:
            return done.withColumn("_cell", F.expr(packed("_cx", "_cy"))).withColumn("_block", F.lit(0)).drop("_cx", "_cy")
        done = done.join(self.stacks, ["_lv", "_cx", "_cy"], "left")
        hashed = [f.name for f in df.schema.fields if not f.dataType.simpleString().startswith(("map", "variant"))]
        part = F.pmod(F.xxhash64(*hashed), F.coalesce(F.col(own), F.lit(1)))  # any part will do: it meets all of the other side
        blocks = f"transform(sequence(0, coalesce({other}, 1) - 1), k_ -> cast({'_part * coalesce(kr, 1) + k_' if left else 'k_ * coalesce(kr, 1) + _part'} AS bigint))"
        return (done.withColumn("_part", part).withColumn("_block", F.explode(F.expr(blocks))).withColumn("_cell", F.expr(packed("_cx", "_cy")))
                .drop("_cx", "_cy", "_part", "kl", "kr"))

    @property
    def keys(self) -> list[str]:
        return ["_cell"] if self.plain else KEYS

    def owner(self, a: str, b: str) -> Column:
        """The pair's own cell: that of the lower left corner of the two boxes' intersection. Both boxes cover it, so it holds the pair once."""
        d, lv = self.distance, "0" if self.plain else "_lv"
        x, y = (at_level(f"greatest({a}.{axis}min - {d}, {b}.{axis}min)", self.cell, lv) for axis in "xy")
        return F.expr(f"_cell = {packed(x, y)}")


def build(left: DataFrame, right: DataFrame, left_shape: str, right_shape: str, cell: float, distance: float = 0.0, limit: int | None = LIMIT) -> Grid:
    """Count the rows of each cell and cut where there are too many. One aggregation of box coordinates where no cell is dense; one more
    for every level that needs cutting, over the rows of dense cells only. ``limit=None``: the plain grid."""
    grid = Grid(float(cell), float(distance), [], None)
    if limit is None:
        return grid
    box = lambda df, s, side: df.select(F.struct(*[F.col(f"{s}.{k}").alias(k) for k in ("xmin", "ymin", "xmax", "ymax")]).alias("s"), F.lit(side).alias("left"))
    sides = [box(left, left_shape, True), box(right, right_shape, False)]
    rows = [covered(x, "s", grid.cell, grid.distance if k == 0 else 0.0) for k, x in enumerate(sides)]
    rows = rows[0].unionByName(rows[1])
    dense = F.greatest("nl", "nr") > limit
    counts = lambda r: r.groupBy("_cx", "_cy").agg(F.count_if("left").alias("nl"), F.count_if(~F.col("left")).alias("nr"))
    hot, stacks = counts(rows).where(dense), []
    if hot.isEmpty():
        return grid
    hot = stage_table(hot)
    for level in range(LEVELS + 1):
        if level == LEVELS:
            stacks.append(hot.withColumn("_lv", F.lit(level)))
            break
        # a cell with rows of one side only has no pairs: its rows are just dealt out
        stacks.append(hot.where("nl = 0 or nr = 0").withColumn("_lv", F.lit(level)))
        hot = hot.where("nl > 0 and nr > 0")
        # rows of hot cells, one per child; a child of a cell takes its parent's place
        kept = rows.join(hot.select("_cx", "_cy"), ["_cx", "_cy"], "left_semi")
        moved = stage_table(_children(kept, "s", grid.cell, f"if(left, {grid.distance}D, 0D)", level + 1))
        below = stage_table(counts(moved))
        below = below.withColumn("_px", F.floor(F.col("_cx") / 2)).withColumn("_py", F.floor(F.col("_cy") / 2))
        sums = below.groupBy(F.col("_px").alias("_cx"), F.col("_py").alias("_cy")).agg(F.sum("nl").alias("cl"), F.sum("nr").alias("cr"), F.sum(F.col("nl").cast("double") * F.col("nr")).alias("work"))
        worth = F.expr(f"work <= {WORK} * nl * nr or (cl <= {COPIES} * nl and cr <= {COPIES} * nr)")
        weighed = stage_table(hot.join(sums, ["_cx", "_cy"]).withColumn("_worth", worth))
        stacks.append(weighed.where("not _worth").select("_cx", "_cy", "nl", "nr").withColumn("_lv", F.lit(level)))
        cut = stage_table(weighed.where("_worth").select("_cx", "_cy"))
        if cut.isEmpty():
            break
        grid.splits.append(cut)
        up = cut.select(F.col("_cx").alias("_px"), F.col("_cy").alias("_py"))
        below = below.join(up, ["_px", "_py"], "left_semi").select("_cx", "_cy", "nl", "nr")
        hot = stage_table(below.where(dense))
        if hot.isEmpty():
            break
        rows = moved
    parts = lambda n: F.expr(f"cast(greatest(1, ({n} + {limit - 1}) div {limit}) AS int)")
    piled = None
    for s in stacks:
        piled = s if piled is None else piled.unionByName(s)
    if piled is not None:
        piled = stage_table(piled.select("_lv", "_cx", "_cy", parts("nl").alias("kl"), parts("nr").alias("kr")))
        grid.stacks = None if piled.isEmpty() else piled
    return grid
