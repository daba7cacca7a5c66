"""Connected components of an edge table by alternating large and small stars.

Each round is two aggregations and two joins over narrow rows; edges are first contracted within every task, so a
vertex of very many edges arrives as at most one edge a member and task. Nothing is collected but one count and checksum a round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pin


class Forest:
    """Union-find over arbitrary integers; the smallest member is the root."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        root = x
        while up.setdefault(root, root) != root:
            root = up[root]
        while up[x] != root:
            up[x], x = root, up[x]
        return root

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's edges as stars. Memory: the vertices of one task's share of the edges."""
    forest = Forest()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            forest.join(a, b)
    rows = [(x, forest.find(x)) for x in list(forest.up)]
    rows = np.array([r for r in rows if r[0] != r[1]], np.int64).reshape(-1, 2)
    yield pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1])], names=["u", "v"])


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected(edges: DataFrame) -> DataFrame:
    """``edges`` (a bigint, b bigint) -> (id, component): each vertex of an edge with the smallest vertex it reaches."""
    now = pin(edges.select("a", "b").where("a <> b").mapInArrow(_contract, "u bigint, v bigint").distinct())
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = pin(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = pin(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = pin(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        now, before = pin(small.distinct()), state
        state = _state(now)
        if state == before:
            break
    roots = now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
