"""Near-duplicate vectors: iterative quantisation, multi-index Hamming tables, exact rerank.

1. A rotation of the principal axes is learned on a bounded sample so that the signs of the rotated
   vectors make balanced, low-loss binary codes (alternating between codes and an orthogonal Procrustes step).
2. Every vector's code is cut into ``tables`` substrings; each indexes one hash table. Two codes that differ in fewer bits than there
   are tables agree in at least one substring, so all such pairs meet in a bucket.
3. Buckets are worked off in blocks: large ones are dealt into chunks, and each pair of chunks is one cell of bounded size. A cell
   compares its original vectors by one matrix product in double precision, counts each
   linked pair in the first table where it meets, and gives links only as a spanning forest. Pairs are never listed.

Equal vectors are one class with a multiplicity. Nothing is capped: every vector is in every table, and every bucket is
compared in full.

Defined results: vectors that are null, empty, all zero, or hold null or non-finite components link with nothing (0 links, own
component, kept); vectors of different lengths never link; each length has its own rotation; a null id is
ignored when the smallest id is taken. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pin
from .components import Forest, connected

#: Bits of a code at most, and rows of a chunk of a large bucket.
BITS, CHUNK = 64, 1024


def learn_rotation(sample: np.ndarray, seed: int = 3, rounds: int = 40) -> np.ndarray:
    """(dimensions, bits): principal axes times the learned rotation."""
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    bits = min(BITS, unit.shape[1])
    _, _, axes = np.linalg.svd(unit.T @ unit)
    projected = unit @ axes[:bits].T
    turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, bits)))[0]
    for _ in range(rounds):
        codes = np.where(projected @ turn >= 0, 1.0, -1.0)
        u, _, v = np.linalg.svd(codes.T @ projected)
        turn = (u @ v).T
    return axes[:bits].T @ turn


def _substrings(codes: np.ndarray, tables: int) -> np.ndarray:
    """(n, tables) integers from (n, bits) booleans."""
    parts = np.array_split(np.arange(codes.shape[1]), tables)
    return np.stack([codes[:, p] @ (1 << np.arange(len(p))) for p in parts], axis=1).astype(np.int64)


def _index(classes: DataFrame, rotations: dict[int, np.ndarray], tables: int) -> DataFrame:
    """key, v, mult -> one row a table: dim, tab, sub, key, mult, subs (all substrings), unit (vector of length 1)."""
    shared = classes.sparkSession.sparkContext.broadcast(rotations)  # dimensions x bits each

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("v")
            lengths = np.diff(column.offsets.to_numpy())
            for dim in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == dim)
                x = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                x = x / np.abs(x).max(axis=1, keepdims=True)  # huge or tiny components must not overflow the norm
                x = x / np.linalg.norm(x, axis=1, keepdims=True)
                turn = shared.value.get(dim)
                if turn is None:  # a length that the sample missed
                    turn = np.linalg.qr(np.random.default_rng(dim).normal(size=(dim, dim)))[0][:, :BITS]
                codes = x @ turn >= 0
                subs = _substrings(codes, min(tables, codes.shape[1]))
                keys, mult = (batch.column(c).take(pa.array(rows)) for c in ("key", "mult"))
                units = pa.array([r.tobytes() for r in x], pa.binary())
                wide = pa.array([s.tobytes() for s in subs], pa.binary())
                for t in range(subs.shape[1]):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), dim)), pa.array(np.full(len(rows), t)), pa.array(subs[:, t]), keys, mult, wide, units],
                                                     names=["dim", "tab", "sub", "key", "mult", "subs", "unit"])

    return classes.mapInArrow(run, "dim bigint, tab bigint, sub bigint, key bigint, mult bigint, subs binary, unit binary")


def _compare(least: float):
    def run(cell: pa.Table) -> pa.Table:
        cell = cell.combine_chunks()
        keys, mult, chunk = (cell.column(c).to_numpy() for c in ("key", "mult", "chunk"))
        order = np.lexsort((keys, chunk))
        keys, mult, chunk = keys[order], mult[order], chunk[order]
        unit = np.stack([np.frombuffer(x, np.float64) for x in cell.column("unit").to_pylist()])[order]
        subs = np.stack([np.frombuffer(x, np.int64) for x in cell.column("subs").to_pylist()])[order]
        tab, n = int(cell.column("tab")[0].as_py()), len(keys)
        crossing = chunk[0] != chunk[-1] or int(cell.column("a")[0].as_py()) != int(cell.column("b")[0].as_py())
        counts, forest = np.zeros(n, np.int64), Forest()
        for at in range(0, n, 256):
            i, j = np.nonzero(unit[at:at + 256] @ unit.T >= least)
            i += at
            keep = i < j
            if crossing:  # pairs within a chunk belong to the chunk's own cell
                keep &= chunk[i] != chunk[j]
            i, j = i[keep], j[keep]
            first = np.argmax(subs[i] == subs[j], axis=1) == tab if len(i) else np.zeros(0, bool)
            i, j = i[first], j[first]
            np.add.at(counts, i, mult[j])
            np.add.at(counts, j, mult[i])
            linked = np.zeros((min(256, n - at), n), bool)
            linked[i - at, j] = True
            for r in np.flatnonzero(linked.any(axis=1)).tolist():
                for c in np.flatnonzero(linked[r]).tolist():
                    if forest.find(r + at) != forest.find(c):
                        forest.join(r + at, c)
        hit = np.flatnonzero(counts)
        roots = np.array([keys[forest.find(int(h))] for h in hit], np.int64)
        return pa.table({"key": pa.array(keys[hit], pa.int64()), "n": pa.array(counts[hit], pa.int64()), "root": pa.array(roots, pa.int64())})
    return run


def near_duplicates(vectors: DataFrame, least: float = 0.9, tables: int = 8, sample_rows: int = 20_000, seed: int = 3,
                    id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per vector: id, n_links, component_id, kept. ``sample_rows`` bounds the rows the rotation is learned on."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) | (F.size("v") <= 0) | ~F.exists("v", lambda x: x != 0)
    rows = pin(rows.withColumn("ok", F.coalesce(~odd, F.lit(False))).withColumn("h", F.when(F.col("ok"), F.xxhash64("v"))))
    classes = rows.where("ok").groupBy("h", "v").agg(F.min("id").alias("first"), F.count("*").alias("mult"))
    classes = pin(classes.withColumn("key", F.col("h")))
    sample = classes.select("v", "h", "key").orderBy(F.xxhash64(F.lit(seed), "h"), "key").limit(sample_rows).collect()
    by_dim: dict[int, list] = {}
    for r in sample:
        by_dim.setdefault(len(r["v"]), []).append(r["v"])
    rotations = {}
    for dim, found in by_dim.items():
        x = np.array(found, np.float64)
        rotations[dim] = learn_rotation(x / np.abs(x).max(axis=1, keepdims=True), seed)

    indexed = _index(classes.select("key", "v", "mult"), rotations, tables)
    bucket = ["dim", "tab", "sub"]
    # Buckets of more than one vector; tables x 2^(bits / tables) buckets a length at most.
    sizes = pin(indexed.groupBy(*bucket).agg(F.count("*").alias("m")).where("m > 1"))
    chunks = F.ceil(F.col("m") / CHUNK).cast("bigint")
    chunked = indexed.join(sizes, bucket).withColumn("chunks", chunks).withColumn("chunk", F.pmod(F.xxhash64("key"), F.col("chunks")))
    cells = (chunked.withColumn("o", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)))
             .withColumn("a", F.least("chunk", "o")).withColumn("b", F.greatest("chunk", "o")).drop("o", "m", "chunks"))
    found = pin(cells.groupBy(*bucket, "a", "b").applyInArrow(_compare(least), "key bigint, n bigint, root bigint"))

    counted = found.groupBy("key").agg(F.sum("n").alias("n"))
    groups = connected(found.select(F.col("key").alias("a"), F.col("root").alias("b")))
    done = pin(classes.select("h", "v", "key", "first", "mult").join(counted, "key", "left")
               .join(groups.withColumnRenamed("id", "key"), "key", "left"))
    lowest = done.groupBy(F.coalesce("component", "key").alias("component")).agg(F.min("first").alias("low"))
    done = pin(done.withColumn("component", F.coalesce("component", "key")).join(lowest, "component")
               .select("h", "v", "low", (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n")))
    out = rows.join(done, ["h", "v"], "left")
    component = F.coalesce("low", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"))
