"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Texts are equal when they are identical after every run of white space
(blank, U+0009..U+000D) became one blank. The rows are refined in three steps, each of which
only sees what survived the one before: rows that share their length in bytes; of those, rows that
also share the hash of their first ``prefix`` characters; of those, rows that share the
SHA-256 of the whole text. Only the last step reads full content.

Defined results: a null text counts as empty; null and empty texts are one group; a null id sorts after all
others; of several rows with the smallest id all are reported as kept (they are alike in
id and text), and ``drop_exact_duplicates`` keeps one of them. An empty table gives an empty result. Other
columns, whatever their names, are carried in one struct and never looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, pin, text_or_empty

LENGTH, PREFIX, FULL, MANY = "__len", "__prefix", "__full", "__many"


def normalised(text: Column) -> Column:
    return F.regexp_replace(text_or_empty(text), SPACES, " ")


def _survivors(signatures: DataFrame) -> DataFrame:
    """(length, prefix hash) pairs of more than one row."""
    lengths = signatures.groupBy(LENGTH).agg(F.count("*").alias("n")).where("n > 1").select(LENGTH)
    pairs = signatures.groupBy(LENGTH, PREFIX).agg(F.count("*").alias("n"))  # before the join: a hot length is a few rows a task
    return pairs.join(lengths, LENGTH, "left_semi").where("n > 1").select(LENGTH, PREFIX, F.lit(True).alias(MANY))


def _refined(docs: DataFrame, id_col: str, text_col: str, prefix: int, carried: list[Column],
             digest_all: bool) -> DataFrame:
    """One row per document: id, carried columns, the refinement keys; FULL is null where a
    document fell out before the last step (unless the caller needs every digest)."""
    text = normalised(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("__id"), text.alias("__text"), *carried)
    rows = rows.select("*", F.octet_length("__text").alias(LENGTH),
                       F.xxhash64(F.substring("__text", 1, prefix)).alias(PREFIX))
    many = pin(_survivors(pin(rows.select(LENGTH, PREFIX))))  # a join can only split a hot key if neither side is aggregated in its stage
    digest = F.sha2(F.col("__text"), 256)
    if digest_all:  # the caller reads every text anyway: hash before the shuffle, which then moves no text
        rows = rows.withColumn(FULL, digest).drop("__text")
        return rows.join(many, [LENGTH, PREFIX], "left")
    return (rows.join(many, [LENGTH, PREFIX], "left")
            .withColumn(FULL, F.when(F.col(MANY), digest)).drop("__text"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = 256) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256 (of the normalised text)."""
    rows = pin(_refined(docs, id_col, text_col, prefix, [], True))
    groups = pin(rows.where(F.col(MANY)).groupBy(LENGTH, PREFIX, FULL)
                 .agg(F.min("__id").alias("__keep"), F.count("*").alias("__n")).where("__n > 1"))
    alone = F.col("__n").isNull()
    keep = F.when(alone, F.col("__id")).otherwise(F.col("__keep"))
    return (rows.join(groups, [LENGTH, PREFIX, FULL], "left")
            .select(F.col("__id").alias(id_col), keep.alias("keep_id"),
                    F.coalesce("__n", F.lit(1)).cast("bigint").alias("group_size"),
                    F.col("__id").eqNullSafe(keep).alias("kept"), F.col(FULL).alias("text_sha256")))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          prefix: int = 256) -> DataFrame:
    """``docs`` with one row of each group of equal texts: the one with the smallest id."""
    rows = _refined(docs, id_col, text_col, prefix, [F.struct("*").alias("__row")], False)
    apart = rows.where(F.col(MANY).isNull())
    shared = rows.where(F.col(MANY))
    keys = [LENGTH, PREFIX, FULL]
    groups = pin(shared.groupBy(*keys, "__id").agg(F.count("*").alias("__c"))
              .groupBy(*keys).agg(F.min(F.struct(F.col("__id").isNull().alias("u"), F.col("__id").alias("i"),
                                                 F.col("__c").alias("c"))).alias("__first")))
    kept = (shared.join(groups, keys).where(F.col("__id").eqNullSafe(F.col("__first.i"))))
    once = kept.where("__first.c = 1")
    repeated = kept.where("__first.c > 1").dropDuplicates(keys)
    parts = [apart.select("__row.*"), once.select("__row.*"), repeated.select("__row.*")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
