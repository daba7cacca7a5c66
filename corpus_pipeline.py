"""Corpus pipeline: quality filter, exact dedup, near dedup, source mix, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next one's ``docs``. All but the last return the columns
of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landlens.llm import exact_dedup, mixing, ngram_join, packing, quality
from landlens.llm.common import on_workers
from landlens.llm.queries import HELD_OUT, KEEP_FROM
from landlens.session import ensure_checkpoint_dir

#: Weights of the sources in code-point order, repeating.
WEIGHTS = [5, 2, 1]


def drop_bad(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below ``KEEP_FROM`` go. Learned from labelled documents outside the held-out fifth."""
    on_workers(spark)
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~F.expr(HELD_OUT))
    return quality.score(docs, model, as_col="__score").where(F.col("__score") >= KEEP_FROM).drop("__score")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (white space aside) the row with the smallest doc_id stays."""
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents (five-word shingles, Jaccard of 0.8 or more, linked) the row with the smallest doc_id stays, nulls last."""
    return ngram_join.drop_similar(docs, size=5, num=80, den=100)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs, WEIGHTS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a packed sequence."""
    on_workers(spark)
    return packing.pack(docs.select("doc_id", "text"))


STAGES = [("quality classifier", drop_bad), ("exact dedup", drop_copies), ("near dedup", drop_near_copies), ("source mix", mix_sources), ("packing", pack_sequences)]

#: The classifier, the knapsack and the packing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        out = f"{folder}/{k}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
