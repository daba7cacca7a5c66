"""Attribute-filtered reads of a layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filter_or_all(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows matching ``predicate``; when none match, all rows. ``branch`` says which applied ('filtered' or 'all').

    Whether any row matches is a scalar subquery of the same plan, so nothing runs while the plan is built.
    """
    some = df.agg(F.coalesce(F.bool_or(predicate), F.lit(False))).scalar()
    return (df.withColumn("branch", F.when(some, F.lit("filtered")).otherwise(F.lit("all")))
            .where(F.coalesce(predicate, F.lit(False)) | (F.col("branch") == "all")))
