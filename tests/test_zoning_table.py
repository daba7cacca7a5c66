"""The zoning layer is typed once a run, by all tasks."""

from landlens.functions import geometry as G
from landlens.plans.inputs import Layers
from landlens.sources import derived as D
from pyspark.sql import functions as F


def parts(spark, folder, n=40):
    spark.range(n).select(F.col("id").alias("p_partkey"), (F.col("id") % 16).cast("int").alias("p_size"), F.lit("LARGE TIN").alias("p_type")).coalesce(1).write.parquet(f"{folder}/part.parquet")
    spark.range(25).select(F.col("id").cast("int").alias("n_nationkey"), F.concat(F.lit("NATION_"), "id").alias("n_name")).coalesce(1).write.parquet(f"{folder}/nation.parquet")


def test_zoning_is_typed_once_and_by_all_tasks(spark, tmp_path):
    parts(spark, tmp_path)
    assert D.zoning_features(spark, str(tmp_path)).rdd.getNumPartitions() >= int(spark.conf.get("spark.sql.shuffle.partitions"))
    layers = Layers(spark, str(tmp_path))
    kept = layers.zoning_table
    assert "part.parquet" not in kept._jdf.queryExecution().executedPlan().toString() and G.is_rect_only(kept)
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, layers.zoning.collect()))
