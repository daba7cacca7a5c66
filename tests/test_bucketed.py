"""Key-hash buckets, the last-state table, repeatable zone keys and the position of a value."""

from collections import Counter

import pytest
from landlens.functions import geometry as G
from landlens.operators import state as S
from landlens.plans import changes as C
from landlens.plans import profile as PR
from landlens.plans import zones as Z
from landlens.sources.bucketed import BucketedTable
from pyspark.sql import functions as F


def files(path):
    return {p.parent.name: p.name for p in path.rglob("*.parquet")}


def test_upsert_rewrites_only_touched_buckets(spark, tmp_path):
    old = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"), F.lit(1.0).alias("area"), F.col("id").alias("uid"))
    table = BucketedTable(spark, str(tmp_path / "t"), "key", 256)
    table.create(old)
    before = files(tmp_path)
    new = spark.range(4990, 5090).select(F.concat(F.lit("k"), "id").alias("key"), F.lit(2.0).alias("area"), F.lit(-1).cast("bigint").alias("uid"))
    touched = table.upsert(new, ["area"])
    after = files(tmp_path)
    changed = {b for b in after if before.get(b) != after[b]}
    assert 0 < len(changed) <= min(100, len(touched)) and len(before) == 256
    want = {tuple(r) for r in S.upsert(old, new, "key", ["area"]).collect()}
    assert {tuple(r) for r in table.read().collect()} == want and len(want) == 5090
    table.upsert(new, ["area"])  # a second try
    assert Counter(tuple(r) for r in table.read().collect()) == dict.fromkeys(want, 1)


def test_a_repeated_key_fails_inside_the_plan(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), "key", 4)
    table.create(spark.createDataFrame([("a", 1), ("b", 2)], "key string, v int"))
    twice = spark.createDataFrame([("a", 5), ("a", 6), (None, 7), (None, 7)], "key string, v int")
    planned = S.upsert(table.read(), twice, "key", ["v"], check="plan")  # no job yet
    with pytest.raises(Exception, match="duplicate key in upsert batch: a"):
        planned.collect()
    with pytest.raises(Exception, match="duplicate key"):
        table.upsert(twice, ["v"])
    assert sorted(map(tuple, table.read().collect())) == [("a", 1), ("b", 2)]


def test_replace_keys_and_emptied_buckets(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), "key", 8)
    table.create(spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4)], "key string, v int"))
    keys = spark.createDataFrame([("a",), ("c",), ("z",)], "key string")
    rows = spark.createDataFrame([("c", 9), ("c", 10), ("b", 99)], "key string, v int")
    for _ in range(2):
        table.replace_keys(rows, keys)
        assert sorted(map(tuple, table.read().collect())) == [("b", 3), ("c", 9), ("c", 10)]


def test_last_state_equals_the_whole_log(spark, tmp_path):
    log = [(f"p{(i * 7 + r) % 50}", f"2025-01-0{r + 1} 00:00:00", f"h{i % 4}{r}") for r in range(4) for i in range(0, 50, r + 1)]
    log = spark.createDataFrame(log, "egrid string, run_ts string, content_hash string").withColumn("run_ts", F.to_timestamp("run_ts")).distinct()
    last = C.LastState(spark, str(tmp_path / "last"), 8)
    for r in range(4):
        rows = log.where(F.col("run_ts") == F.to_timestamp(F.lit(f"2025-01-0{r + 1} 00:00:00"))).groupBy("egrid", "run_ts").agg(F.min("content_hash").alias("content_hash"))
        last.start(rows) if r == 0 else last.merge(rows)
    want = C.latest(log.groupBy("egrid", "run_ts").agg(F.min("content_hash").alias("content_hash")))
    assert sorted(map(tuple, last.hashes().collect())) == sorted(map(tuple, want.collect()))
    old = log.where(F.col("run_ts") == F.to_timestamp(F.lit("2025-01-01 00:00:00"))).limit(3)
    last.merge(old)  # a late, older run changes nothing
    assert sorted(map(tuple, last.hashes().collect())) == sorted(map(tuple, want.collect()))


def test_zone_keys_after_a_reshuffle(spark):
    zone = spark.range(10_000).select(F.when(F.col("id") % 10 < 8, "same").otherwise("").alias("zone_id"), F.lit(1).alias("commune_bfs"), F.lit("t").alias("typ_kt"), F.lit("h").alias("hauptnutzung"),
                                      F.lit(True).alias("is_building_zone"), F.lit("D3").alias("zone_code"), F.when(F.col("id") % 10 == 9, F.col("id") % 3).cast("int").alias("height_limit_m"),
                                      F.lit("1").alias("density_indice"), F.lit(0.0).alias("x"), F.lit(9.0).alias("y"))
    zone = zone.withColumn("shape", G.shape_from_box("x", "x", "y", "y")).drop("x", "y")
    keys = lambda df: [r["zone_uid"] for r in Z.zone_base(df).select("zone_uid").collect()]
    one, two = keys(zone.repartition(3)), keys(zone.orderBy(F.rand(5)).repartition(7))
    assert len(set(one)) == len(one) == 10_000 and sorted(one) == sorted(two)


def test_position_with_ties_and_nulls(spark):
    df = lambda rows: spark.createDataFrame(rows, "v string, k int")
    pos = lambda rows: {r["value"]: r["first_pos"] for r in PR.value_mix(df(rows), "v", "k", "VD").collect()}.get("VD")
    assert pos([("GE", 1), ("GE", 2), ("VD", 3), ("GE", 3), ("VD", 4)]) == 3
    assert pos([("GE", 1), ("VD", 1), ("GE", None)]) == 1
    assert pos([("GE", 1), ("GE", None), ("VD", None), (None, 7)]) == 3
    assert pos([("GE", 1)]) is None and pos([]) is None
