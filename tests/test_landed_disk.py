"""What the landed runs send and write: values before their JSON, pairs without a join back, well compressed stage tables."""

from pathlib import Path

from landlens.operators.overlay import any_hit, is_kind, overlay_summary
from landlens.plans import landed as LA
from landlens.session import stage_table
from landlens.sources import derived as D
from pyspark.sql import functions as F
from test_scale_steps import plan, squares

TABLES = "/root/testdata/sf0.001"


def test_pages_group_values_and_write_json_after_the_shuffle(spark):
    layer = squares(spark, "k", 3).withColumn("n", F.when(F.col("k") != "1", F.col("k").cast("int")))
    pages = LA._pages(layer, "k", {"EGID": "k", "FLOORS": "n"}, "cast(k as bigint) div 2")
    assert "Feature" not in plan(pages).split("Exchange", 1)[1]
    ring = '"geometry":{"type":"Polygon","coordinates":[[[%s.0,0.0],[%s.0,0.0],[%s.0,100.0],[%s.0,100.0],[%s.0,0.0]]]}}'
    feature = lambda k, props, x: f'{{"type":"Feature","id":"{k}","properties":{props},' + ring % (x, x + 100, x + 100, x, x)
    got = {r["page_no"]: r["page_json"] for r in pages.collect()}
    assert got[1] == '{"type":"FeatureCollection","features":[' + feature(2, '{"EGID":"2","FLOORS":"2"}', 80) + "]}"
    null = spark.range(1).select(F.to_json(F.expr("map('EGID', '1', 'FLOORS', cast(null as string))"))).first()[0]
    assert feature(0, '{"EGID":"0","FLOORS":"0"}', 0) in got[0] and feature(1, null, 40) in got[0] and got.keys() == {0, 1}


def test_overlay_of_any_shapes_brings_columns_without_a_join_back_of_boxes(spark):
    a = squares(spark, "a", 12)
    mixed = squares(spark, "b", 12, rect=False).withColumn("n", F.when(F.col("b") != "4", F.col("b").cast("int")))
    other = squares(spark, "b", 1)  # lacks n
    got = overlay_summary(a, "a", {"x": mixed, "y": other}, [any_hit("y", "y"), F.sort_array(F.collect_list(F.when(is_kind("x"), F.coalesce("n", F.lit(-1))))).alias("n")],
                          columns=["n"], cell=64.0, join_back=False)
    assert "hashpartitioning(_rid" not in plan(got)
    want = {i: (i < 3, sorted(-1 if j == 4 else j for j in range(max(0, i - 2), min(12, i + 3)))) for i in range(12)}
    assert {int(r["a"]): (r["y"], r["n"]) for r in got.collect()} == want


def test_stage_tables_are_compressed_well(spark):
    files = [Path(p.removeprefix("file:")) for p in stage_table(D.parcels(spark, TABLES)).inputFiles()]
    assert files and all(".zstd." in p.name for p in files)
