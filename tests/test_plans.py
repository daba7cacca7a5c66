"""Physical-plan properties that must hold at any scale."""

import pytest
from pyspark.sql import functions as F

from landlens.plans.queries import QUERIES

D = "/root/testdata/sf0.001"
SPATIAL = ["job_enrich_parcels", "job_score_parcels", "job_zone_phase_a", "job_zone_phase_b",
           "geo_overlap_area", "geo_dwithin", "geo_contains", "join_spatial_inner", "join_dwithin_self",
           "job_restriction_refresh", "job_detect_changes"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", SPATIAL)
def test_no_nested_loop_or_cartesian(spark, monkeypatch, name):
    """With pinning off, so that the plan holds every join of the job and not a scan of its pinned result."""
    from landlens.plans.inputs import Layers
    monkeypatch.setattr(Layers, "pin", lambda self, df: df)
    p = plan(QUERIES[name](spark, D))
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p, name
    assert "Join" in p, name


def test_upsert_joins_on_the_key(spark):
    """The merge inside a bucketed upsert (the query itself ends in the stored table)."""
    from landlens.operators import state as S
    old, new = (spark.range(n).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v")) for n in (50, 60))
    p = plan(S.upsert(old, new, "k", ["v"], check="plan"))
    assert "Join" in p and "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_building_read_is_narrow(spark):
    """Only the columns the building layer needs are read; the envelope is a subquery of the same plan."""
    from landlens.plans.inputs import Layers
    from landlens.plans import zones as Z
    L = Layers(spark, D)
    extent = Z.target_extent(L.zones_a)
    p = plan(Z.within_envelope(L.buildings, *[extent.select(c).scalar() for c in ("xmin", "ymin", "xmax", "ymax")]))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_tax:double,l_returnflag:string>" in p
    assert "Subquery" in p


def test_value_filter_reaches_the_scan(spark):
    from landlens.sources import derived as DV
    p = plan(DV.table(spark, D, "events").where("value < 20").select("event_id"))
    assert "PushedFilters: [IsNotNull(value), LessThan(value,20.0)]" in p and "ReadSchema: struct<event_id:bigint,value:double>" in p
