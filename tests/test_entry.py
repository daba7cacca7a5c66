import __spark_entry__ as E


def test_contract(spark):
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 100
    df = E.entry(spark)
    assert df.count() > 0 and "zone_id" in df.columns
