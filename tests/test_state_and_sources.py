import pytest
from pyspark.sql import functions as F

from landlens.functions import rules as R
from landlens.operators import state as S
from landlens.plans import profile as PR
from landlens.sources import geojson as J
from landlens.sources import paging as PG
from landlens.sources.store import TableStore


def test_upsert_semantics(spark):
    old = spark.createDataFrame([("A", 1.0, "uid-a", "old"), ("B", 2.0, "uid-b", "old"), (None, 3.0, "uid-n", "old")],
                                "egrid string, area double, uid string, note string")
    new = spark.createDataFrame([("B", 20.0, "uid-b2"), ("C", 30.0, "uid-c"), (None, 40.0, "uid-n2")],
                                "egrid string, area double, uid string")
    got = {(r["egrid"], r["uid"]): r for r in S.upsert(old, new, "egrid", ["area"]).collect()}
    assert got[("A", "uid-a")]["area"] == 1.0                      # absent from new: retained
    assert got[("B", "uid-b")]["area"] == 20.0                     # matched: updated, uid kept
    assert got[("B", "uid-b")]["note"] == "old"
    assert got[("C", "uid-c")]["note"] is None                     # inserted
    assert (None, "uid-n") in got and (None, "uid-n2") in got      # NULL keys never conflict
    assert len(got) == 5


def test_upsert_duplicate_key_rejected(spark):
    old = spark.createDataFrame([("A", 1.0)], "egrid string, area double")
    new = spark.createDataFrame([("A", 1.0), ("A", 2.0)], "egrid string, area double")
    with pytest.raises(S.DuplicateKeyError):
        S.upsert(old, new, "egrid", ["area"])


def test_replace_keys_and_migrate(spark):
    old = spark.createDataFrame([("A", "x"), ("A", "y"), ("B", "z")], "egrid string, v string")
    new = spark.createDataFrame([("A", "n1"), ("C", "n2")], "egrid string, v string")
    keys = spark.createDataFrame([("A",), ("C",)], "egrid string")
    got = sorted(tuple(r) for r in S.replace_keys(old, new, keys, "egrid").collect())
    assert got == [("A", "n1"), ("B", "z"), ("C", "n2")]
    m = S.migrate(old, {"n": ("bigint", 0), "v": ("string", "ignored"), "avg": ("double", None)})
    r = m.where("egrid = 'B'").first()
    assert r["n"] == 0 and r["v"] == "z" and r["avg"] is None


def test_update_from_keeps_unmatched(spark):
    t = spark.createDataFrame([("A", "old"), ("B", "old")], "egrid string, zone string")
    s = spark.createDataFrame([("A", None)], "egrid string, z string")
    got = {r["egrid"]: r["zone"] for r in S.update_from(t, s, "egrid", {"zone": "z"}).collect()}
    assert got == {"A": None, "B": "old"}


def test_filter_or_all(spark):
    df = spark.range(10)
    some, none = PG.filter_or_all(df, F.col("id") > 7), PG.filter_or_all(df, F.col("id") > 70)
    assert sorted(r["id"] for r in some.collect()) == [8, 9] and {r["branch"] for r in some.collect()} == {"filtered"}
    assert none.count() == 10 and {r["branch"] for r in none.collect()} == {"all"}


def test_value_counts_keeps_every_key(spark):
    df = spark.range(40).select(F.create_map(F.lit("a"), F.col("id").cast("string"), F.lit("b"), F.lit(None).cast("string")).alias("properties"))
    got = {(r["key"], r["value"]): (r["n"], r["n_distinct"]) for r in PR.value_counts(df).collect()}
    assert len(got) == 41 and got[("b", "None")] == (40, 1) and got[("a", "7")] == (1, 40)


def test_casts_and_empties(spark):
    n = R.NUMBER_MARK
    rows = [("\t11\n",), (n + "5.0",), ("5.0",), ("12d",), ("\u00a07\u00a0",), (n + "0",), ("0",), (n + "0.0",), ("",), (None,), ("1e3",)]
    df = spark.createDataFrame(rows, "v string")
    got = df.select(R.to_int("v").alias("i"), R.to_float("v").alias("f"), R.first_nonempty("v", default="z").alias("e")).collect()
    assert [r["i"] for r in got] == [11, 5, None, None, 7, 0, 0, 0, None, None, None]
    assert [r["f"] for r in got] == [11.0, 5.0, 5.0, None, 7.0, 0.0, 0.0, 0.0, None, None, 1000.0]
    assert [r["e"] for r in got] == ["\t11\n", "5.0", "5.0", "12d", "\u00a07\u00a0", "z", "0", "z", "z", "z", "1e3"]
    text = spark.createDataFrame([("gabarit\u00a0max.\u00a021\u00a0m", "\tD4A", "")], "d string, c string, n string")
    r = text.select(R.parse_height("d").alias("h"), R.build_zone_cantonal("c", "n").alias("b")).first()
    assert r["h"] == 21 and r["b"] is True


def _feature(geometry, fid="1"):
    return f'{{"type":"Feature","id":"{fid}","properties":{{"N":5,"F":5.0,"S":"5"}},"geometry":{geometry}}}'


def _parse(spark, geometries):
    feats = ",".join(_feature(g, str(i)) for i, g in enumerate(geometries))
    page = f'{{"type":"FeatureCollection","features":[{feats}]}}'
    return J.to_features(J.explode_pages(spark.createDataFrame([(0, page)], "page_no int, page_json string")))


def test_geometry_intake_survives_odd_input(spark):
    def ring(*pts):
        return "[" + ",".join(f"[{2600000 + x},{1200000 + y}]" for x, y in pts) + "]"

    def poly(*rings):
        return f'{{"type":"Polygon","coordinates":[{",".join(rings)}]}}'
    box = ((0, 0), (4, 0), (4, 4), (0, 4), (0, 0))
    cases = [(poly(ring(*box)), "ok", 16.0, 1), (poly(ring((0, 0), *box)), "repaired", 16.0, 1), (poly(ring(*box), ring((1, 1), (2, 2), (1, 1))), "repaired", 16.0, 1),
             (poly(ring(*box), ring((1, 1), (2, 1), (2, 2), (1, 2), (1, 1))), "ok", 15.0, 1), (poly(ring((0, 0), (4, 4), (4, 0), (0, 4), (0, 0))), "repaired", 8.0, 2),
             (poly(ring((0, 0), (4, 0), (2, 2), (4, 4), (0, 4), (2, 2), (0, 0))), "ok", 8.0, 1), ('{"type":"Polygon","coordinates":[]}', "rejected", None, None),
             ('{"type":"Polygon","coordinates":[[]]}', "rejected", None, None), ('{"type":"Polygon"}', "rejected", None, None), ("null", "rejected", None, None),
             (poly(ring((0, 0), (4, 0), (2, 0), (0, 0))), "rejected", None, None), (poly(ring((0, 0), (4, 0), (0, 0))), "rejected", None, None),
             ('{"type":"MultiPolygon","coordinates":[[%s],[%s]]}' % (ring(*box), ring((9, 9), (9, 9))), "repaired", 16.0, 1), ('{"type":"MultiPolygon","coordinates":[[],[[]]]}', "rejected", None, None)]
    got = {r["id"]: r for r in _parse(spark, [c[0] for c in cases]).select("id", "status", "reason", F.col("shape.area").alias("a"), F.col("shape.nparts").alias("n")).collect()}
    assert len(got) == len(cases)  # kept plus rejected is what landed
    for i, (_, status, area, parts) in enumerate(cases):
        r = got[str(i)]
        assert (r["status"], r["a"], r["n"]) == (status, area, parts), (i, r)
        assert (r["reason"] is not None) == (status == "rejected")


def test_json_value_types(spark):
    p = _parse(spark, ["null"]).select("properties").first()["properties"]
    assert p == {"N": R.NUMBER_MARK + "5", "F": R.NUMBER_MARK + "5.0", "S": "5"} or p["F"] in (R.NUMBER_MARK + "5", R.NUMBER_MARK + "5.0")


def test_cut_off_page_and_extract_are_reported(spark, tmp_path):
    page = '{"type":"FeatureCollection","features":[' + ",".join(_feature("null", str(i)) for i in range(2)) + "]}"
    pages = spark.createDataFrame([(0, page), (1, page[:-30]), (2, "no json")], "page_no bigint, page_json string")
    J.write_pages(pages, str(tmp_path / "pages"))
    landed = J.read_pages(spark, str(tmp_path / "pages"))
    assert sorted(map(tuple, J.page_status(landed).collect())) == [(0, "ok", 2), (1, "corrupt", 0), (2, "corrupt", 0)]
    assert J.explode_pages(landed).count() == 2
    docs = spark.createDataFrame([("A", '{"GetExtractByIdResponse":{"extract":{"RealEstate":[{"RestrictionOnLandownership":[{"Theme":{"Code":"C"}}]}]}}}'),
                                  ("B", '{"GetExtr'), ("C", "{}"), ("D", None)], "egrid string, extract_json string")
    assert {(r["egrid"], r["status"], r["n_restrictions"]) for r in J.extract_status(docs).collect()} == {("A", "ok", 1), ("B", "malformed", 0), ("C", "empty", 0), ("D", "malformed", 0)}
    assert [r["egrid"] for r in J.flatten_extracts(docs).collect()] == ["A"]


def test_store_keep_on_failure_and_idempotent_append(spark, tmp_path):
    st = TableStore(spark, str(tmp_path / "store"))
    good = spark.range(5).withColumn("v", F.lit("ok"))
    st.replace(good, "t")
    bad = spark.range(5).withColumn("v", F.when(F.col("id") == 3, F.raise_error(F.lit("boom"))).otherwise("x"))
    with pytest.raises(Exception, match="boom"):
        st.replace(bad, "t")
    assert {r["v"] for r in st.read("t").collect()} == {"ok"}
    st.append(good, "log", "r1")
    st.append(good, "log", "r1")
    st.append(good, "log", "r2")
    assert st.read_log("log").count() == 10


def test_rules(spark):
    df = spark.createDataFrame(
        [("Logements (gabarit max. 21 m)", " 11 ", "D4A", "Zone mixte"),
         ("gabarit maximum 24 m", "11.5", " d3 ", "Zone agricole"),
         ("mixte (Gabarit max.15 m)", "abc", "", "Zone 4"),
         (None, None, None, None)], "d string, c string, code string, name string")
    r = df.select(R.parse_height("d").alias("h"), R.to_int("c").alias("i"), R.build_zone_federal("c").alias("f"),
                  R.build_zone_cantonal("code", "name").alias("b"), R.build_zone_text("name").alias("t")).collect()
    assert [x["h"] for x in r] == [21, 24, 15, None]
    assert [x["i"] for x in r] == [11, None, None, None]
    assert [x["f"] for x in r] == [True, False, False, False]
    assert [x["b"] for x in r] == [True, False, False, False]
    assert [x["t"] for x in r] == [True, False, False, False]


def test_localized_text_and_extract(spark):
    doc = ('{"GetExtractByIdResponse":{"extract":{"RealEstate":[{"RestrictionOnLandownership":['
           '{"Theme":{"Code":"","Sub_Code":"S","Text":[{"Language":"de","Text":"A"},{"Language":"fr","Text":""},'
           '{"Language":"de","Text":"B"}]},"Lawstatus":{"Code":"inForce"}},'
           '{"Theme":{"Code":"C","Text":"plain"},"SubTheme":"st","Lawstatus":{"Code":"x"}},'
           '{"Theme":{"Code":"D","Text":[{"Language":"fr","Text":"F1"},{"Language":"fr","Text":"F2"}]}}]}]}}}')
    ex = spark.createDataFrame([("E1", doc), ("E2", '{"GetExtractByIdResponse":{}}')], "egrid string, extract_json string")
    got = sorted((r["theme_code"], r["theme_text"], r["sub_theme"], r["legal_state"])
                 for r in J.flatten_extracts(ex).collect())
    assert got == [("C", "plain", "st", "x"), ("D", "F2", None, None), ("S", "B", None, "inForce")]


def test_geojson_pages(spark):
    def pt(x, y):
        return f"[{2600000 + x},{1200000 + y}]"
    page = ('{"type":"FeatureCollection","features":['
            '{"type":"Feature","id":"1","properties":{"A":"x","N":5},'
            f'"geometry":{{"type":"Polygon","coordinates":[[{pt(0,0)},{pt(2,0)},{pt(2,2)},{pt(0,2)},{pt(0,0)}]]}}}},'
            '{"type":"Feature","id":"2","properties":{},"geometry":{"type":"GeometryCollection","geometries":['
            f'{{"type":"Point","coordinates":{pt(1,1)}}},{{"type":"MultiPolygon","coordinates":'
            f'[[[{pt(0,0)},{pt(1,0)},{pt(1,1)},{pt(0,1)}]],[[{pt(3,3)},{pt(4,3)},{pt(4,4)},{pt(3,4)},{pt(3,3)}]]]}}]}}}},'
            '{"type":"Feature","id":"3","properties":{},"geometry":null}]}')
    f = J.to_features(J.explode_pages(spark.createDataFrame([(0, page)], "page_no int, page_json string")))
    got = {r["id"]: r for r in f.select("id", "properties", "status", F.col("shape.area").alias("a"),
                                         F.col("shape.nparts").alias("n")).collect()}
    assert got["1"]["properties"]["N"] == R.NUMBER_MARK + "5" and got["1"]["a"] == 4 and got["1"]["status"] == "ok"
    assert got["2"]["n"] == 2 and got["2"]["a"] == 2 and got["2"]["status"] == "repaired"
    assert got["3"]["status"] == "rejected"
