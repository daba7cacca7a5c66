"""Pages and their features by status, from one reading; sound rectangles pass the repair untouched."""

import json

from landlens.sources import geojson as J
from pyspark.sql import functions as F


def page(*rings):
    return json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "id": str(k), "properties": {}, "geometry": g if g is None or "type" in g else {"type": "Polygon", "coordinates": [g["r"]]}}
                                                               for k, g in enumerate(rings)]})


BOX = {"r": [[2500000, 1110000], [2500010, 1110000], [2500010, 1110010], [2500000, 1110010], [2500000, 1110000]]}
OPEN = {"r": BOX["r"][:4]}
FLAT = {"r": [[2500000, 1110000], [2500010, 1110000], [2500005, 1110000], [2500000, 1110000]]}
TINY = {"r": [[2500000, 0], [2500001, 0], [2500001, 5e-324], [2500000, 5e-324], [2500000, 0]]}
LINE = {"type": "Point", "coordinates": [1, 2]}


def test_account_is_page_status_and_feature_status(spark):
    texts = [page(BOX, OPEN, FLAT, None), page(BOX, BOX, LINE, TINY), page(BOX)[:-9], page(), '{"type":"x"}', "[]", None, "5"]
    pages = spark.createDataFrame(list(enumerate(texts)), "page_no long, page_json string")
    want = {f"page {r['status']}": r["count"] for r in J.page_status(pages).groupBy("status").count().collect()}
    want |= {f"feature {r['status']}": r["count"] for r in J.to_features(J.explode_pages(pages)).groupBy("status").count().collect()}
    account = J.page_account(pages)
    assert {r["status"]: r["count"] for r in account.groupBy("status").count().collect()} == want
    assert want["feature repaired"] == 1 and want["feature rejected"] >= 3 and want["page corrupt"] >= 2
    assert account._jdf.queryExecution().optimizedPlan().toString().count("page_json") < 4  # read and parsed once


def test_sound_rectangles_are_kept_as_they_are(spark):
    pages = spark.createDataFrame([(0, page(BOX, OPEN))], "page_no long, page_json string")
    rows = {r["id"]: r for r in J.to_features(J.explode_pages(pages)).select("id", "status", "reason", "shape", F.size("geom").alias("n")).collect()}
    assert rows["0"]["status"] == "ok" and rows["1"]["status"] == "repaired" and rows["0"]["shape"] == rows["1"]["shape"]
    assert rows["0"]["shape"]["rect"] and rows["0"]["shape"]["area"] == 100.0 and rows["0"]["n"] == 1
