"""Landed documents take little room on disk, and a large folder splits into many tasks."""

from pathlib import Path

from landlens.sources import geojson as J
from pyspark.sql import functions as F


def test_landed_pages_are_compressed_and_dealt_over_files(spark, tmp_path):
    n = 2 * J.PAGES_IN_FILE + 7
    feature = F.concat(F.lit('{"type":"Feature","id":"'), F.col("id"), F.lit('\\n","properties":{"EGRIS_EGRID":"CH'), F.col("id"), F.lit('","NBIdent":""},"geometry":null}'))
    pages = spark.range(n).coalesce(1).select(F.col("id").alias("page_no"), F.concat(F.lit('{"type":"FeatureCollection","features":['), feature, F.lit("]}")).alias("page_json"))
    J.write_pages(pages, str(tmp_path / "pages"))
    files = [p for p in Path(tmp_path / "pages").iterdir() if p.name.startswith("part-")]
    text = pages.agg(F.sum(F.length("page_json"))).first()[0]
    assert len(files) == 3 and sum(p.stat().st_size for p in files) < text / 5
    assert sorted(map(tuple, J.read_pages(spark, str(tmp_path / "pages")).collect())) == sorted(map(tuple, pages.collect()))
