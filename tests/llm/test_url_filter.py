import re

import pytest
from landlens.llm import url_filter as M
from landlens.llm.queries import URL_RULES

URLS = [None, "", "no scheme", "http://", "http://WWW.Example.COM/en/x?y#z", "https://example.com/en/", "https://a.example.com/en", "http://example.com", "http://notexample.com/en/1", "http://x.net/es/1",
        "http://x.net/fr", "http://x.net/fr/?", "ftp://net/fr/a", "http://a.b?c/d", "http://a.b#/d", "x://y://z/com/", "http://com/", "http://İ.com/", "http://listed.org/a/", "http://www.listed.org/a", "https://LISTED.org/a?q=1#f",
        "http://listed.org/A", "http://user@h.net:80/es/q"]


def brute(url, listed):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, verdict = max(fits, key=lambda f: len(f[0]), default=(None, None))
    key = re.sub(r"^www\.", "", host) + re.sub(r"/+$", "", path)
    return host, path, rule, verdict or ("block" if key in listed else "allow"), key in listed


@pytest.mark.parametrize("listed", [set(), {"listed.org/a"}, {"listed.org/a", ""} | {f"other{i}.org/{i}" for i in range(500)}])
def test_against_brute_force(spark, listed):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS)] + [(None, URLS[4], None, None), (3, URLS[3], None, None)], "page_id bigint, url string, host string, block string")
    keys = spark.createDataFrame([(k,) for k in listed] * 2 + [(None,)], "key string")
    got = M.judge(pages, keys, URL_RULES).collect()
    want = [(i, *brute(u, listed)) for i, u in [*enumerate(URLS), (None, URLS[4]), (3, URLS[3])]]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_filter_passes_few_others(spark):
    listed = spark.range(2000).selectExpr("concat('h', id, '.org/x') AS key")
    blocks = M.bloom_blocks(listed, 2000 // M.KEYS_PER_BLOCK + 1)
    from pyspark.sql import functions as F
    probe = spark.range(20000).selectExpr("concat('o', id, '.org/y') AS key")
    probe = probe.withColumn("block", M._block(F.col("key"), 2000 // M.KEYS_PER_BLOCK + 1)).join(blocks, "block")
    hit = F.lit(True)
    for i, m in enumerate(M._masks(F.col("key"))):
        hit = hit & (F.col(f"w{i}").bitwiseAND(m) != 0)
    assert probe.where(hit).count() < 400  # 2 %


def test_empty_table(spark):
    empty = spark.createDataFrame([], "page_id bigint, url string")
    assert M.judge(empty, spark.createDataFrame([], "key string"), URL_RULES).count() == 0
