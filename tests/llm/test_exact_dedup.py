import hashlib
import re

import pytest
from landlens.llm import exact_dedup as M

from data import DOCS, frame, odd_documents


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def order(i):
    return (i is None, i or 0)


@pytest.mark.parametrize("prefix", [1, 256])
def test_groups(spark, prefix):
    rows = odd_documents()
    groups = {}
    for r in rows:
        groups.setdefault(norm(r[1]), []).append(r[0])
    got = M.exact_groups(frame(spark, rows), prefix=prefix).collect()
    want = sorted(((r[0], min(groups[norm(r[1])], key=order), len(groups[norm(r[1])]), hashlib.sha256(norm(r[1]).encode()).hexdigest()) for r in rows), key=str)
    assert sorted(((g["doc_id"], g["keep_id"], g["group_size"], g["text_sha256"]) for g in got), key=str) == want
    assert all(g["kept"] == (g["doc_id"] == g["keep_id"]) for g in got)


@pytest.mark.parametrize("prefix", [1, 256])
def test_drop(spark, prefix):
    rows = odd_documents()
    df = frame(spark, rows)
    got = M.drop_exact_duplicates(df, prefix=prefix)
    assert got.columns == df.columns
    groups = {}
    for r in rows:
        groups.setdefault(norm(r[1]), []).append(r[0])
    kept = got.collect()
    assert sorted((r["doc_id"] for r in kept), key=order) == sorted((min(g, key=order) for g in groups.values()), key=order)
    assert all(tuple(r) in rows for r in kept)


def test_same_id_different_text(spark):
    rows = [(1, "a"), (1, "b"), (2, "a"), (1, "a")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(map(tuple, M.drop_exact_duplicates(df).collect())) == [(1, "a"), (1, "b")]


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert M.exact_groups(empty).count() == 0 and M.drop_exact_duplicates(empty).count() == 0
