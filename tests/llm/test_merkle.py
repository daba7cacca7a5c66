"""Merkle manifest against a tree built in one list."""

import hashlib
import random

import pytest
from landlens.llm import merkle as M
from pyspark.sql import functions as F

from data import frame, odd_documents


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def reduce(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def beside(levels, i):
    return [levels[k][(i >> k) ^ 1] for k in range(len(levels) - 1) if (i >> k) ^ 1 < len(levels[k])]


def brute(rows):
    """Sorted (doc_id, grp, leaf, subroot, root, hash of the proof) of rows (doc_id, grp, leaf)."""
    order = lambda x: (x is not None, x if x is not None else "")
    groups = {}
    for doc, grp, leaf in rows:
        groups.setdefault(grp, []).append((doc is not None, doc or 0, leaf, doc))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: reduce([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names}
    top = reduce([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for i, (_, _, leaf, doc) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            out.append((doc, g, leaf, trees[g][-1][0], top[-1][0], H(*beside(trees[g], i), *beside(top, k))))
    return sorted(out, key=repr)


def found(spark, rows, block, fanout, parts=4):
    df = spark.createDataFrame(rows, "doc_id bigint, grp string, leaf string").repartition(parts)
    got = M.proofs(M.manifest(df, block, fanout), "leaf")
    return got.select("doc_id", "grp", "leaf", "subroot", "root", "proof_sha256", "folded_root").collect()


def check(spark, rows, block, fanout):
    got = found(spark, rows, block, fanout)
    assert sorted((tuple(r)[:6] for r in got), key=repr) == brute(rows)
    assert all(r["folded_root"] == r["root"] for r in got)


@pytest.mark.parametrize("block,fanout", [(4, 2), (4, 4), (2, 4), (1, 2)])
def test_equals_one_list(spark, block, fanout):
    sizes = {"b": 45, None: 1, "a": 16, "é": 3, "Z": 17, "": 2}
    rows = [(random.Random(i).randrange(60), g, H(f"{g}{i}")) for g, n in sizes.items() for i in range(n)]
    check(spark, rows + [(None, "a", H("x")), (None, "a", H("x")), (rows[0][0], "b", rows[0][2])], block, fanout)


def test_many_groups_and_one_leaf(spark):
    check(spark, [(i, f"g{i % 37}", H(str(i))) for i in range(150)], 4, 2)
    check(spark, [(1, "only", H("1"))], 256, 16)


def test_a_hot_key_of_equal_rows(spark):
    check(spark, [(7, "en", H("same"))] * 300 + [(i, "en", H(str(i))) for i in range(100)], 16, 4)


def test_tampered_leaves_do_not_verify(spark):
    rows = frame(spark, odd_documents(), 3)
    values = lambda n: M.leaf_hash([F.col("doc_id"), F.col("source"), F.col("lang"), n, F.col("text")])
    leaves = rows.select("doc_id", F.col("lang").alias("grp"), values(F.col("n_chars")).alias("leaf"), values(F.when(F.col("doc_id") % 5 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))).alias("claimed"), "score")
    got = M.proofs(M.manifest(leaves, 8, 2), "claimed").collect()
    assert len(got) == rows.count() and {r["score"] for r in got} == {"clash", None}
    assert all((r["folded_root"] == r["root"]) == (r["doc_id"] is None or r["doc_id"] % 5 != 0) for r in got)
    null = next(r for r in got if r["doc_id"] is None)
    assert null["leaf"] == H("-", "-", "-", "-", "12:no id at all"[0:2], ":no id at all"[0:]) or null["leaf"] == H("----12:no id at all")


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, grp string, leaf string")
    assert M.proofs(M.manifest(df), "leaf").count() == 0
