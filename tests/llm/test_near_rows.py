"""The near-dedup stage keeps one row of each group, whatever the ids are."""

import hashlib
import random

import corpus_pipeline as C

from data import DOCS, frame, odd_documents, words
from test_ngram_join import shingles


def expected(rows, size, num, den):
    """Rows that stay, by brute force over row numbers."""
    sets, up = [shingles(r[1], size) for r in rows], list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and den * len(a & sets[j]) >= num * len(a | sets[j]):
                up[find(i)] = find(j)
    order = lambda i: (rows[i][0] is None, rows[i][0] or 0, hashlib.sha256((rows[i][1] or "").encode()).digest())
    best = {}
    for i in range(len(rows)):
        best.setdefault(find(i), []).append(i)
    return sorted(((rows[i][0], rows[i][1]) for i in (min(g, key=order) for g in best.values())), key=str)


def kept(spark, rows, folder):
    out = C.drop_near_copies(spark, frame(spark, rows), str(folder))
    assert out.columns == frame(spark, rows).columns
    return sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)


def near(base, k):
    own = base.split()
    own[-1 - k % 3] = f"other{k}"
    return " ".join(own)


def test_repeated_and_null_ids(spark, tmp_path):
    rng = random.Random(5)
    a, b, c, d, e, f = (words(rng, 80) for _ in range(6))
    rows = [(1, a), (2, near(a, 1)), (2, b),  # a clean row shares the id of a near copy
            (3, c), (3, near(c, 1)),  # near copies share one id
            (None, d), (None, near(d, 1)), (None, near(d, 2)),  # near copies without ids
            (None, e), (4, near(e, 1)), (None, f),  # a null id against an id, and alone
            (5, ""), (5, " "), (None, None)]  # without words
    rows = [(*r, *[None] * 7) for r in rows]
    found = kept(spark, rows, tmp_path)
    assert found == expected(rows, 5, 80, 100)
    assert {(2, b), (4, near(e, 1)), (None, f), (1, a)} <= set(found) and len(found) == 9


def test_equal_rows(spark, tmp_path):
    rng = random.Random(6)
    a, b = words(rng, 50), words(rng, 50)
    rows = [(i, t, *[None] * 7) for i, t in [(1, a), (1, a), (2, near(a, 1)), (None, b), (None, b), (None, b)]]
    assert kept(spark, rows, tmp_path) == expected(rows, 5, 80, 100) == sorted([(1, a), (None, b)], key=str)


def test_brute_force(spark, tmp_path):
    rng = random.Random(7)
    rows = odd_documents(n=20)
    for _ in range(6):
        base = words(rng, 60)
        rows += [(rng.choice([None, 3, 8, 9, 500]), near(base, k), *[None] * 7) for k in range(6)]
    assert kept(spark, rows, tmp_path) == expected(rows, 5, 80, 100)


def test_empty(spark, tmp_path):
    assert C.drop_near_copies(spark, spark.createDataFrame([], DOCS), str(tmp_path)).count() == 0
