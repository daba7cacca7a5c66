import random
import re

import numpy as np
import pytest
from landlens.llm import components, kernels
from landlens.llm import ngram_join as M

from data import DOCS, frame, odd_documents, words

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def brute(rows, size, num, den):
    sets = [shingles(r[1], size) for r in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                up[find(i)] = find(j)
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[find(i)] = min(low.get(find(i), r[0]), r[0])
    return sorted(((r[0], len(s), low.get(find(i))) for i, (r, s) in enumerate(zip(rows, sets))), key=str)


def clusters(seed, n=40, near=60):
    """One large group of near copies around the threshold, and smaller ones."""
    rng = random.Random(seed)
    texts = []
    for size, copies in ((60, near), (25, 12), (9, 8), (140, 10)):
        base = words(rng, size).split()
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = words(rng, 1)
            texts.append(" ".join(own))
    texts += [words(rng, rng.randint(1, 40)) for _ in range(n)]
    return [(i, t, *[None] * 7) for i, t in enumerate(texts)]


@pytest.mark.parametrize("size,num,hot", [(3, 90, 256), (3, 90, 3), (5, 80, 2), (1, 50, 4)])
def test_brute_force(spark, size, num, hot):
    rows = odd_documents(n=25) + [(1000 + r[0], *r[1:]) for r in clusters(size)]
    got = M.similar_groups(frame(spark, rows), size, num, 100, hot)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, size, num, 100)


def test_hot_chunks_and_large_components(spark, monkeypatch):
    """Cells so small that hot n-grams and components are dealt into many, and pairs between them remain."""
    monkeypatch.setattr(M, "CELL", 5)
    monkeypatch.setattr(M, "SMALL_CELL", 4)
    monkeypatch.setattr(M, "PIVOTS", 2)
    rows = clusters(11)
    got = M.similar_groups(frame(spark, rows), 3, 80, 100, 6)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 3, 80, 100)


def test_empty_table(spark):
    assert M.similar_groups(spark.createDataFrame([], DOCS)).count() == 0


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, k) for k in range(300, 360)] + [(rng.randrange(500, 700), rng.randrange(500, 700)) for _ in range(120)] + [(5, 5)]
    got = {r["id"]: r["component"] for r in components.connected(spark.createDataFrame(edges, "a bigint, b bigint").repartition(7)).collect()}
    forest = components.Forest()
    for a, b in edges:
        if a != b:
            forest.join(a, b)
    assert got == {x: forest.find(x) for x in list(forest.up)}


def test_kernel_matches_words():
    rng = random.Random(1)
    texts = [words(rng, n) for n in (0, 1, 2, 3, 4, 50)] + ["A a\tA\x0ba", "\n", "É é"]
    for size in (1, 3, 5):
        sets = kernels.shingle_sets([t.encode() for t in texts], size)
        alone = [kernels.shingle_sets([t.encode()], size)[0] for t in texts]
        assert all(np.array_equal(a, b) for a, b in zip(sets, alone))
        assert [len(s) for s in sets] == [len(shingles(t, size)) for t in texts]
