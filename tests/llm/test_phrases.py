"""Phrase counts and scores against counting in one list; the index against direct search."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from landlens.llm import phrases as M

from data import DOCS, frame, odd_documents


def pieces(text):
    low = re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")
    return [[w for w in re.split(r"[\x20\x09]+", p) if w] for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def brute(rows, longest, least, top, pct=100):
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = lang if lang is not None else "und"
        for ws in pieces(text):
            n[lang] += len(ws)
            f.update((lang, tuple(ws[i:i + d])) for d in range(1, longest + 1) for i in range(len(ws) - d + 1))
    some = {k: c for k, c in f.items() if c >= least and len(k[1]) > 1}
    gone = {(lang, q[i:i + m]) for (lang, q), c in some.items() for m in range(2, len(q)) for i in range(len(q) - m + 1) if 100 * c >= pct * f[lang, q[i:i + m]]}
    out = []
    for lang in n:
        best = []
        for (g, q), a in some.items():
            if g == lang and (g, q) not in gone:
                score, k = min((1000 * a * n[g] // (f[g, q[:k]] * f[g, q[k:]]), k) for k in range(1, len(q)))
                best.append((-score, -a, " ".join(q).encode(), f[g, q[:k]], f[g, q[k:]]))
        for rank, (s, a, q, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, q.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def texts(seed, n, vocabulary):
    rng = random.Random(seed)
    return [(rng.choice(["en", "de", None]), "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", " ", "\t", ", ", ".\n", "  "]) for _ in range(rng.randint(0, 60)))) for _ in range(n)]


@pytest.mark.parametrize("shard,longest,least,pct", [(1 << 20, 5, 4, 100), (50, 5, 3, 100), (200, 3, 5, 80), (1, 2, 2, 100)])
def test_equals_brute_force(spark, shard, longest, least, pct):
    rows = texts(shard + longest, 160, ["a", "B", "b", "cé", "d", "Éf", "\x00", "e"])
    found = M.collocations(spark.createDataFrame(rows, "lang string, text string").repartition(3), longest, least, 2000, pct, shard).collect()
    assert sorted(tuple(r) for r in found) == brute(rows, longest, least, 2000, pct)


def test_top_and_ties(spark, monkeypatch):
    monkeypatch.setattr(M, "BUCKETS", 3)
    rows = [("en", f"x{i} y{i}. " * 3) for i in range(40)] + [("en", "one two. " * 9)]
    found = M.collocations(spark.createDataFrame(rows, "lang string, text string"), 5, 3, 7).collect()
    assert sorted(tuple(r) for r in found) == brute(rows, 5, 3, 7)


def test_odd_rows(spark):
    rows = odd_documents() + odd_documents(5)
    found = M.collocations(frame(spark, rows, 4), 5, 2, 2000, shard_words=3000).collect()
    assert sorted(tuple(r) for r in found) == brute([(r[2], r[1]) for r in rows], 5, 2, 2000)


def test_a_hash_collision_changes_the_salt(spark, monkeypatch):
    rows = texts(3, 80, ["a", "b", "c"])
    real = M._word_hash
    monkeypatch.setattr(M, "_word_hash", lambda lang, word, salt: 5 if salt == 0 else real(lang, word, salt))
    found = M.collocations(spark.createDataFrame(rows, "lang string, text string"), 3, 3).collect()
    assert sorted(tuple(r) for r in found) == brute(rows, 3, 3, 2000)


def test_intervals_of_both_indexes():
    rng = np.random.default_rng(4)
    seq = np.append(rng.integers(0, 5, 400), 0).astype(np.int32)
    seq[0] = 0
    index = M.Index(M.transform(seq, 5), M.transform(seq[::-1], 5))
    order = sorted(range(len(seq)), key=lambda i: tuple(seq[i:i + 5]))
    back = seq[::-1]
    rorder = sorted(range(len(seq)), key=lambda i: tuple(back[i:i + 5]))
    state = index.words()
    for side in (0, 1, 1, 0):
        state = index.extend(state, side, np.arange(5) > 0)
        words, firsts, sizes = state
        assert len(words) and sizes.min() > 0
        for p, lo, ro, n in zip(words, firsts[0], firsts[1], sizes):
            assert sum((seq[i:i + len(p)] == p).all() for i in range(len(seq) - len(p) + 1)) == n
            assert all((seq[order[r]:order[r] + len(p)] == p).all() for r in range(lo, lo + n))
            assert all((back[rorder[r]:rorder[r] + len(p)] == p[::-1]).all() for r in range(ro, ro + n))


def test_empty_table(spark):
    assert M.collocations(spark.createDataFrame([], DOCS)).count() == 0
    assert M.collocations(spark.createDataFrame([(None, None), ("en", "")], "lang string, text string")).count() == 0
