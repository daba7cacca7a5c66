import itertools
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from landlens.llm import mixing as M

from data import DOCS, frame, odd_documents


@given(st.lists(st.tuples(st.integers(0, 12), st.integers(1, 3)), max_size=5, unique_by=lambda x: x[0]), st.integers(0, 90), st.integers(1, 3))
@settings(max_examples=200, deadline=None)
def test_plan_is_nearest(items, budget, most):
    sizes, counts = [s for s, _ in items], [c for _, c in items]
    take = M.plan_counts(sizes, counts, budget, most)
    assert all(0 <= t <= most * c for t, c in zip(take, counts))
    total = sum(s * c for s, c in items)
    goal = min(budget, most * total)
    fixed = [c * goal // total if total else 0 for c in counts]  # fair shares come first; budgets this small are all left to the knapsack beyond them
    sums = {sum(s * t for s, t in zip(sizes, combo)) for combo in itertools.product(*[range(f, most * c + 1) for f, c in zip(fixed, counts)])}
    assert abs(sum(s * t for s, t in zip(sizes, take)) - goal) == min(abs(x - goal) for x in sums)


def test_targets():
    assert M.targets({"a": 100, "b": 100, "c": 100, None: 100}, [5, 2, 1], 400) == {"a": 400 * 5 / 13 if 400 * 5 / 13 <= 300 else 300, "b": 400 * 2 / 13, "c": 400 / 13, None: 400 * 5 / 13}
    capped = M.targets({"a": 10, "b": 1000, "c": 0}, [5, 2, 1], 1010)
    assert capped == {"a": 30.0, "b": 980.0, "c": 0.0}
    assert M.targets({}, [1], 0) == {}


def sized(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.mark.parametrize("spread", [1, 64])
def test_mix(spark, monkeypatch, spread):
    monkeypatch.setattr(M, "RANGES", spread)
    rows = odd_documents(n=150) + [(5000 + i, "same size text", "en", "s1", *[None] * 5) for i in range(300)]
    got = M.mix(frame(spark, rows, 4), [5, 2, 1]).collect()
    again = M.mix(frame(spark, rows, 7), [5, 2, 1]).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)
    assert sorted((r["doc_id"], r["size"]) for r in got if r["doc_id"] is not None) == sorted((r[0], sized(r[1])) for r in rows if r[0] is not None)
    source = {r[0]: r[3] for r in rows}
    sums = {}
    for r in rows:
        sums[r[3]] = sums.get(r[3], 0) + sized(r[1])
    goal = M.targets(sums, [5, 2, 1], sum(sums.values()))
    taken = {}
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == sums[s] and abs(r["target"] - goal[s]) < 1e-6
        assert r["taken"] == r["repeats"] * r["size"] <= 3 * r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
    for s in sums:
        assert abs(taken[s] - goal[s]) <= max(2, 0.01 * goal[s]), (s, taken[s], goal[s])


def test_mixed_documents(spark):
    rows = odd_documents(n=80)
    df = frame(spark, rows)
    out = M.mixed_documents(df, [5, 2, 1])
    assert out.columns == df.columns
    want = {}
    for r in M.mix(df, [5, 2, 1]).collect():
        want[r["doc_id"]] = want.get(r["doc_id"], 0) + r["repeats"]
    got = {}
    for r in out.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    assert got == {k: v for k, v in want.items() if v}


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert M.mix(empty, [5, 2, 1]).count() == 0 and M.mixed_documents(empty, [1]).count() == 0
