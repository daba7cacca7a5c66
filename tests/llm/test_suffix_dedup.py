import collections
import hashlib
import random

import numpy as np
import pytest
from landlens.llm import suffix_dedup as M

from data import DOCS, frame, odd_documents


def expected(rows, least):
    raws = [(r[0], (r[1] or "").encode()) for r in rows]
    seen = collections.Counter(raw[i:i + least] for _, raw in raws for i in range(len(raw) - least + 1))
    out = []
    for i, raw in raws:
        mask = bytearray(len(raw))
        for at in range(len(raw) - least + 1):
            if seen[raw[at:at + least]] > 1:
                mask[at:at + least] = b"\1" * least
        kept = bytes(b for b, m in zip(raw, mask) if not m)
        spans = sum(1 for k, m in enumerate(mask) if m and not (k and mask[k - 1]))
        out.append((i, len(raw), sum(mask), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted(((r[0], r["n_bytes"], r["n_removed"], len(r["spans"]) // 2, r["kept_sha256"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("least,gram", [(200, 48), (40, 12), (9, 8)])
def test_brute_force(spark, least, gram):
    rows = odd_documents()
    assert found(M.drop_repeats(frame(spark, rows), least, gram)) == expected(rows, least)


def test_chunked_anchor(spark, monkeypatch):
    """An anchor of many segments is dealt into chunks (workers read the module's constant from the closure's argument)."""
    rng = random.Random(5)
    passage = "".join(rng.choice("abcdef ") for _ in range(90))
    rows = [(i, "".join(rng.choice("ghijkl ") for _ in range(40)) + passage + "".join(rng.choice("mnop ") for _ in range(40 + i % 3)), *[None] * 7) for i in range(60)]
    monkeypatch.setattr(M, "CHUNK", 8)
    assert found(M.drop_repeats(frame(spark, rows), 40, 12)) == expected(rows, 40)


def test_pieces_of_a_long_text():
    rng = np.random.default_rng(0)
    raw = rng.integers(97, 100, 5000).astype(np.uint8).tobytes()
    whole = M.runs_of([raw], 30, 10)
    assert whole[2].sum() == len(raw) - 29
    at = np.concatenate([np.arange(s, s + n) for s, n in zip(whole[1], whole[2])])
    assert (at == np.arange(len(raw) - 29)).all()


@pytest.mark.parametrize("least", [8, 13, 16, 40])
def test_previous_factors(least):
    rng = np.random.default_rng(least)
    data = np.concatenate([rng.integers(0, 2, 300), rng.integers(0, 2, 300)]).astype(np.uint8)
    data[350:430] = data[20:100]
    starts = np.arange(0, len(data) - least + 1)
    before, after = M.previous_factors(data, starts, least)
    raw = data.tobytes()
    for i in starts.tolist():
        same = [j for j in starts.tolist() if raw[j:j + least] == raw[i:i + least]]
        assert before[i] == max([j for j in same if j < i], default=-1)
        assert after[i] == min([j for j in same if j > i], default=-1)
    order, _ = M.suffix_ties(data, starts, least)
    cut = [raw[i:i + least] for i in order.tolist()]
    assert cut == sorted(cut)


def test_empty_table(spark):
    assert M.drop_repeats(spark.createDataFrame([], DOCS)).count() == 0
