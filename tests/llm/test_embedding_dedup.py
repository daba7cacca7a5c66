import numpy as np
from landlens.llm import embedding_dedup as M

SCHEMA = "vec_id bigint, embedding array<float>, label int, n string, key string"


def brute(rows, least=0.9):
    ok = [r[1] is not None and len(r[1]) > 0 and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1]) for r in rows]
    unit = [np.array(r[1], np.float32).astype(float) if k else None for r, k in zip(rows, ok)]
    unit = [u / np.linalg.norm(u) if k else None for u, k in zip(unit, ok)]
    n = len(rows)
    link = [[i != j and ok[i] and ok[j] and len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= least for j in range(n)] for i in range(n)]
    comp, out = list(range(n)), []
    changed = True
    while changed:
        changed = False
        for i in range(n):
            for j in range(n):
                if link[i][j] and comp[i] != comp[j]:
                    comp[i] = comp[j] = min(comp[i], comp[j])
                    changed = True
    for i, r in enumerate(rows):
        low = min((rows[j][0] for j in range(n) if comp[j] == comp[i] and rows[j][0] is not None), default=None)
        out.append((r[0], sum(link[i]), low, r[0] == low))
    return sorted(out, key=str)


def vectors(seed=0, dim=64):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(12):
        centre = rng.normal(size=dim)
        for _ in range(6):
            rows.append((centre + rng.normal(size=dim) * 0.12 * (k % 3)).tolist())
    rows += [rng.normal(size=dim).tolist() for _ in range(40)]
    rows += [rows[0], rows[0], [0.0] * dim, None, [], [None] + [1.0] * (dim - 1), [float("nan")] * dim, [float("inf")] + [1.0] * (dim - 1), [1.0, 2.0], [2.0, 4.0], [1e-30] * dim, [1e30] * dim]
    out = [(i, v, 0, None, "x") for i, v in enumerate(rows)]
    return out + [out[5], (None, rows[7], None, None, None), (None, [0.0], None, None, None)]


def test_brute_force(spark):
    rows = vectors()
    got = M.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_chunks(spark, monkeypatch):
    monkeypatch.setattr(M, "CHUNK", 7)
    rows = vectors(2)
    got = M.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_recall_at_the_threshold(spark):
    """Pairs spread from 0.9 up: no false link, nine of ten links found."""
    rng = np.random.default_rng(4)
    base = rng.normal(size=(300, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = rng.normal(size=(300, 64))
    side -= (side * base).sum(1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    cos = rng.uniform(0.901, 1, (300, 1))
    x = np.concatenate([base, cos * base + np.sqrt(1 - cos ** 2) * side])
    rows = [(i, v.tolist(), 0, None, None) for i, v in enumerate(x)]
    got = M.near_duplicates(spark.createDataFrame(rows, SCHEMA)).toPandas()
    want = sum(r[1] for r in brute(rows))
    assert 0.9 * want <= got["n_links"].sum() <= want


def test_codes_are_balanced():
    x = np.random.default_rng(1).normal(size=(4000, 64))
    share = (x @ M.learn_rotation(x) >= 0).mean(axis=0)
    assert (abs(share - 0.5) < 0.1).all()


def test_empty_table(spark):
    assert M.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
