"""Each stage against a plain version, on its own input."""

import random

import corpus_pipeline as C
from landlens.llm import mixing, quality
from pyspark.sql import functions as F

from data import DOCS, frame, odd_documents, words
from test_exact_dedup import norm
from test_mixing import sized
from test_ngram_join import brute
from test_packing import tokens


def corpus(spark, folder):
    rng = random.Random(8)
    rows = odd_documents(n=120)
    for i in range(40):  # shouted junk
        rows.append((2000 + i, words(rng, 60).upper().replace(" ", "!! "), "en", "s2", *[None] * 5))
    base = words(rng, 80).split()
    for i in range(10):
        near = list(base)
        near[rng.randrange(80)] = "other"
        rows.append((3000 + i, " ".join(near), "en", "s1", *[None] * 5))
    frame(spark, rows, 2).write.parquet(f"{folder}/documents.parquet")
    labels = [(r[0], 0 if 2000 <= r[0] < 3000 else 1, 0) for r in rows if r[0] is not None and len(r[1] or "") > 40 and (r[0] < 120 or r[0] >= 2000)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return rows


def test_stages(spark, tmp_path):
    rows = corpus(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert [k for k, _ in C.STAGES] == ["quality classifier", "exact dedup", "near dedup", "source mix", "packing"]
    seen = []
    for k, (_, stage) in enumerate(C.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/out{k}")
        new = spark.read.parquet(f"{tmp_path}/out{k}")
        if k < 4:
            assert new.columns == docs.columns
        seen.append((docs.collect(), new.collect()))
        docs = new
    ids = lambda found: sorted((r["doc_id"] for r in found), key=str)

    (before, after), docs0 = seen[0], spark.read.parquet(f"{tmp_path}/documents.parquet")
    model = quality.fit(docs0, spark.read.parquet(f"{tmp_path}/labels.parquet"), ~F.expr("pmod(crc32(cast(doc_id as string)), 5) = 0"))
    assert ids(after) == sorted((r["doc_id"] for r in before if model.score([r["text"] or ""])[0] >= 0.3), key=str)
    assert not [i for i in ids(after) if i is not None and 2000 <= i < 2040] and len(before) == len(rows)
    assert {i for i in range(120) if len(rows[i][1]) > 40} <= set(ids(after))

    before, after = seen[1]
    groups = {}
    for r in before:
        groups.setdefault(norm(r["text"]), []).append(r["doc_id"])
    assert ids(after) == sorted((min(g, key=lambda i: (i is None, i or 0)) for g in groups.values()), key=str)

    before, after = seen[2]
    low = brute([(r["doc_id"], r["text"]) for r in before], 5, 80, 100)
    assert ids(after) == sorted((i for i, _, c in low if i is None or i == c), key=str) and len(after) < len(before)

    before, after = seen[3]
    copies = {}
    for r in after:
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + 1
    assert max(copies.values()) <= 3
    want = mixing.mix(spark.createDataFrame(before, DOCS), C.WEIGHTS).collect()
    assert copies == {r["doc_id"]: r["repeats"] for r in want if r["repeats"]}
    sums = {}
    for r in before:
        sums[r["source"]] = sums.get(r["source"], 0) + sized(r["text"])
    goal = mixing.targets(sums, C.WEIGHTS, sum(sums.values()))
    for s in sums:
        assert abs(sum(sized(r["text"]) for r in after if r["source"] == s) - goal[s]) <= max(3, 0.05 * goal[s])

    before, after = seen[4]
    assert sum(r["length"] for r in after) == sum(len(tokens(r["text"])) for r in before)


def test_run(spark, tmp_path):
    corpus(spark, tmp_path)
    out = C.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and out.count() > 0
