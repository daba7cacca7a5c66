import random

import numpy as np
import pytest
from landlens.llm import quality as M
from pyspark.sql import functions as F

from data import DOCS, frame, odd_documents, words


def labelled(spark, n=400, seed=3):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        text, good = words(rng, rng.randint(20, 120)), i % 4 != 0
        docs.append((i, text if good else text.upper().replace(" ", "!! "), *[None] * 7))
        labels.append((i, int(good), 0, "extra"))
    labels += [(None, 1, 0, ""), (3, None, 0, ""), (5, 1, 0, ""), (99999, 0, 0, "")]
    return docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int, text string")


def test_learns_and_holds_out(spark):
    docs, labels = labelled(spark)
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    model = M.fit(frame(spark, docs), labels, ~held)
    out = M.score(frame(spark, docs), model, as_col="p").withColumn("held", held).collect()
    right = [(r["p"] >= 0.3) == (r["doc_id"] % 4 != 0) for r in out if r["held"]]
    assert len(right) > 40 and np.mean(right) > 0.95
    assert all(0 <= r["p"] <= 1 for r in out)


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs, labels = labelled(spark, 120)
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    other = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert M.fit(frame(spark, docs), labels, ~held) == M.fit(frame(spark, docs), other, ~held)


def test_odd_texts_and_calibration(spark):
    docs, labels = labelled(spark)
    model = M.fit(frame(spark, docs), labels)
    out = M.score(frame(spark, odd_documents(n=5)), model, as_col="p").select("p", "doc_id").collect()
    assert len(out) == len(odd_documents(n=5)) and all(0 <= r["p"] <= 1 for r in out)
    scores = np.array([r["p"] for r in M.score(frame(spark, docs), model, as_col="p").select("p").collect()])
    assert abs(scores.mean() - model.prior) < 0.05  # calibrated in the large


@pytest.mark.parametrize("rows,prior", [([], 0.5), ([(1, 1)], 1.0), ([(1, 0), (2, None)], 0.0), ([(1, 0), (2, 1)], 0.5)])
def test_without_both_classes(spark, rows, prior):
    docs, _ = labelled(spark, 8)
    model = M.fit(frame(spark, docs), spark.createDataFrame(rows, "doc_id bigint, quality int"))
    assert [r["p"] for r in M.score(frame(spark, docs), model, as_col="p").select("p").collect()] == pytest.approx([prior] * 8)


def test_empty_table(spark):
    _, labels = labelled(spark, 8)
    empty = spark.createDataFrame([], DOCS)
    assert M.score(empty, M.fit(empty, labels), as_col="p").count() == 0
