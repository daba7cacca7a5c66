"""Quality classifier by compression.

Two zstandard dictionaries are trained, one on good and one on bad labelled texts. A text is compressed once with each; how much
smaller it gets with one than with the other, per byte and per compressed byte, is the evidence. A logistic model,
fitted on labelled texts that neither dictionary has seen, turns it into a probability of the label "good": it sees the two normalised
differences, the compression ratio and the logarithm of the length (the differences mean less for very short and for
self-repeating texts), and their products.

Fitting uses a bounded sample of labelled rows: at most ``dictionary_rows`` + ``calibration_rows`` a class, chosen by a hash of the
id, no text above ``sample_bytes``; the classes are weighted back to their shares among all labelled rows. Scoring reads every whole text,
in the scan's own tasks; there is no shuffle.

Defined results: a null text counts as empty; empty texts get the score of length 0. Without labelled rows of
both classes every text has the share of good labels as its score (0.5 without any label). Labels with a null id or a null
label are not used; repeated ids are used once. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

LEVEL = 3
_COMPRESSORS: dict = {}


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    prior: float
    mean: tuple = ()
    scale: tuple = ()
    weights: tuple = ()

    def score(self, texts: list[str]) -> np.ndarray:
        if not self.weights:
            return np.full(len(texts), self.prior)
        x = (_products(evidence(texts, self.good, self.bad)) - np.array(self.mean)) / np.array(self.scale)
        return _sigmoid(self.weights[0] + x @ np.array(self.weights[1:]))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def _compressor(dictionary: bytes):
    import zstandard

    if dictionary not in _COMPRESSORS:
        if len(_COMPRESSORS) > 8:
            _COMPRESSORS.clear()
        data = zstandard.ZstdCompressionDict(dictionary)
        _COMPRESSORS[dictionary] = zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False)
    return _COMPRESSORS[dictionary]


def trained(texts: list[bytes], size: int) -> bytes:
    """A dictionary; of very few texts, their own content."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, texts, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(texts)[-size:]


def evidence(texts: list[str], good: bytes, bad: bytes) -> np.ndarray:
    with_good, with_bad = _compressor(good), _compressor(bad)
    out = np.empty((len(texts), 4))
    for i, text in enumerate(texts):
        raw = text.encode("utf-8", "surrogatepass")
        g, b, n = len(with_good.compress(raw)), len(with_bad.compress(raw)), len(raw) + 8
        out[i] = (b - g) / n, (b - g) / max(g, b), g / n, np.log(n)
    return out


def _products(x: np.ndarray) -> np.ndarray:
    pairs = [x[:, i] * x[:, j] for i in range(4) for j in range(i, 4)]
    return np.column_stack([x, *pairs])


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 0.05, steps: int = 60) -> np.ndarray:
    """Weighted logistic regression by damped Newton steps."""
    a, beta = np.column_stack([np.ones(len(x)), x]), np.zeros(x.shape[1] + 1)
    keep = ridge * np.eye(len(beta))
    keep[0, 0] = 1e-6
    loss = lambda b: float(np.sum(w * np.logaddexp(0, np.where(y == 1, -1, 1) * (a @ b))) + 0.5 * b @ keep @ b)
    now = loss(beta)
    for _ in range(steps):
        p = _sigmoid(a @ beta)
        step = np.linalg.solve((a * (w * p * (1 - p))[:, None]).T @ a + keep, a.T @ (w * (y - p)) - keep @ beta)
        size = 1.0
        while size > 1e-4 and loss(beta + size * step) > now:
            size /= 2
        beta, before, now = beta + size * step, now, loss(beta + size * step)
        if before - now < 1e-8 * max(1.0, abs(before)):
            break
    return beta


def fit(docs: DataFrame, labels: DataFrame, usable: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", dictionary_rows: int = 1500, calibration_rows: int = 3000, dictionary_bytes: int = 300_000,
        sample_bytes: int = 200_000, seed: int = 5) -> Model:
    """``usable``: condition on the labels' rows that may be learned from."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & (F.lit(True) if usable is None else usable))
    known = known.groupBy(F.col(id_col).alias("__id")).agg(F.max(label_col).cast("int").alias("__y"))
    n = {r["__y"]: r["n"] for r in known.groupBy("__y").agg(F.count("*").alias("n")).collect()}
    total = sum(n.values())
    if len(n) < 2:
        return Model(b"", b"", float(n.get(1, 0)) / total if total else 0.5)
    order, most = F.xxhash64(F.lit(seed), F.col("__id")), dictionary_rows + calibration_rows
    chosen = known.where("__y = 0").orderBy(order, "__id").limit(most).unionByName(known.where("__y = 1").orderBy(order, "__id").limit(most))
    rows = (docs.select(F.col(id_col).alias("__id"), text_or_empty(F.col(text_col)).alias("__t")).where(F.octet_length("__t") <= sample_bytes)
            .join(F.broadcast(chosen), "__id").groupBy("__id", "__y").agg(F.min("__t").alias("__t"), order.alias("__o")).collect())
    rows = sorted(rows, key=lambda r: (r["__o"], str(r["__id"])))
    dictionaries, held = {}, []
    for y in (0, 1):
        own = [r["__t"] for r in rows if r["__y"] == y]
        cut = min(dictionary_rows, max(1, len(own) // 2))
        dictionaries[y] = trained([t.encode("utf-8", "surrogatepass") for t in own[:cut]], dictionary_bytes)
        held += [(t, y) for t in own[cut:]]
    y = np.array([q for _, q in held])
    if len(set(y.tolist())) < 2 or not dictionaries[0] or not dictionaries[1]:
        return Model(b"", b"", n[1] / total)
    x = _products(evidence([t for t, _ in held], dictionaries[1], dictionaries[0]))
    mean, scale = x.mean(0), x.std(0) + 1e-9
    weight = np.where(y == 1, n[1] / total / (y == 1).mean(), n[0] / total / (y == 0).mean())
    beta = _logistic((x - mean) / scale, y, weight)
    return Model(dictionaries[1], dictionaries[0], n[1] / total, tuple(mean), tuple(scale), tuple(beta))


def score(docs: DataFrame, model: Model, text_col: str = "text", as_col: str = "score") -> DataFrame:
    """``docs`` with the probability of the label 1, from the whole text alone."""
    @F.arrow_udf("double")
    def scored(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            parts = [model.score(batch.slice(i, 64).to_pylist()) for i in range(0, len(batch), 64)]
            yield pa.array(np.concatenate(parts) if parts else np.empty(0))

    return docs.withColumn(as_col, scored(text_or_empty(F.col(text_col))))
