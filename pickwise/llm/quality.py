"""Quality classifier: hashed word n-gram logistic regression, follow-the-regularised-leader
(FTRL-proximal) updates, scored as sparse dot products.

Training reads a bounded sample of labelled rows (``max_rows``, chosen by hash) in ``shards``
independent sequences, each a Spark task that visits its rows ``epochs`` times in hash order;
the shards' weights are averaged. Scoring reads every whole text once, where it lies: a
document's score is the sigmoid of bias plus the mean-scaled sum of the weights of its
features. The weights (2**bits floats) are the only broadcast.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.common import batch, text_bytes
from pickwise.llm.features import ngram_counts, sigmoid

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Params:
    bits: int = 18
    ngrams: int = 2
    alpha: float = 20.0     # FTRL learning rate
    beta: float = 1.0       # FTRL smoothing of the learning rate
    l1: float = 0.01
    l2: float = 0.0
    epochs: int = 4
    shards: int = 8
    max_rows: int = 16_000  # labelled rows used for training


class Ftrl:
    """Per-coordinate FTRL-proximal state of a logistic regression over ``2**bits`` features and a bias."""

    def __init__(self, p: Params):
        self.p = p
        self.z = np.zeros((1 << p.bits) + 1)
        self.n = np.zeros((1 << p.bits) + 1)

    def weights(self, at) -> np.ndarray:
        p, z, n = self.p, self.z[at], self.n[at]
        w = -(z - np.sign(z) * p.l1) / ((p.beta + np.sqrt(n)) / p.alpha + p.l2)
        return np.where(np.abs(z) <= p.l1, 0.0, w)

    def learn(self, grams: tuple[np.ndarray, np.ndarray], label: float) -> None:
        at, x = with_bias(grams, self.p.bits)
        w = self.weights(at)
        g = (sigmoid(w @ x) - label) * x
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.p.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def with_bias(grams: tuple[np.ndarray, np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature positions and values: square roots of counts scaled to one unit length, and the bias."""
    ids, counts = grams
    x = np.append(np.sqrt(counts / max(1, counts.sum())), 1.0)
    return np.append(ids, 1 << bits), x


def _train(pdf: pd.DataFrame, p: Params) -> pd.DataFrame:
    pdf = pdf.sort_values("pick", ignore_index=True)
    model = Ftrl(p)
    grams = [ngram_counts(t, p.bits, p.ngrams) for t in pdf["t"]]
    for _ in range(p.epochs):
        for g, y in zip(grams, pdf["label"]):
            model.learn(g, float(y))
    w = model.weights(slice(None)).astype(np.float32)
    return pd.DataFrame({"rows": [len(pdf)], "w": [w.tobytes()]})


def train(labelled: DataFrame, p: Params = Params()) -> np.ndarray:
    """Weights (bias last) from rows ``(doc_id, text, label)``; zeros if there are none.

    Rows with a null id or label are left out. ``max_rows`` bounds the sample; it is taken by a
    hash of the id, so it does not depend on partitioning."""
    rows = labelled.where("doc_id is not null and label is not null")
    n = rows.select("doc_id").count()
    pick = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    rows = rows.withColumn("pick", pick).where(F.col("pick") < int((1 << 30) * min(1.0, p.max_rows / max(1, n))))
    rows = rows.select(F.pmod(F.col("pick"), F.lit(p.shards)).alias("shard"), "pick", text_bytes().alias("t"), F.col("label").cast("double").alias("label"))
    got = rows.groupBy("shard").applyInPandas(lambda pdf: _train(pdf, p), "rows long, w binary").collect()  # one row a shard
    if not got:
        return np.zeros((1 << p.bits) + 1, np.float32)
    return np.average([np.frombuffer(r["w"], np.float32) for r in got], axis=0, weights=[r["rows"] for r in got]).astype(np.float32)


OUT = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def score(docs: DataFrame, weights: np.ndarray, p: Params = Params(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score, predicted)`` for every row: score in [0, 1], higher for label 1.

    Null and empty texts get the score of the bias alone. Repeated rows are scored each; other
    columns are ignored; predicted is 1 from a score of 0.5."""
    w = docs.sparkSession.sparkContext.broadcast(weights)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("t"))

    def run(batches):
        for b in batches:
            s = []
            for t in b.column(1).to_pylist():
                at, x = with_bias(ngram_counts(t, p.bits, p.ngrams), p.bits)
                s.append(float(sigmoid(w.value[at].astype(np.float64) @ x)))
            yield batch(OUT, b.column(0), s)

    return src.mapInArrow(run, "doc_id long, score double").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def labelled_rows(docs: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """``(doc_id, text, label)`` of the labelled documents; of contradicting labels the larger counts."""
    y = labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(column).alias("label"))
    return docs.select("doc_id", "text").join(y, "doc_id")


def fold(column: str = "doc_id"):
    """crc32 of the id as text, modulo 3."""
    return F.pmod(F.crc32(F.col(column).cast("string")), F.lit(3))


def classify(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``: scores of every document by a model that has seen no
    label of fold 1 (``held_out``). A null id is not held out and not learned from."""
    y = labels.where(F.col("quality").isNotNull() & (fold() != 1)).groupBy("doc_id").agg(F.max("quality").alias("label"))
    n = y.count()
    bound = int((1 << 30) * min(1.0, p.max_rows / max(1, n)))
    y = y.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < bound)  # the sample of train(): about max_rows ids
    rows = docs.select("doc_id", "text").join(F.broadcast(y), "doc_id")
    model = train(rows, p)
    out = score(docs, model, p)
    return out.select("doc_id", F.coalesce(fold() == 1, F.lit(False)).alias("held_out"), "score", "predicted")
