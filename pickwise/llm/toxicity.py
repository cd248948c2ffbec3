"""Toxicity by a classifier chain.

The categories stand in a fixed order. The linear model of a category sees the document's
words and the probabilities of all earlier categories. For training, those probabilities are
out of fold: the labelled rows are cut into folds, each fold's rows get their probability
from a model that has not seen them, and only then the next category's model is trained on
words plus these columns. Scoring runs the chain on the whole text of every document.

The models are sparse logistic regressions over hashed words (accelerated proximal gradient,
an L1 penalty on words). They are trained on a bounded sample of labelled rows
(``max_rows``); the fold models of one category are trained side by side as Spark tasks.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pickwise.llm.common import mix64, text_bytes
from pickwise.llm.features import sigmoid, word_ids

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Params:
    bits: int = 20
    folds: int = 3
    iterations: int = 50
    l1: float = 2e-2          # penalty that chooses words (columns scaled to unit mean square)
    l2: float = 1e-3          # penalty on the chosen words' weights
    min_rows: int = 8         # a word must stand in so many sample rows
    max_share: float = 0.2    # and in no larger share of them
    max_rows: int = 6_000     # labelled rows used for training
    threshold: float = 0.5


@dataclass
class Chain:
    """One linear model a category: word weights, weights of earlier probabilities, bias."""

    categories: list[str]
    words: np.ndarray   # categories x 2**bits, float32
    earlier: list[np.ndarray]
    bias: list[float]
    params: Params

    def probabilities(self, ids: np.ndarray) -> list[float]:
        p: list[float] = []
        for k in range(len(self.categories)):
            z = self.bias[k] + float(self.words[k, ids].sum(dtype=np.float64)) + float(np.dot(self.earlier[k], p) if p else 0.0)
            p.append(float(sigmoid(z)))
        return p


class Sample:
    """Sparse rows of the training sample, words renumbered to those that are frequent enough."""

    def __init__(self, rows: list[np.ndarray], labels: np.ndarray, fold: np.ndarray, p: Params):
        seen = np.bincount(np.concatenate(rows), minlength=1 << p.bits) if rows else np.zeros(1 << p.bits, int)
        self.vocab = np.flatnonzero((seen >= p.min_rows) & (seen <= p.max_share * max(1, len(rows))))
        number = np.full(1 << p.bits, -1)
        number[self.vocab] = np.arange(len(self.vocab))
        kept = [number[r][number[r] >= 0] for r in rows]
        self.ids = np.concatenate(kept) if kept else np.empty(0, int)
        self.row = np.repeat(np.arange(len(kept)), [len(k) for k in kept])
        self.labels, self.fold = labels, fold

    def fit(self, keep: np.ndarray, y: np.ndarray, earlier: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray, float]:
        """(word weights, weights of earlier probabilities, bias) from the rows in ``keep``."""
        n, v, e = max(1, int(keep.sum())), len(self.vocab), earlier.shape[1]
        on = keep[self.row]
        ids, row = self.ids[on], self.row[on]
        # columns of unit mean square: rare words move as fast as frequent ones
        scale = 1.0 / np.sqrt(np.maximum(1.0, np.bincount(ids, minlength=v)) / n)
        value, m = scale[ids], len(y)
        unit = 1.0 / np.sqrt(np.maximum(1.0 / n, (earlier[keep] ** 2).sum(axis=0) / n))
        earlier = earlier * unit

        def forward(u):
            return np.bincount(row, u[ids] * value, minlength=m) + earlier @ u[v:v + e] + u[-1]

        def back(r):
            r = np.where(keep, r, 0.0) / n
            return np.concatenate([np.bincount(ids, r[row] * value, minlength=v), earlier.T @ r, [r.sum()]])

        top = np.ones(v + e + 1)
        for _ in range(8):  # largest curvature, by power iteration
            top = back(forward(top))
            size = np.linalg.norm(top) or 1.0
            top /= size
        share = min(0.99, max(0.01, float(y[keep].mean()))) if keep.any() else 0.5
        w = np.zeros(v + e + 1)
        w[-1] = np.log(share / (1 - share))
        free = np.ones(v, bool)
        for l1, l2 in ((p.l1, 0.0), (0.0, p.l2)):  # choose words, then fit the chosen ones without the penalty's shrinkage
            u, t, step = w, 1.0, 4.0 / (1.2 * size + 4 * l2)
            for _ in range(p.iterations):
                g = back(sigmoid(forward(u)) - y)
                g[:v] += l2 * u[:v]
                new = u - step * g
                new[:v] = np.where(free, np.sign(new[:v]) * np.maximum(0.0, np.abs(new[:v]) - step * l1), 0.0)
                t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
                if (u - new) @ (new - w) > 0:  # restart when the momentum points uphill
                    t_new, u = 1.0, new
                else:
                    u = new + (t - 1) / t_new * (new - w)
                w, t = new, t_new
            free = w[:v] != 0
            if not l2:  # the chosen words alone bend the loss less: longer steps
                top = np.ones(v + e + 1)
                for _ in range(8):
                    top[:v] *= free
                    top = back(forward(top))
                    top[:v] *= free
                    size = np.linalg.norm(top) or 1.0
                    top /= size
        return w[:v] * scale, w[v:v + e] * unit, float(w[-1])

    def predict(self, w: np.ndarray, we: np.ndarray, b: float, earlier: np.ndarray) -> np.ndarray:
        z = np.bincount(self.row, w[self.ids], minlength=len(self.labels)) + earlier @ we + b
        return sigmoid(z)


def near_copies(rows: list[np.ndarray], alike: float = 0.6, bands: int = 6, width: int = 6) -> np.ndarray:
    """Which rows are near copies (word Jaccard of ``alike`` or more) of an earlier row, found by
    minhash bands and checked. A text copied often, with its label, must not teach its words."""
    rng = np.random.default_rng(5)
    seeds = rng.integers(1, 1 << 62, bands * width).astype(np.uint64)
    heads: dict[tuple, list[int]] = {}
    out = np.zeros(len(rows), bool)
    for i, r in enumerate(rows):
        if not len(r):
            continue
        low = [int(mix64(r.astype(np.uint64) ^ s).min()) for s in seeds]
        keys = [(b, *low[b * width:(b + 1) * width]) for b in range(bands)]
        for j in sorted({j for k in keys for j in heads.get(k, ())}):
            both = len(np.intersect1d(r, rows[j], assume_unique=True))
            if both >= alike * (len(r) + len(rows[j]) - both):
                out[i] = True
                break
        else:
            for k in keys:
                heads.setdefault(k, []).append(i)
    return out


def train_chain(labelled: DataFrame, categories: list[str], p: Params = Params()) -> Chain:
    """Chain from rows ``(doc_id, text, <one 0/1 column a category>)``; rows with a null id or label are
    left out. Without rows every probability is one half."""
    spark = labelled.sparkSession
    rows = labelled.where(" and ".join(f"`{c}` is not null" for c in ["doc_id", *categories]))
    n = rows.select("doc_id").count()
    pick = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    rows = rows.withColumn("pick", pick).where(F.col("pick") < int((1 << 30) * min(1.0, p.max_rows / max(1, n))))
    src = rows.select("pick", text_bytes().alias("t"), F.array(*[F.col(c).cast("int") for c in categories]).alias("y"))

    def encode(batches):
        for b in batches:
            ids = [word_ids(t, p.bits).astype(np.int32).tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary()), b.column(2)], names=["pick", "ids", "y"])

    # bounded by max_rows
    got = sorted(src.mapInArrow(encode, "pick long, ids binary, y array<int>").collect(), key=lambda r: (r["pick"], r["ids"]))
    copy = near_copies([np.frombuffer(r["ids"], np.int32) for r in got])
    got = [r for r, c in zip(got, copy) if not c]
    y = np.array([r["y"] for r in got], float).reshape(len(got), len(categories))
    fold = np.array([r["pick"] // p.folds % p.folds for r in got], int)
    sample = Sample([np.frombuffer(r["ids"], np.int32) for r in got], y, fold, p)
    shared = spark.sparkContext.broadcast(vars(sample))  # plain data only
    oof = np.zeros((len(got), 0))
    chain = Chain(categories, np.zeros((len(categories), 1 << p.bits), np.float32), [], [], p)
    for k in range(len(categories)):
        fitted = _fit_folds(spark, shared, k, oof, p)
        out = np.zeros(len(got))
        for f, (w, we, b) in fitted.items():
            if f < p.folds:
                out[fold == f] = sample.predict(w, we, b, oof)[fold == f]
        w, we, b = fitted[p.folds]
        chain.words[k, sample.vocab] = w
        chain.earlier.append(we)
        chain.bias.append(b)
        oof = np.column_stack([oof, out])
    return chain


def _fit_folds(spark, shared, k: int, oof: np.ndarray, p: Params) -> dict[int, tuple]:
    """Model without each fold, and at ``folds`` the model of all rows; one Spark task a model."""

    def run(frames):
        for pdf in frames:
            s = Sample.__new__(Sample)
            vars(s).update(shared.value)
            for f in pdf["id"]:
                w, we, b = s.fit(s.fold != f, s.labels[:, k], oof, p)
                yield pd.DataFrame({"f": [f], "w": [w.tobytes()], "e": [we.tobytes()], "b": [b]})

    tasks = spark.range(0, p.folds + 1, 1, p.folds + 1)
    got = tasks.mapInPandas(run, "f long, w binary, e binary, b double").collect()
    return {r["f"]: (np.frombuffer(r["w"]), np.frombuffer(r["e"]), r["b"]) for r in got}


def score(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` plus ``p_<category>`` for every category, in chain order, and ``rejected``
    (1 if the last category's probability reaches the threshold); columns of these names are
    replaced.

    Null and empty texts get the probabilities of a text without words. Repeated rows are scored
    each."""
    new = [f"p_{c}" for c in chain.categories]
    params, plain = chain.params, {k: v for k, v in vars(chain).items() if k != "params"}
    shared = docs.sparkSession.sparkContext.broadcast(plain)
    keep = [c for c in docs.columns if c not in (*new, "rejected")]
    src = docs.select(F.struct(*keep).alias("row"), text_bytes(text_col).alias("t"))

    def run(batches):
        c = Chain(**shared.value, params=params)
        for b in batches:
            p = np.array([c.probabilities(word_ids(t, c.params.bits)) for t in b.column(1).to_pylist()]).reshape(-1, len(new))
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(p[:, k], pa.float64()) for k in range(len(new))]], names=["row", *new])

    row = src.schema["row"].dataType.simpleString()
    got = src.mapInArrow(run, f"row {row}, " + ", ".join(f"`{c}` double" for c in new))
    return got.select("row.*", *new, (F.col(new[-1]) >= chain.params.threshold).cast("int").alias("rejected"))


# English terms of abuse in two groups; a labelled toxic document that holds one is of that category
INSULT = ["idiot", "moron", "clown", "loser", "scum", "fool", "jerk", "liar", "coward", "freak"]
CONTEMPT = ["trash", "garbage", "pathetic", "worthless", "disgusting", "stupid", "dumb", "useless", "vile", "hopeless"]


def weak_categories(text: Column, toxic: Column) -> dict[str, Column]:
    """Category labels of a labelled row: its ``toxic`` mark, split by the words it holds."""
    low = F.lower(F.coalesce(text, F.lit("")))
    has = lambda words: low.rlike(r"\b(" + "|".join(words) + r")\b")
    toxic = toxic.cast("int")
    return {"insult": F.when(has(INSULT), toxic).otherwise(toxic * 0), "contempt": F.when(has(CONTEMPT), toxic).otherwise(toxic * 0), "toxic": toxic}


def train_on_labels(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> Chain:
    """Chain insult, contempt, toxic from ``labels.toxic``; of contradicting labels the larger counts."""
    y = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("__toxic"))
    n = y.count()
    y = y.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, p.max_rows / max(1, n))))  # bounded: about max_rows ids
    rows = docs.select("doc_id", "text").join(F.broadcast(y), "doc_id")
    cats = weak_categories(F.col("text"), F.col("__toxic"))
    return train_chain(rows.select("doc_id", "text", *[c.alias(k) for k, c in cats.items()]), list(cats), p)
