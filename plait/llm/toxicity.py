"""Toxicity by a classifier chain.

Categories are predicted one after the other by linear models over the words
of a text; each later model also reads the probabilities of the earlier
categories.  In training these are out-of-fold predictions, so that a later
model sees them as they will be on new documents.  Thresholds come from the
same out-of-fold predictions.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import cut

WORDS = re.compile(r"\w+")
#: Labelled documents the models are fitted on, at most; they are those with the smallest hashed ids.
SAMPLE_ROWS = 8000
#: Features a model reads, at most.
VOCABULARY = 4096
FOLDS = 5
#: Letters of the word beginnings that are features beside whole words.
PREFIX = 5


def features(text: str | None) -> set[str]:
    """Distinct words of a text in lower case, and their beginnings."""
    words = set(WORDS.findall((text or "").lower()))
    return words | {w[:PREFIX] + "*" for w in words if len(w) > PREFIX}


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Rows:
    """Binary features of documents, as sorted (row, feature) pairs, and dense columns."""

    def __init__(self, lists: list[np.ndarray], n_features: int):
        self.n, self.n_features = len(lists), n_features
        self.row = np.repeat(np.arange(self.n), [len(x) for x in lists])
        self.col = np.concatenate([*lists, np.zeros(0)]).astype(np.int64)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.col], self.n)

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, r[self.row], self.n_features)


def fit_linear(x: Rows, dense: np.ndarray, y: np.ndarray, use: np.ndarray, l2: float = 0.3,
               rounds: int = 150) -> np.ndarray:
    """Weights of a logistic regression over the rows in ``use``: features,
    dense columns, intercept."""
    n, d = x.n_features, dense.shape[1]
    w, m, v = np.zeros(n + d + 1), np.zeros(n + d + 1), np.zeros(n + d + 1)
    rate = np.clip(y[use].mean() if use.any() else 0.0, 1e-4, 1 - 1e-4)
    w[-1] = np.log(rate / (1 - rate))
    total = max(use.sum(), 1)
    for t in range(1, rounds + 1):
        r = np.where(use, _sigmoid(x.times(w[:n]) + dense @ w[n:n + d] + w[-1]) - y, 0.0)
        g = np.concatenate([x.back(r) + l2 * w[:n], dense.T @ r + l2 * w[n:n + d], [r.sum()]]) / total
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.15 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    return w


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The threshold of the best F1 of out-of-fold predictions; 1 without positives."""
    if not y.any():
        return 1.0
    order = np.argsort(-p, kind="stable")
    hit = np.cumsum(y[order])
    f1 = 2 * hit / (np.arange(1, len(y) + 1) + y.sum())
    at = int(np.argmax(f1))
    below = p[order[at + 1]] if at + 1 < len(p) else 0.0
    return float((p[order[at]] + below) / 2)


@dataclass
class Chain:
    """A fitted chain: feature numbers, then weights and a threshold per category."""

    categories: tuple[str, ...]
    vocabulary: dict[str, int]
    weights: list[np.ndarray] = field(default_factory=list)
    thresholds: list[float] = field(default_factory=list)
    #: Out-of-fold F1 of each category on the sample.
    f1: list[float] = field(default_factory=list)

    def predict(self, text: str | None) -> list[float]:
        n = len(self.vocabulary)
        at = [self.vocabulary[w] for w in features(text) if w in self.vocabulary]
        out: list[float] = []
        for w in self.weights:
            z = w[-1] + w[at].sum() + sum(w[n + i] * p for i, p in enumerate(out))
            out.append(float(_sigmoid(np.float64(z))))
        return out


def fit(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...], *, doc_id: str = "doc_id",
        text: str = "text", sample_rows: int = SAMPLE_ROWS, vocabulary: int = VOCABULARY) -> Chain:
    """Fit a chain on at most ``sample_rows`` labelled documents.

    ``labels`` has ``doc_id`` and a 0/1 column per category; rows with a null
    id or label are left out.  Of rows that repeat an id the largest labels and
    the text of the smallest hash count, whatever the order of rows.  Without
    labels, or where a category has one value only, its probability is
    constant and nothing is above its threshold.
    """
    spark = docs.sparkSession
    ship_package(spark)
    known = [F.col(c).cast("int").alias(f"_pl_{i}") for i, c in enumerate(categories)]
    most = [F.max(f"_pl_{i}").alias(f"_pl_{i}") for i in range(len(categories))]
    chosen = labels.select(F.col(doc_id).alias("_pl_id"), *known).dropna().groupBy("_pl_id").agg(*most) \
        .orderBy(F.xxhash64("_pl_id"), "_pl_id").limit(sample_rows)
    ys = [f"_pl_{i}" for i in range(len(categories))]
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")) \
        .join(F.broadcast(chosen), F.col("id") == F.col("_pl_id")).groupBy("id", *ys) \
        .agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("first")).select("id", *ys, "first.text")

    def read(batches):
        for b in batches:
            found = [sorted(features(t.as_py())) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), *[b.column(c) for c in ys], pa.array(found, pa.list_(pa.string()))],
                ["id", *ys, "features"])
    kind = dict(texts.dtypes)["id"]
    sample = cut(texts.mapInArrow(read, f"id {kind}, " + ", ".join(f"{c} int" for c in ys) + ", features array<string>"))

    totals = sample.agg(F.count("*"), *[F.sum(c) for c in ys]).first()
    n, positive = totals[0], [x or 0 for x in totals[1:]]
    counts = sample.select(F.explode("features").alias("f"), *ys).groupBy("f") \
        .agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in ys])
    words: dict[str, int] = {}
    for c, pos in zip(ys, positive):
        expected = F.col("n") * (pos / max(n, 1))
        gain = (F.col(c) - expected) * (F.col(c) - expected) / (expected + F.lit(0.5))
        top = counts.orderBy(gain.desc(), "f").limit(vocabulary // len(ys)).select("f")
        for (w,) in top.collect():
            words.setdefault(w, len(words))

    def number(batches):
        for b in batches:
            at = [[words[w] for w in row.as_py() if w in words] for row in b.column("features")]
            yield pa.RecordBatch.from_arrays(
                [b.column("fold"), *[b.column(c) for c in ys], pa.array(at, pa.list_(pa.int32()))], ["fold", *ys, "at"])
    fold = F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(FOLDS)).cast("int")
    rows = sample.select(fold.alias("fold"), *ys, "features") \
        .mapInArrow(number, "fold int, " + ", ".join(f"{c} int" for c in ys) + ", at array<int>").toPandas()

    chain = Chain(tuple(categories), words)
    x, folds = Rows(list(rows["at"]), len(words)), rows["fold"].to_numpy(dtype=np.int64)
    dense, everything = np.zeros((x.n, 0)), np.ones(x.n, bool)
    for c in ys:
        y = rows[c].to_numpy(dtype=float)
        held_out = np.zeros(x.n)
        for k in np.unique(folds):
            w = fit_linear(x, dense, y, folds != k)
            z = x.times(w[:x.n_features]) + dense @ w[x.n_features:-1] + w[-1]
            held_out[folds == k] = _sigmoid(z)[folds == k]
        limit = best_threshold(held_out, y) if 0 < y.sum() < len(y) else 1.0
        above = held_out > limit
        chain.weights.append(fit_linear(x, dense, y, everything))
        chain.thresholds.append(limit)
        chain.f1.append(float(2 * (above & (y > 0)).sum() / max(above.sum() + y.sum(), 1)))
        dense = np.column_stack([dense, held_out])
    return chain


def drop_flagged(docs: DataFrame, chain: Chain, category: str, *, text: str = "text") -> DataFrame:
    """The input rows, unchanged, whose probability of ``category`` is not
    above its threshold."""
    ship_package(docs.sparkSession)
    at = chain.categories.index(category)

    @F.arrow_udf("double")
    def predict(texts: pa.Array) -> pa.Array:
        return pa.array([chain.predict(t.as_py())[at] for t in texts], pa.float64())
    return docs.filter(predict(F.col(text)) <= F.lit(chain.thresholds[at]))


def score(docs: DataFrame, chain: Chain, *, text: str = "text") -> DataFrame:
    """The input rows with ``p_<category>`` per category and ``is_<category>``
    where the probability is above the category's threshold.

    Whole texts are read; a null or empty text has no features.  An input
    column with the name of an output column is replaced.
    """
    ship_package(docs.sparkSession)
    names = [f"p_{c}" for c in chain.categories]

    @F.arrow_udf("struct<" + ",".join(f"{n}:double" for n in names) + ">")
    def predict(texts: pa.Array) -> pa.Array:
        rows = [chain.predict(t.as_py()) for t in texts]
        return pa.StructArray.from_arrays([pa.array([r[i] for r in rows], pa.float64()) for i in range(len(names))], names)

    base = docs.drop(*(set(docs.columns) & {*names, *(f"is_{c}" for c in chain.categories)}))
    out = base.withColumn("_pl_p", predict(F.col(text))).select(*base.columns, "_pl_p.*")
    return out.withColumns({f"is_{c}": F.col(f"p_{c}") > F.lit(t) for c, t in zip(chain.categories, chain.thresholds)})
