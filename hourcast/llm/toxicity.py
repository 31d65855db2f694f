"""Operator 8: toxicity by non-negative positive-unlabelled learning.

The classifier is fitted from confirmed toxic documents (P) and text taken as
unlabelled (U: a sample of all trainable documents, whatever their label) alone.  With class prior pi and logistic loss l, the risk of score function g is
``pi E_P[l(g)] + max(0, E_U[l(-g)] - pi E_P[l(-g)])``: unlabelled text stands in for
the negatives after taking out its toxic share, and the estimate of the negative
part may not fall below zero; where a step finds it negative, that part is ascended.

Features are the presence of the words that differ most between P and U.  The words'
document counts are summed on the executors; the driver fits on bounded samples
(``MOST_POSITIVE`` and ``MOST_UNLABELLED`` rows of smallest hash of id and text, chosen without moving
any text and written once) of at most ``MOST_WORDS`` features each.  Every document is scored, whole.

Defined cases: null and empty texts have no words and get the score of the
intercept; several labels of one doc_id count as toxic if any does; without a
positive training row all scores are 0; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.llm.common import materialise, table
from hourcast.llm.language_id import _CLEAN, held_out

MOST_POSITIVE = 8_000
MOST_UNLABELLED = 20_000
MOST_WORDS = 400
LEAST_POSITIVE_DOCS = 4
THRESHOLD = 0.7


def words_of(text: bytes | None) -> list[bytes]:
    """Words of ASCII letters (lower-cased) and multi-byte characters."""
    return (text or b"").translate(_CLEAN).split()


@dataclass
class ToxicityModel:
    weights: dict[bytes, float] = field(default_factory=dict)
    intercept: float = -np.inf

    def score(self, text: bytes | None) -> float:
        if not self.weights:
            return 0.0
        g = self.intercept + sum(self.weights[w] for w in self.weights.keys() & set(words_of(text)))
        return float(1 / (1 + np.exp(-np.clip(g, -500, 500))))


def smallest_hashes(rows: DataFrame, most: int) -> Column:
    """A condition on ``h`` (uniform hashes) that about ``most`` rows meet."""
    n = rows.count()
    top = int(-(1 << 63) + min(1.0, most / max(n, 1)) * ((1 << 64) - 1))
    return F.col("h") <= F.lit(min(top, (1 << 63) - 1))


def pu_rows(docs: DataFrame, labels: DataFrame, trainable: Column,
            most_positive: int = MOST_POSITIVE, most_unlabelled: int = MOST_UNLABELLED) -> tuple[DataFrame, float]:
    """Training rows ``(positive, text)`` and the class prior among labelled rows."""
    by_id = labels.where(F.col("toxic").isNotNull() & trainable).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    prior = by_id.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    # which rows are taken is decided on ids and hashes; the text is in the hash, so rows of one doc_id are told apart
    own = docs.where(trainable).select("doc_id", F.xxhash64("doc_id", "text").alias("h"), F.col("text").cast("binary").alias("text"))
    ids = materialise(own.select("doc_id", "h").distinct(), "pu-ids")
    p = ids.join(by_id.where("toxic = 1").select("doc_id"), "doc_id", "left_semi")
    toxic = F.broadcast(p.where(smallest_hashes(p, most_positive)))  # about most_positive rows at the most
    p = own.join(toxic, ["doc_id", "h"], "left_semi").select(F.lit(True).alias("positive"), "h", "text")
    u = own.where(smallest_hashes(ids, most_unlabelled)).select(F.lit(False).alias("positive"), "h", "text")
    return materialise(p.union(u).dropDuplicates(["positive", "h"]).drop("h"), "pu-rows"), float(prior or 0.0)


def pick_words(rows: DataFrame, most: int = MOST_WORDS) -> list[bytes]:
    """Words whose share of documents differs most between P and U (two-sample z)."""

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = list(set(words_of(t)))
                yield pa.RecordBatch.from_arrays([pa.array([p] * len(words), pa.bool_()), pa.array(words, pa.binary())], ["positive", "word"])

    n = rows.groupBy("positive").count().collect()
    n_p, n_u = (float(next((r["count"] for r in n if r["positive"] is k), 0) or 1) for k in (True, False))
    a, b = F.col("p") / n_p, F.col("u") / n_u
    pooled = (F.col("p") + F.col("u") + 1) / (n_p + n_u)
    counts = rows.mapInArrow(distinct, "positive boolean, word binary").groupBy("word").agg(
        F.count_if("positive").alias("p"), F.count_if(~F.col("positive")).alias("u")
    )
    z = F.abs(a - b) / F.sqrt(pooled * (1 / n_p + 1 / n_u))
    top = counts.where(F.col("p") >= LEAST_POSITIVE_DOCS).orderBy(z.desc(), "word").limit(most)
    return [bytes(r["word"]) for r in top.select("word").collect()]


def presence(rows: DataFrame, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Presence matrix of the bounded training sample, and its P flags."""
    index = {w: i for i, w in enumerate(words)}

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [sorted(index[w] for w in index.keys() & set(words_of(t))) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(at, pa.list_(pa.int16()))], ["positive", "at"])

    found = rows.mapInArrow(pack, "positive boolean, at array<short>").collect()
    x = np.zeros((len(found), len(words)), np.float32)
    for i, r in enumerate(found):
        x[i, r["at"]] = 1
    return x, np.array([r["positive"] for r in found], bool)


def fit_nnpu(x_p: np.ndarray, x_u: np.ndarray, prior: float, steps: int = 400, rate: float = 0.05, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and intercept that minimise the non-negative PU risk (Adam, all rows a step)."""
    w = np.zeros(x_p.shape[1] + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    x_p, x_u = (np.hstack([x, np.ones((len(x), 1), np.float32)]) for x in (x_p, x_u))
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for t in range(1, steps + 1):
        g_p, g_u = x_p @ w, x_u @ w
        negative = np.logaddexp(0, g_u).mean() - prior * np.logaddexp(0, g_p).mean()
        d_positive = prior * x_p.T @ (sigmoid(g_p) - 1) / len(x_p)
        d_negative = x_u.T @ sigmoid(g_u) / len(x_u) - prior * x_p.T @ sigmoid(g_p) / len(x_p)
        grad = d_positive + d_negative if negative >= 0 else -d_negative
        grad[:-1] += decay * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1], float(w[-1])


def fit_toxicity(docs: DataFrame, labels: DataFrame, trainable: Column) -> ToxicityModel:
    rows, prior = pu_rows(docs, labels, trainable)
    words = pick_words(rows)
    if not words or not 0 < prior < 1:
        return ToxicityModel()
    x, positive = presence(rows, words)
    if positive.all() or not positive.any():
        return ToxicityModel()
    w, b = fit_nnpu(x[positive], x[~positive], prior)
    return ToxicityModel(dict(zip(words, w.tolist(), strict=True)), b)


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: doc_id, score (0 to 1)."""
    weights, intercept = model.weights, model.intercept  # at most MOST_WORDS words

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = ToxicityModel(weights, intercept)
        for batch in batches:
            s = [fitted.score(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(score, "doc_id long, score double")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out_of_fit = F.coalesce(held_out(F.col("doc_id"), 3, 1), F.lit(True))
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"), ~out_of_fit)
    return score_toxicity(docs, model).select(
        "doc_id", F.coalesce(held_out(F.col("doc_id"), 3, 1), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
