"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates.

A text is a sparse vector of hashed words and word pairs, scaled to length 1; its score is a sparse dot product. Training
takes a bounded sample of labelled texts, dealt into a fixed number of shards; each shard runs FTRL-Proximal (McMahan et
al. 2013) over its texts, and the weights of the shards are averaged. There are at most ``BUCKETS`` weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affilix.llm.common import Tokens, chunks, labelled_sample, mix, with_labels

BITS = 18
BUCKETS = 1 << BITS
MAX_TRAINING = 12_000
SHARDS = 4
EPOCHS = 4
PARTS, HELD_OUT = 3, 1

_VALUES = np.arange(256, dtype=np.uint64)
_VALUES[:33] = 0
_KINDS = np.full(256, 2, dtype=np.uint8)
_KINDS[:33] = 0
for _b in range(33, 256):
    if 48 <= _b <= 57 or 65 <= _b <= 90 or 97 <= _b <= 122 or _b >= 128:
        _KINDS[_b] = 1
#: What a word followed by itself counts as.
_TWICE = np.uint64(0x5bd1e995)


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the text, bucket, value) of every feature; the values of a text have length 1.

    Words are runs of letters and digits, or of other signs. Features are words and pairs of neighbours in one text.
    """
    tokens = Tokens(texts, _VALUES, _KINDS)
    a, b = tokens.hashes[:-1], tokens.hashes[1:]
    near = tokens.text[:-1] == tokens.text[1:]
    pairs = np.where(a == b, _TWICE, a * np.uint64(0x9FB21C651E98DF25) + b)[near]
    text = np.concatenate([tokens.text, tokens.text[:-1][near]]).astype(np.int64)
    bucket = (mix(np.concatenate([tokens.hashes, pairs])) >> np.uint64(64 - BITS)).astype(np.int64)
    keys, counts = np.unique((text << BITS) | bucket, return_counts=True)
    text, bucket = keys >> BITS, keys & (BUCKETS - 1)
    value = counts.astype(np.float64)
    length = np.sqrt(np.bincount(text, weights=value * value, minlength=len(texts)))
    return text, bucket, value / length[text]


class Ftrl:
    """FTRL-Proximal for logistic loss; bucket ``size`` is the bias."""

    def __init__(self, size: int, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.01, l2: float = 0.05):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros(size + 1)
        self.n = np.zeros(size + 1)

    def weights(self, at) -> np.ndarray:
        z = self.z[at]
        free = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0.0)
        return -free / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2)

    def update(self, at: np.ndarray, value: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ value, -35, 35))) - label) * value
        square = g * g
        self.z[at] += g - (np.sqrt(self.n[at] + square) - np.sqrt(self.n[at])) / self.alpha * w
        self.n[at] += square


class Model(NamedTuple):
    """Weights of every bucket; the last is the bias."""

    weights: np.ndarray


def predict(models: list[Model], texts: list[bytes]) -> np.ndarray:
    """Scores of texts, a row per text and a column per model."""
    if not texts:
        return np.zeros((0, len(models)))
    text, bucket, value = features(texts)
    dots = [np.bincount(text, weights=m.weights[bucket] * value, minlength=len(texts)) + m.weights[-1] for m in models]
    return 1 / (1 + np.exp(-np.clip(np.stack(dots, axis=1), -35, 35)))


def _train(rows: pd.DataFrame) -> pd.DataFrame:
    model = Ftrl(BUCKETS)
    rows = rows.sort_values(["order", "doc_id"])
    examples = [
        (np.append(at, BUCKETS), np.append(value, 1.0), label)
        for at, value, label in zip(rows["bucket"], rows["value"], rows["label"])
    ]
    for _ in range(EPOCHS):
        for at, value, label in examples:
            model.update(at, value, label)
    w = model.weights(np.arange(BUCKETS + 1))
    kept = np.flatnonzero(w)
    return pd.DataFrame({"bucket": kept, "weight": w[kept]})


def _vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for first, part in chunks([t.encode() for t in batch["text"]]):
            text, bucket, value = features(part)
            cuts = np.searchsorted(text, np.arange(1, len(part)))
            rows = batch.iloc[first:first + len(part)]
            yield pd.DataFrame({
                "doc_id": rows["doc_id"].to_numpy(), "label": rows["label"].to_numpy(),
                "bucket": np.split(bucket.astype(np.int32), cuts), "value": np.split(value.astype(np.float32), cuts),
            })


def fit(examples: DataFrame) -> Model:
    """A model of ``doc_id, text, label`` rows, which must be few enough to train on; see :func:`labelled_sample`.

    Without examples every text scores one half.
    """
    doc_id = examples.schema["doc_id"].dataType.simpleString()
    rows = examples.mapInPandas(_vectors, f"doc_id {doc_id}, label int, bucket array<int>, value array<float>")
    dealt = rows.withColumn("order", F.xxhash64("doc_id")).withColumn("shard", F.pmod("order", F.lit(SHARDS)))
    trained = dealt.groupBy("shard").applyInPandas(_train, "bucket long, weight double")
    weights = np.zeros(BUCKETS + 1)
    # One number per bucket at most.
    for row in trained.groupBy("bucket").agg((F.sum("weight") / SHARDS).alias("weight")).collect():
        weights[row["bucket"]] = row["weight"]
    return Model(weights)


def scorer(spark: SparkSession, models: list[Model]) -> Column:
    """A column function: the scores of a text under each model, as an array. A null text counts as empty."""
    shared = spark.sparkContext.broadcast(models)

    @F.pandas_udf("array<double>")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out: list[list[float]] = []
            for _, part in chunks([("" if t is None else t).encode() for t in batch]):
                out += predict(shared.value, part).tolist()
            yield pd.Series(out)

    return score


def fit_quality(docs: DataFrame, labels: DataFrame, learn: Column, bound: int = MAX_TRAINING) -> Model:
    """A model of ``labels.quality`` from at most ``bound`` labelled documents for which ``learn`` holds."""
    return fit(with_labels(docs, labelled_sample(labels, "quality", bound, learn)))


def score_documents(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """``doc_id, score, predicted`` of every row; repeated rows and null ids stay."""
    scores = scorer(docs.sparkSession, [model])(F.col("text"))
    return docs.select("doc_id", F.element_at(scores, 1).alias("score")).withColumn(
        "predicted", (F.col("score") >= least).cast("int")
    )
