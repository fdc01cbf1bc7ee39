"""Which comma-separated part of an affiliation is the institute's name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affilix.functions.text import clean, digest, sigmoid, split_commas, words
from affilix.operators.skew import grid_join

MIN_PROB = 0.1

# A scorer takes distinct cleaned parts (column ``segment``) and returns ``segment, prob``.
Scorer = Callable[[DataFrame], DataFrame]


def segments(strings: DataFrame, text: str = "affiliate") -> DataFrame:
    """Cleaned parts in order: ``aff_id, pos, segment``, where ``aff_id`` is the digest of the string."""
    return strings.select(
        digest(F.col(text)).alias("aff_id"), F.posexplode(split_commas(F.col(text))).alias("pos", "part")
    ).select("aff_id", "pos", clean(F.col("part")).alias("segment"))


def distinct_segments(parts: DataFrame) -> DataFrame:
    """Each part once: scoring is the costly step."""
    return parts.select("segment").distinct()


def lexicon_scorer(weights: DataFrame, bias: float = 0.0) -> Scorer:
    """``sigmoid(bias + sum of token weights)``, a join with ``weights(token, weight)``; unknown tokens weigh 0."""
    def score(parts: DataFrame) -> DataFrame:
        tokens = parts.select("segment", F.explode_outer(words(F.col("segment"))).alias("token"))
        weighed = grid_join(
            tokens, weights.select("token", "weight"), ["token"], "left",
            spread_left=["segment"], spread_right=["token"],
        )
        total = F.sum(F.coalesce("weight", F.lit(0.0)))
        return weighed.groupBy("segment").agg(total.alias("z")).select(
            "segment", sigmoid(F.lit(bias) + F.col("z")).alias("prob")
        )

    return score


def model_scorer(model) -> Scorer:
    """A fitted Spark ML classifier reading ``segment`` and giving ``probability``."""
    from pyspark.ml.functions import vector_to_array

    def score(parts: DataFrame) -> DataFrame:
        return model.transform(parts).select("segment", vector_to_array("probability")[1].alias("prob"))

    return score


def function_scorer(function: Callable[[Column], Column]) -> Scorer:
    """Any expression or pandas UDF from string to double, for instance one that loads a model per worker."""
    def score(parts: DataFrame) -> DataFrame:
        return parts.select("segment", function(F.col("segment")).cast("double").alias("prob"))

    return score


def fit_segment_model(labelled: DataFrame, features: int = 1 << 16, iterations: int = 20):
    """Logistic regression on hashed tokens, from ``segment, label`` (1 for an institute's name)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF, RegexTokenizer

    stages = [
        RegexTokenizer(inputCol="segment", outputCol="tokens", pattern=" +"),
        HashingTF(inputCol="tokens", outputCol="features", numFeatures=features),
        LogisticRegression(labelCol="label", maxIter=iterations, regParam=0.01),
    ]
    return Pipeline(stages=stages).fit(labelled)


def best_segments(parts: DataFrame, scored: DataFrame, min_prob: float = MIN_PROB) -> DataFrame:
    """``aff_id, extracted``: the first part with the highest probability above ``min_prob``.

    Strings with no such part are left out; whoever joins the result reads that as the empty string.
    """
    likely = scored.filter(F.col("prob") > min_prob).select("segment", "prob")
    rated = grid_join(parts, likely, ["segment"], spread_left=["aff_id", "pos"], spread_right=["segment"])
    top = F.max(F.struct("prob", (-F.col("pos")).alias("back"), "segment"))
    return rated.groupBy("aff_id").agg(top.alias("t")).select("aff_id", F.col("t.segment").alias("extracted"))
