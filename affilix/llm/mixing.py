"""Mixing to target weights with soft memberships.

A classifier trained on the labelled table gives every document a probability for each domain. Document rates, none
negative, are fitted by projected gradient descent so that expected tokens per domain meet the targets.

Documents with the same probabilities in hundredths share a rate. So the corpus is reduced to the cells of a grid, at most
``101 * 101`` whatever its size, each with its tokens and the exact expected tokens of each domain, and the descent runs over
those. It starts at rate 1 and moves no further than needed.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affilix.llm.common import chunks
from affilix.llm.quality_classifier import Model, fit_quality, predict
from affilix.llm.toxicity import Lexicon, Matcher, fit_toxicity
from affilix.session import materialize

LOG = logging.getLogger(__name__)

DOMAINS = ("good", "low", "toxic")
TARGETS = {"good": 0.90, "low": 0.08, "toxic": 0.02}
MAX_TRAINING = 6_000
STEPS = 60
TOLERANCE = 1e-4
PATIENCE = 20


class Domains(NamedTuple):
    """The classifier: hashed n-grams for quality, a weighted lexicon for toxicity."""

    quality: Model
    toxic: Lexicon


def fit_domains(docs: DataFrame, labels: DataFrame, learn: Column, bound: int = MAX_TRAINING) -> Domains:
    """Both parts from at most ``bound`` labelled documents each, of those for which ``learn`` holds."""
    return Domains(fit_quality(docs, labels, learn, bound), fit_toxicity(docs, labels, learn, bound))


def memberships(docs: DataFrame, domains: Domains) -> Column:
    """A column function of a text: ``tokens`` (words), and the probabilities ``quality`` and ``toxic``."""
    shared = docs.sparkSession.sparkContext.broadcast(domains)

    @F.pandas_udf("tokens long, quality double, toxic double")
    def classify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(shared.value.toxic)
        for batch in batches:
            texts = ["" if t is None else t for t in batch]
            tokens, scores = [], []
            for _, part in chunks(t.encode() for t in texts):
                tokens += [len(t.split()) for t in part]
                scores.append(predict([shared.value.quality], part)[:, 0])
            quality = np.concatenate([*scores, np.zeros(0)])
            toxic = np.array([matcher.score(t) for t in texts], dtype=float)
            yield pd.DataFrame({"tokens": tokens, "quality": quality, "toxic": toxic})

    return classify


def posteriors(quality: Column, toxic: Column) -> list[Column]:
    """Domain probabilities, in the order of :data:`DOMAINS`."""
    return [quality * (1 - toxic), (1 - quality) * (1 - toxic), toxic]


def shares(cells: DataFrame) -> list[Column]:
    """Domain probabilities of a cell: its expected tokens ``in_good, in_low, in_toxic`` by its tokens if it has them, else
    those of its place in the grid."""
    place = posteriors(F.col("quality") / 100.0, F.col("toxic") / 100.0)
    if not {f"in_{d}" for d in DOMAINS} <= set(cells.columns):
        return place
    return [F.when(F.col("tokens") > 0, F.col(f"in_{d}") / F.col("tokens")).otherwise(p) for d, p in zip(DOMAINS, place)]


def after(moves: list[tuple[list[float], float]], what: str, share: list[Column]) -> Column:
    """``rate`` of a cell after the given steps (slope per domain, momentum) from rate 1, or the point ``ahead`` at which
    the next slope is taken: the momentum carries the last step on."""
    if not moves:
        return F.lit(1.0)
    steps = F.expr("array(%s)" % ", ".join(
        "array(%s)" % ", ".join(f"{float(x)!r}D" for x in (*slope, momentum)) for slope, momentum in moves
    ))
    begin = F.struct(F.lit(1.0).alias("rate"), F.lit(1.0).alias("ahead"))

    def step(acc: Column, move: Column) -> Column:
        slope = sum((p * move[k] for k, p in enumerate(share)), F.lit(0.0))
        rate = F.greatest(acc["ahead"] - slope, F.lit(0.0))
        return F.struct(rate.alias("rate"), (rate + move[len(share)] * (rate - acc["rate"])).alias("ahead"))

    return F.aggregate(steps, begin, step, lambda acc: acc[what])


def fit_rates(cells: DataFrame, targets: dict[str, float], steps: int = STEPS) -> DataFrame:
    """``cells`` (``quality, toxic`` in hundredths, ``tokens``, see :func:`shares`) with ``rate``, expected tokens per domain being ``targets`` of all tokens.

    Least squares of the relative misses by accelerated projected gradients. Targets are scaled to sum 1. A domain without
    any expected token cannot be met and is left aside. Stops within a ten-thousandth, or when the misses no longer shrink;
    what is missed then is logged, see also :func:`misses`.

    The steps are taken in numpy over four numbers a cell, at most ``101 * 101`` cells whatever the corpus: a job per step
    left the driver a growing plan and a compiled class for each.
    """
    total = cells.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n")).first()["n"]
    if not total:
        return cells.withColumn("rate", F.lit(1.0))
    goal = np.array([max(0.0, targets.get(d, 0.0)) for d in DOMAINS])
    goal = goal / (goal.sum() or 1.0)
    share = shares(cells)
    mass = F.col("tokens") / float(total)
    row = cells.agg(*[
        F.sum(mass * share[i] * share[j]).alias(f"m{i}{j}") for i in range(3) for j in range(3)
    ]).first()
    weight = 1 / np.maximum(goal, 0.01)
    curvature = np.array([[row[f"m{i}{j}"] for j in range(3)] for i in range(3)]) * np.sqrt(np.outer(weight, weight))
    rate_of_step = 1 / float(np.linalg.eigvalsh(curvature)[-1])
    weight = np.where(np.diag(curvature) > 0, weight, 0.0)
    grid = cells.select(mass.alias("mass"), *[p.alias(d) for d, p in zip(DOMAINS, share)]).toPandas()
    part, masses = grid[list(DOMAINS)].to_numpy(dtype=np.float64), grid["mass"].to_numpy(dtype=np.float64)
    held = ~np.isnan(masses)
    part, masses = part[held], masses[held]
    rate = point = np.ones(len(masses))
    moves: list[tuple[list[float], float]] = []
    speed = 1.0
    history: list[float] = []
    for _ in range(steps):
        miss = (masses * point) @ part - goal
        if np.all(np.abs(miss) * (weight > 0) <= TOLERANCE * np.maximum(goal, 0.01)):
            break
        history.append(float(np.sum(weight * miss * miss)))
        if len(history) > PATIENCE and min(history[-PATIENCE:]) > 0.99 * min(history[:-PATIENCE]):
            break
        if len(history) > 1 and history[-1] > history[-2]:
            speed = 1.0
        later = (1 + np.sqrt(1 + 4 * speed * speed)) / 2
        slope, momentum = rate_of_step * weight * miss, float((speed - 1) / later)
        moves.append((slope.tolist(), momentum))
        before, rate = rate, np.maximum(point - part @ slope, 0.0)
        point = rate + momentum * (rate - before)
        speed = later
    cells = cells.withColumn("rate", F.greatest(after(moves, "ahead", share), F.lit(0.0)))
    got = cells.agg(*[F.sum(mass * p * F.col("rate")).alias(d) for d, p in zip(DOMAINS, share)]).first()
    for d, wanted in zip(DOMAINS, goal.tolist()):
        if abs(got[d] - wanted) > TOLERANCE * max(wanted, 0.01):
            LOG.warning("target of %s not met: %.6f of all tokens instead of %.6f", d, got[d], wanted)
    return cells


def misses(mixed: DataFrame, targets: dict[str, float] = TARGETS) -> DataFrame:
    """``domain, target, reached, miss``: what the rates of a result of :func:`mix` leave of the targets, as parts of all
    tokens."""
    whole = sum(max(0.0, targets.get(d, 0.0)) for d in DOMAINS) or 1.0
    total = F.sum("tokens")
    sums = mixed.agg(*[(F.sum(F.col("tokens") * F.col("rate") * F.col(f"p_{d}")) / total).alias(d) for d in DOMAINS])
    rows = F.array(*[
        F.struct(F.lit(d).alias("domain"), F.lit(max(0.0, targets.get(d, 0.0)) / whole).alias("target"), F.col(d).alias("reached"))
        for d in DOMAINS
    ])
    return sums.select(F.inline(rows)).withColumn("miss", F.col("reached") - F.col("target"))


def mix(
    docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, keep: list[str] | None = None,
    learn: Column | None = None, domains: Domains | None = None,
) -> DataFrame:
    """The columns ``keep`` of every row with ``tokens``, ``p_good, p_low, p_toxic``, ``rate`` and ``copies``.

    ``rate`` says how often a document is to be read; ``copies`` is that as a whole number, rounded up or down by a hash
    of the id. Texts that are null or empty have no tokens. Nothing is dropped; repeated rows and null ids stay. Columns
    of ``docs`` with the names of the results are replaced. ``learn`` says which labels may be learned from,
    ``domains`` is a classifier to use instead of one learned from ``docs`` and ``labels``.
    """
    keep = keep or ["doc_id"]
    added = ["tokens", "quality", "toxic", "_found", "_q", "_t", *[f"p_{d}" for d in DOMAINS], "rate", "copies"]
    keep = [c for c in keep if c not in added]
    classify = memberships(docs, domains or fit_domains(docs, labels, F.lit(True) if learn is None else learn))
    found = docs.select(*keep, classify("text").alias("_found")).select(*keep, "_found.*")
    place = {"_q": F.rint(F.col("quality") * 100).cast("int"), "_t": F.rint(F.col("toxic") * 100).cast("int")}
    found = materialize(found.withColumns(place), "memberships")
    share = posteriors(F.col("quality"), F.col("toxic"))
    cells = materialize(
        found.groupBy("_q", "_t").agg(
            F.sum("tokens").alias("tokens"), *[F.sum(F.col("tokens") * p).alias(f"in_{d}") for d, p in zip(DOMAINS, share)]
        ).withColumnsRenamed({"_q": "quality", "_t": "toxic"}), "mixing_cells"
    )
    rates = fit_rates(cells, targets).select(F.col("quality").alias("_q"), F.col("toxic").alias("_t"), "rate")
    chance = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1_000_000)) / 1_000_000.0
    copies = F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("long")
    # At most 101 * 101 rates.
    return found.join(F.broadcast(rates), ["_q", "_t"]).select(
        *keep, "tokens", *[p.alias(f"p_{d}") for d, p in zip(DOMAINS, share)], "rate", copies.alias("copies")
    )
