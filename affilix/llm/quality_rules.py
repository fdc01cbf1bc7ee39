"""Quality rules that vote: weak supervision in place of a filter that every rule must pass.

Each rule votes for a text, against it, or abstains. Expectation-maximisation estimates from the votes alone how far each
can be trusted; the posterior probability of good quality decides. DataFrame functions only: the corpus
is reduced to one count per vote pattern, of which ``3 ** rules`` exist, and the estimation works on those.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affilix.llm.common import SPACE, let
from affilix.session import materialize

WINDOW = 5
SYMBOLS = "#*$%&|<>"
VOTES = (-1, 0, 1)
#: What is assumed of every rule: it speaks against so many good texts at most, and against so many with its fault at least.
#: Votes alone cannot tell a fault that only one rule sees from a whim of that rule.
MOST_WRONG, LEAST_OWN = 0.02, 0.9


def words_of(text: Column) -> Column:
    """Runs of characters other than white space."""
    return F.array_remove(F.split(text, SPACE + "+", -1), "")


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Number of words inside windows of ``window`` words that occur twice or more in the text, the first included.

    Windows are compared by 64-bit hashes. The positions of equal windows are found by sorting, in ``n log n``.
    """
    def count(hashes: Column) -> Column:
        at = F.sequence(F.lit(1), F.size(hashes) - (window - 1))
        keys = F.transform(at, lambda i: F.xxhash64(*[F.element_at(hashes, i + k) for k in range(window)]))
        return let(keys, lambda k: F.when(F.size(F.array_distinct(k)) == F.size(k), 0).otherwise(covered(k)))

    def covered(keys: Column) -> Column:
        pairs = F.sort_array(F.transform(keys, lambda key, i: F.struct(key.alias("key"), i.alias("i"))))

        def twice(s: Column) -> Column:
            def equal(x: Column, n: Column) -> Column:
                before = F.coalesce(F.get(s, n - 1)["key"] == x["key"], F.lit(False))
                after = F.coalesce(F.get(s, n + 1)["key"] == x["key"], F.lit(False))
                return before | after

            return F.sort_array(F.transform(F.filter(s, equal), lambda x: x["i"]))

        def added(found: Column) -> Column:
            new = F.transform(found, lambda i, n: F.least(F.lit(window), i - F.coalesce(F.get(found, n - 1), F.lit(-window))))
            return F.aggregate(new, F.lit(0), lambda a, b: a + b)

        return let(let(pairs, twice), added)

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) > window, let(hashed, count)).otherwise(0)


def text_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts that rules look at, from the whole text of every row; a null text has no words."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), words_of(text).alias("words"))
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    return rows.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace("text", f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.char_length(F.regexp_replace("text", "[^\n]+", "")).cast("long").alias("n_breaks"),
        repeated_words(F.col("words")).cast("long").alias("n_repeat_words"),
        F.char_length(F.regexp_replace("text", r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
        F.char_length(F.regexp_replace("text", "[^!?]+", "")).cast("long").alias("n_marks"),
    )


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def _against(bad: Column) -> Column:
    """A rule that knows one fault only: that a text lacks it is no vote for the text."""
    return F.when(bad, -1).otherwise(0)


def _rules() -> dict[str, Column]:
    n = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    length = chars / n
    few = F.col("n_words") < 20
    return {
        "length": _vote(F.col("n_words") >= 50, F.col("n_words") < 10),
        "word_length": _vote(length.between(2.5, 11.0), (length < 2.0) | (length > 14.0)),
        "symbols": _against(F.col("n_symbols") * 5 >= n),
        "lines": _against(F.col("n_dup_lines") * 2 > F.col("n_breaks") + 1),
        "repeats": _against(F.col("n_repeat_words") * 5 > n),
        "capitals": _against(~few & (F.col("n_upper") * 10 >= chars * 3)),
        "marks": _against(~few & (F.col("n_marks") * 5 >= n)),
    }


RULES = ["length", "word_length", "symbols", "lines", "repeats", "capitals", "marks"]


def votes(statistics: DataFrame) -> DataFrame:
    """``statistics`` with one column of votes per rule (1 for, -1 against, 0 abstains), named after the rule."""
    return statistics.withColumns(_rules())


class VoteModel(NamedTuple):
    """Latent classes: good texts first, then texts with the fault of each rule. ``share`` is the size of each class,
    ``chance[rule][vote]`` the probability of that vote in each class."""

    share: list[float]
    chance: dict[str, dict[int, list[float]]]

    def accuracy(self, rule: str) -> float:
        """How often a vote against is cast on a text that is not good."""
        cast = [s * c for s, c in zip(self.share, self.chance[rule][-1])]
        return sum(cast[1:]) / sum(cast)


def _bounded(chance: dict[int, list[float]], k: int, against: float) -> None:
    """Set the chance of a vote against in class ``k``, the other votes keeping their proportion."""
    rest = (1 - against) / max(1 - chance[-1][k], 1e-12)
    for v in VOTES:
        chance[v][k] = against if v < 0 else chance[v][k] * rest


def _classes(model: VoteModel, pattern: tuple[int, ...], names: list[str]) -> list[float]:
    logs = [
        math.log(s) + sum(math.log(model.chance[name][v][k]) for v, name in zip(pattern, names))
        for k, s in enumerate(model.share)
    ]
    top = max(logs)
    odds = [math.exp(x - top) for x in logs]
    return [x / sum(odds) for x in odds]


def fit_votes(patterns: list[tuple[tuple[int, ...], int]], names: list[str], rounds: int = 30) -> VoteModel:
    """Estimate the model from (votes, count) pairs by expectation-maximisation.

    Texts are bad in one way each, so rules against them seldom agree, and two classes would leave all but the commonest
    fault among the good. Hence one class for each fault. It starts with the texts its rule votes against, shared evenly
    among such rules and with a tenth for the good; later rounds decide which votes to believe. Counts are smoothed by
    one text for each vote.
    """
    total = sum(count for _, count in patterns)
    weight = []
    for votes_cast, _ in patterns:
        against = [v < 0 for v in votes_cast]
        bad = 0.9 if any(against) else 0.1
        even = [a / sum(against) for a in against] if any(against) else [1 / len(names)] * len(names)
        weight.append([1 - bad, *[bad * e for e in even]])
    model = VoteModel([], {})
    for _ in range(rounds):
        n_classes = len(names) + 1
        share = [(sum(w[k] * c for w, (_, c) in zip(weight, patterns)) + 1) / (total + n_classes) for k in range(n_classes)]
        chance = {}
        for j, name in enumerate(names):
            seen = {v: [1.0] * n_classes for v in VOTES}
            for w, (cast, c) in zip(weight, patterns):
                for k in range(n_classes):
                    seen[cast[j]][k] += w[k] * c
            sums = [sum(x[k] for x in seen.values()) for k in range(n_classes)]
            chance[name] = {v: [a / b for a, b in zip(x, sums)] for v, x in seen.items()}
            _bounded(chance[name], 0, min(chance[name][-1][0], MOST_WRONG))
            _bounded(chance[name], j + 1, max(chance[name][-1][j + 1], LEAST_OWN))
        model = VoteModel(share, chance)
        weight = [_classes(model, cast, names) for cast, _ in patterns]
    return model


def quality_of(model: VoteModel, pattern: tuple[int, ...], names: list[str]) -> float:
    return _classes(model, pattern, names)[0]


def posterior(model: VoteModel) -> Column:
    """Probability of good quality given the vote columns: the share of the good class in the sum over all classes."""
    def log_weight(k: int) -> Column:
        total = F.lit(math.log(model.share[k]))
        for name, by_vote in model.chance.items():
            total = total + F.element_at(
                F.create_map(*[x for v in VOTES for x in (F.lit(v), F.lit(math.log(by_vote[v][k])))]), F.col(name)
            )
        return total

    good, *bad = [log_weight(k) for k in range(len(model.share))]
    return 1 / (1 + sum((F.exp(b - good) for b in bad), F.lit(0.0)))


def judge(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """Statistics, votes, ``quality`` (the posterior), ``base_failed`` and ``kept`` of every row of ``docs``.

    ``base_failed``: fewer than 10 words, or over a fifth of them in repeated windows. ``kept``: not failed and a
    posterior of ``least`` or more. Repeated rows and null ids stay; an empty table gives an empty one.
    """
    measured = votes(materialize(text_statistics(docs), "quality_statistics"))
    # At most 3 ** 7 patterns, whatever the corpus.
    rows = measured.groupBy(*RULES).agg(F.count("*").alias("n")).collect()
    model = fit_votes(sorted((tuple(r[k] for k in RULES), r["n"]) for r in rows), RULES)
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    return (
        measured.withColumn("quality", posterior(model))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least))
    )
