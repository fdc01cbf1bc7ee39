"""Toxicity: a weighted lexicon matched by an Aho-Corasick automaton after folding, with exception phrases.

Folding maps homoglyphs and digit substitutions to plain letters and everything else to blanks. Lexicon entries are whole
words or beginnings of words; an exception is a whole word or phrase, and what it covers does not count. Entries, their
weights and exceptions are learned from a bounded sample of labelled texts, so is the calibration of the evidence, which is
normalised by length.
"""

from __future__ import annotations

import math
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affilix.llm.common import labelled_sample, with_labels

MAX_TRAINING = 16_000
MAX_ENTRIES = 2_000
MAX_EXCEPTIONS = 2_000
MIN_TEXTS = 4
STEM = (3, 9)
PARTS, HELD_OUT = 3, 1
LEAST = 0.7

# Signs that are written for letters.
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s"}
# Cyrillic and Greek letters that look like Latin ones.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m",
    "н": "h", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ѵ": "v", "ѡ": "w",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l",
}


class _Folding(dict):
    """For ``str.translate``: filled as code points are met."""

    def __missing__(self, code: int):
        c = chr(code)
        if code < 0x80 and c in DIGITS:
            out = DIGITS[c]
        elif unicodedata.category(c) in ("Cf", "Mn"):
            out = ""
        else:
            plain = unicodedata.normalize("NFKC", c).lower()
            out = "".join(HOMOGLYPHS.get(x, x) if x.isalpha() else DIGITS.get(x, " ") for x in plain)
        if len(self) < 100_000:
            self[code] = out
        return out


_FOLDING = _Folding()


def fold(text: str) -> str:
    """Letters only, in lower case, one blank between words and at both ends; look-alikes as the letters they stand for.

    Signs among digits fold too, so numbers become words, which no lexicon holds.
    """
    return " " + " ".join(text.translate(_FOLDING).split()) + " "


class Lexicon(NamedTuple):
    """``entries``: folded text to weight, beginning with a blank (start of a word) and perhaps ending with one.
    ``exceptions``: folded phrases with blanks around. ``calibration``: bias and factors of the evidence."""

    entries: dict[str, float]
    exceptions: list[str]
    calibration: tuple[float, float, float] = (-4.0, 1.0, 1.0)


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same places covered by spans in order that do not overlap."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


class Matcher:
    """The automaton of a lexicon."""

    def __init__(self, lexicon: Lexicon):
        self.calibration = lexicon.calibration
        self.automaton = ahocorasick.Automaton()
        for entry, weight in lexicon.entries.items():
            self.automaton.add_word(entry, (len(entry), weight))
        for phrase in lexicon.exceptions:
            self.automaton.add_word(phrase, (len(phrase), None))
        self.empty = not (lexicon.entries or lexicon.exceptions)
        if not self.empty:
            self.automaton.make_automaton()

    def evidence(self, text: str) -> tuple[float, float]:
        """Largest weight of a hit, and the sum of all weights over the logarithm of the number of words.

        A word counts once, by its largest weight; words inside exception phrases do not count.
        """
        folded = fold(text)
        if self.empty:
            return 0.0, 0.0
        excused: list[tuple[int, int]] = []
        hits: dict[int, float] = {}
        for end, (size, weight) in self.automaton.iter(folded):
            start = end - size + 1
            if weight is None:
                excused.append((start, end))
            else:
                hits[start] = max(hits.get(start, 0.0), weight)
        if excused and hits:
            # The only span that may hold a start is the first one that ends after it.
            excused = _joined(excused)
            ends = [b for _, b in excused]
            at = {s: bisect_right(ends, s) for s in hits}
            hits = {s: w for s, w in hits.items() if at[s] == len(ends) or s < excused[at[s]][0]}
        if not hits:
            return 0.0, 0.0
        words = folded.count(" ") - 1
        return max(hits.values()), sum(hits.values()) / math.log(math.e + words)

    def score(self, text: str) -> float:
        bias, top, total = self.calibration
        a, b = self.evidence(text)
        return 1 / (1 + math.exp(-max(-35.0, min(35.0, bias + top * a + total * b))))


def candidates(text: str) -> set[str]:
    """What may become an entry: the text's words, and the beginnings of them."""
    out = set()
    for word in set(fold(text).split()):
        out.add(f" {word} ")
        out.update(f" {word[:k]}" for k in range(STEM[0], min(STEM[1], len(word)) + 1))
    return out


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for at in range(0, len(batch), 512):
            toxic, clean = Counter(), Counter()
            for text, label in zip(batch["text"].iloc[at:at + 512], batch["label"].iloc[at:at + 512]):
                (toxic if label else clean).update(candidates(text))
            keys = list(toxic.keys() | clean.keys())
            yield pd.DataFrame({"entry": keys, "toxic": [toxic[k] for k in keys], "clean": [clean[k] for k in keys]})


def fit(examples: DataFrame, bound: int = MAX_ENTRIES) -> Lexicon:
    """Learn a lexicon from ``text, label`` rows, which must be a bounded sample.

    An entry stands in at least ``MIN_TEXTS`` toxic texts, mostly in such, and says more than the shorter entry it begins
    with. The best ``bound`` entries stay. An exception is a word under an entry that stands mostly in clean texts.
    """
    examples = examples.select("text", F.col("label").cast("int").alias("label"))
    sizes = {r["label"]: r["n"] for r in examples.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return Lexicon({}, [])
    counts = examples.mapInPandas(_count, "entry string, toxic long, clean long").groupBy("entry").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")
    )
    weight = F.log(((F.col("toxic") + 0.5) / (n_toxic + 1)) / ((F.col("clean") + 0.5) / (n_clean + 1)))
    scored = counts.withColumn("weight", weight)
    share = F.col("toxic") / (F.col("toxic") + F.col("clean"))
    best = (
        scored.filter((F.col("toxic") >= MIN_TEXTS) & (share >= 0.6) & (F.col("weight") > 1.5))
        .orderBy(F.desc(F.col("toxic") * F.col("weight")), "entry").limit(bound).collect()
    )
    kept: dict[str, tuple[float, int, int]] = {}
    for r in sorted(best, key=lambda r: (len(r["entry"].rstrip()), r["entry"])):
        entry = r["entry"]
        shorter = [kept[entry[:k]] for k in range(2, len(entry)) if entry[:k] in kept]
        if not any(s[0] >= r["weight"] - 0.7 for s in shorter):
            kept[entry] = (r["weight"], r["toxic"], r["clean"])
    stems = [e for e in kept if not e.endswith(" ")]
    exceptions: list[str] = []
    if stems:
        under = F.lit(False)
        for size in sorted({len(s) for s in stems}):
            under = under | F.substring("entry", 1, size).isin([s for s in stems if len(s) == size])
        exceptions = [r["entry"] for r in scored.filter(
            F.col("entry").endswith(" ") & under & (F.col("clean") >= MIN_TEXTS) & (F.col("clean") > 2 * F.col("toxic"))
        ).orderBy(F.desc("clean"), "entry").limit(MAX_EXCEPTIONS).collect()]
    lexicon = Lexicon({e: w for e, (w, _, _) in kept.items()}, sorted(exceptions))
    return _calibrated(examples, lexicon)


def _calibrated(examples: DataFrame, lexicon: Lexicon) -> Lexicon:
    """Fit the three numbers of the calibration by Newton's method on counts of (evidence, label), ridge 0.01.

    Texts labelled toxic in which the lexicon finds nothing are left out: they say nothing about what evidence is worth,
    and as outliers they would flatten the curve for all others.
    """
    shared = examples.sparkSession.sparkContext.broadcast(lexicon)

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(shared.value)
        for batch in batches:
            found = [matcher.evidence(t) for t in batch["text"]]
            yield pd.DataFrame({"a": [x for x, _ in found], "b": [y for _, y in found], "label": batch["label"].to_numpy()})

    # As many rows as the bounded sample at most.
    rows = examples.mapInPandas(gather, "a double, b double, label int").filter("a > 0 OR label = 0").groupBy(
        F.round("a", 3).alias("a"), F.round("b", 3).alias("b"), "label"
    ).agg(F.count("*").alias("n")).collect()
    rows.sort(key=lambda r: (r["a"], r["b"], r["label"]))
    x = np.array([[1.0, r["a"], r["b"]] for r in rows])
    y, n = np.array([r["label"] for r in rows], dtype=float), np.array([r["n"] for r in rows], dtype=float)
    w = np.zeros(3)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (n * (p - y)) + 0.01 * w
        hessian = (x * (n * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(3)
        w = w - np.linalg.solve(hessian, gradient)
    return lexicon._replace(calibration=tuple(float(v) for v in w))


def fit_toxicity(docs: DataFrame, labels: DataFrame, learn: Column, bound: int = MAX_TRAINING) -> Lexicon:
    """A lexicon of ``labels.toxic`` from at most ``bound`` labelled documents for which ``learn`` holds."""
    return fit(with_labels(docs, labelled_sample(labels, "toxic", bound, learn)))


def scorer(spark: SparkSession, lexicon: Lexicon) -> Column:
    """A column function: the score of a text, from 0 to 1; a null text counts as empty."""
    shared = spark.sparkContext.broadcast(lexicon)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(shared.value)
        for batch in batches:
            yield pd.Series([matcher.score("" if t is None else t) for t in batch], dtype="float64")

    return score


def score_documents(docs: DataFrame, lexicon: Lexicon, least: float = LEAST) -> DataFrame:
    """``doc_id, score, predicted`` of every row; repeated rows and null ids stay."""
    score = scorer(docs.sparkSession, lexicon)
    return docs.select("doc_id", score("text").alias("score")).withColumn("predicted", (F.col("score") >= least).cast("int"))


def remove_toxic(docs: DataFrame, lexicon: Lexicon, least: float = LEAST) -> DataFrame:
    """``docs`` without the rows that score ``least`` or more."""
    return docs.filter(scorer(docs.sparkSession, lexicon)("text") < least)
