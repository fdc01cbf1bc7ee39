"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. The vector of three letters is the product of their vectors, that of the
first shifted twice and of the second once (binding); the vector of a text is the sum over its letter triples (bundling).
The prototype of a language is the sum of its texts' vectors, each of length 1. A text gets the language of the prototype
with the largest cosine. Vectors are made from code points by a fixed generator, so all machines have the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affilix.llm.common import held_out

DIMENSIONS = 1024
GRAM = 3
MAX_LANGUAGES = 1_000
CHUNK_CHARS = 200_000
KNOWN_GRAMS = 8_000
PARTS, HELD_OUT = 4, 2
UNKNOWN = "und"

_CODE_BITS = 21


def _random_vector(code: int, dimensions: int) -> np.ndarray:
    bits = np.random.Generator(np.random.PCG64(code)).integers(0, 2, dimensions, dtype=np.int8)
    return bits * np.int8(2) - np.int8(1)


class Encoder:
    """Vectors of texts. Keeps vectors of letters and of recent letter triples, a bounded number of both."""

    def __init__(self, dimensions: int = DIMENSIONS):
        self.dimensions = dimensions
        self.letters: dict[int, np.ndarray] = {}
        self.grams: dict[int, np.ndarray] = {}

    def letter(self, code: int) -> np.ndarray:
        found = self.letters.get(code)
        if found is None:
            if len(self.letters) > 20_000:
                self.letters.clear()
            found = self.letters[code] = _random_vector(code, self.dimensions)
        return found

    def gram(self, key: int) -> np.ndarray:
        found = self.grams.get(key)
        if found is None:
            if len(self.grams) >= KNOWN_GRAMS:
                self.grams.clear()
            a, b, c = key >> 2 * _CODE_BITS, key >> _CODE_BITS & 0x1FFFFF, key & 0x1FFFFF
            found = np.roll(self.letter(a), 2) * np.roll(self.letter(b), 1) * self.letter(c)
            self.grams[key] = found
        return found

    def vectors(self, texts: list[str]) -> np.ndarray:
        """One row per text, of length 1; zeros for a text without letters. Texts are taken whole, slice by slice."""
        out = np.zeros((len(texts), self.dimensions), dtype=np.float32)
        start = 0
        while start < len(texts):
            end, size = start, 0
            while end < len(texts) and (end == start or size + len(texts[end]) <= CHUNK_CHARS):
                size += len(texts[end])
                end += 1
            for row, keys, counts in self._counts(texts[start:end]):
                used, column = np.unique(keys, return_inverse=True)
                for at in range(0, len(used), 2048):
                    mine = (column >= at) & (column < at + 2048)
                    table = np.stack([self.gram(k) for k in used[at:at + 2048].tolist()]).astype(np.float32)
                    dense = np.zeros((end - start, len(table)), dtype=np.float32)
                    dense[row[mine], column[mine] - at] = counts[mine]
                    out[start:end] += dense @ table
            start = end
        length = np.sqrt(np.einsum("ij,ij->i", out, out))
        return out / np.where(length > 0, length, 1)[:, None]

    def _counts(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(number of the text, triple, count), counted in slices of a long text."""
        part: list[str] = []
        for t in texts:
            part.append("  " + t.lower() + "  ")
        whole = "".join(part)
        ends = np.cumsum([len(p) for p in part])
        for at in range(0, len(whole), 4 * CHUNK_CHARS):
            codes = np.frombuffer(whole[at:at + 4 * CHUNK_CHARS + GRAM - 1].encode("utf-32-le"), dtype=np.uint32)
            kinds, place = np.unique(codes, return_inverse=True)
            letters = np.array([k if chr(k).isalpha() else 32 for k in kinds.tolist()], dtype=np.int64)[place]
            if len(letters) < GRAM:
                continue
            keys = (letters[:-2] << 2 * _CODE_BITS) | (letters[1:-1] << _CODE_BITS) | letters[2:]
            row = np.searchsorted(ends, np.arange(at, at + len(keys)), side="right")
            # Triples that hold two signs that are no letters say nothing; those across two texts are such.
            good = ((letters[:-2] != 32).astype(np.int8) + (letters[1:-1] != 32) + (letters[2:] != 32)) >= 2
            keys, row = keys[good], row[good]
            used, column = np.unique(keys, return_inverse=True)
            pairs, counts = np.unique(row * len(used) + column, return_counts=True)
            if len(pairs):
                yield pairs // len(used), used[pairs % len(used)], counts.astype(np.float32)


class Profiles(NamedTuple):
    """Languages in order, and one prototype of length 1 for each."""

    languages: list[str]
    prototypes: np.ndarray


def fit(docs: DataFrame, dimensions: int = DIMENSIONS) -> Profiles:
    """Prototypes from all rows of ``docs`` (``text, lang``) with both given. Each task sends one sum per language."""
    rows = docs.filter("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    # One number per language and dimension comes back, so the languages are counted first.
    n = rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).count()
    if n > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")

    def bundle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, sums = Encoder(dimensions), {}
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at:at + 256]
                vectors = encoder.vectors(part["text"].to_list())
                for lang, where in part.groupby("lang").indices.items():
                    sums[lang] = sums.get(lang, 0.0) + vectors[where].sum(axis=0, dtype=np.float64)
        # In whole numbers, so that the order in which tasks are added up changes nothing.
        whole = [np.rint(v * 2**24).astype(np.int64).tolist() for v in sums.values()]
        yield pd.DataFrame({"lang": pd.Series(list(sums), dtype=object), "sums": pd.Series(whole, dtype=object)})

    parts = rows.mapInPandas(bundle, "lang string, sums array<bigint>")
    each = parts.select("lang", F.posexplode("sums").alias("at", "x")).groupBy("lang", "at").agg(F.sum("x").alias("x"))
    found: dict[str, np.ndarray] = {}
    for r in each.collect():
        found.setdefault(r["lang"], np.zeros(dimensions))[r["at"]] = r["x"]
    languages = sorted(found)
    prototypes = np.array([found[x] / (np.linalg.norm(found[x]) or 1.0) for x in languages]).reshape(-1, dimensions)
    return Profiles(languages, prototypes.astype(np.float32))


def identify(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row. Texts that are null or hold no letter are ``und`` with score 0.

    The score is the cosine with the prototype, not below 0; of equal cosines the first language in order wins. Without
    profiles every text is ``und``. Repeated rows and null ids stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(profiles)

    @F.pandas_udf("lang_pred string, score double")
    def classify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        languages, prototypes = shared.value
        encoder = Encoder(prototypes.shape[1])
        for batch in batches:
            texts = ["" if t is None else t for t in batch]
            names, scores = [], []
            for at in range(0, len(texts), 256):
                vectors = encoder.vectors(texts[at:at + 256])
                cosines = np.round((vectors @ prototypes.T).astype(np.float64), 6)
                known = np.abs(vectors).sum(axis=1) > 0
                for v, ok in zip(cosines, known):
                    ok = bool(ok) and len(languages) > 0
                    names.append(languages[int(np.argmax(v))] if ok else UNKNOWN)
                    scores.append(min(1.0, max(0.0, float(v.max()))) if ok else 0.0)
            # A text of single letters has no triple of two letters: any language may be meant, the first is taken.
            for n, (t, name) in enumerate(zip(texts, names)):
                if name == UNKNOWN and languages and any(c.isalpha() for c in t):
                    names[n] = languages[0]
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    return docs.select("doc_id", classify("text").alias("found")).select("doc_id", "found.lang_pred", "found.score")


def learn_and_identify(docs: DataFrame) -> DataFrame:
    """:func:`identify` with profiles of the documents that are not held out, and ``held_out``."""
    kept_back = held_out(F.col("doc_id"), PARTS, HELD_OUT)
    profiles = fit(docs.filter(~kept_back))
    ids = identify(docs, profiles)
    return ids.select("doc_id", held_out(F.col("doc_id"), PARTS, HELD_OUT).alias("held_out"), "lang_pred", "score")
