"""Benchmark decontamination: windows of benchmark words looked up in every window of the training texts.

The windows travel as broadcast hash sets of at most ``MAX_WINDOWS`` windows. A larger benchmark is looked up block by
block, each against all texts. A hash that matches is compared word by word before it counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affilix.llm.common import Tokens, chunks, lower_ascii, mix
from affilix.session import materialize

WINDOW = 13
MAX_WINDOWS = 400_000
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_TABLE = np.zeros(256, dtype=np.uint64)
for _b in range(256):
    _c = _b + 32 if 65 <= _b <= 90 else _b
    if 48 <= _c <= 57 or 97 <= _c <= 122 or _c >= 128:
        _TABLE[_b] = _c
_LOWER = bytes(_b + 32 if 65 <= _b <= 90 else _b for _b in range(256))

HITS = "n_words long, hits array<int>, spans array<struct<start: int, end: int>>, items array<string>"


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``words, items``: every distinct window of the items, and the ids of the items it stands in.

    An item of fewer than ``window`` words is one window; an item without words has none. A null id is listed nowhere,
    but its windows are looked for.
    """
    words = F.regexp_extract_all(lower_ascii(F.coalesce("text", F.lit(""))), F.lit(WORD), F.lit(0))
    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), words.alias("all")).filter(F.size("all") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - (window - 1), F.lit(1)))
    each = rows.select("item", F.explode(F.transform(
        starts, lambda i: F.array_join(F.slice("all", i, window), " ")
    )).alias("words"))
    return each.groupBy("words").agg(F.collect_set("item").alias("items"))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every window of ``size`` consecutive word hashes."""
    n = len(hashes) - size + 1
    total = np.zeros(max(n, 0), dtype=np.uint64)
    for k in range(size if n > 0 else 0):
        total *= np.uint64(0xD6E8FEB86659FD93)
        total += hashes[k:k + n]
    return mix(total)


class WindowSet:
    """A block of windows, as hashes to look up and words to compare."""

    BITS = 20

    def __init__(self, windows: list[tuple[str, list[str]]]):
        self.words: dict[int, list[tuple[bytes, list[str]]]] = {}
        by_size: dict[int, list[int]] = {}
        for text, items in windows:
            tokens = Tokens([text.encode()], _TABLE)
            size = len(tokens.starts)
            key = int(window_hashes(tokens.hashes, size)[0])
            self.words.setdefault(key, []).append((text.encode(), sorted(items)))
            by_size.setdefault(size, []).append(key)
        self.maps = {}
        for size, keys in by_size.items():
            there = np.zeros(1 << self.BITS, dtype=bool)
            there[np.array(keys, dtype=np.uint64) >> np.uint64(64 - self.BITS)] = True
            self.maps[size] = (there, np.unique(np.array(keys, dtype=np.uint64)))

    def candidates(self, tokens: Tokens) -> Iterator[tuple[int, int, int]]:
        """(first word, number of words, hash) wherever a hash is in the set and the window stays in one text."""
        for size, (there, keys) in self.maps.items():
            found = window_hashes(tokens.hashes, size)
            at = np.flatnonzero(there[found >> np.uint64(64 - self.BITS)])
            if len(at):
                at = at[np.isin(found[at], keys) & (tokens.text[at] == tokens.text[at + size - 1])]
                yield from zip(at.tolist(), [size] * len(at), found[at].tolist())


def _scan(windows: WindowSet, texts: list[bytes]) -> list[tuple]:
    tokens = Tokens(texts, _TABLE)
    hits: dict[int, set[int]] = {}
    items: dict[int, set[str]] = {}
    for first, size, key in windows.candidates(tokens):
        got = b" ".join(
            tokens.data[s:e] for s, e in zip(tokens.starts[first:first + size], tokens.ends[first:first + size])
        ).translate(_LOWER)
        for words, ids in windows.words[key]:
            if words == got:
                n = int(tokens.text[first])
                hits.setdefault(n, set()).update(range(first, first + size))
                items.setdefault(n, set()).update(ids)
    out = []
    for n, count in enumerate(tokens.counts.tolist()):
        if n not in hits:
            out.append((count, [], [], []))
            continue
        where = np.array(sorted(hits[n]), dtype=np.int64)
        cuts = np.flatnonzero(np.diff(where) > 1)
        starts, ends = where[np.append(0, cuts + 1)], where[np.append(cuts, len(where) - 1)]
        edges = np.stack([tokens.starts[starts], tokens.ends[ends]], axis=1) - tokens.offsets[n]
        # A code point begins at every byte but those of the form 10xxxxxx.
        begins = np.append(0, np.cumsum((np.frombuffer(texts[n], dtype=np.uint8) & 0xC0) != 0x80))
        spans = [{"start": int(begins[s]), "end": int(begins[e])} for s, e in edges]
        out.append((count, (where - tokens.first[n]).tolist(), spans, sorted(items[n])))
    return out


def lookup(windows: WindowSet, spark) -> Column:
    """A column function over texts: ``n_words``, numbers and spans of the words hit, ids of the items found."""
    shared = spark.sparkContext.broadcast(windows)

    @F.pandas_udf(HITS)
    def look(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = ["n_words", "hits", "spans", "items"]
        for batch in batches:
            rows: list[tuple] = []
            for _, part in chunks(("" if t is None else t).encode() for t in batch):
                rows += _scan(shared.value, part)
            yield pd.DataFrame(rows, columns=names)

    return look


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """``docs`` (all columns) with ``found``: ``n_words, hits, spans, items``, see :data:`HITS`.

    Null and empty texts have no words. A column ``found`` of ``docs`` is replaced. Items and hits of the blocks of a
    large benchmark are joined per row.
    """
    spark = docs.sparkSession
    windows = materialize(benchmark_windows(benchmark, window), "benchmark_windows")
    blocks = max(1, -(-windows.count() // max_windows))
    out, found = docs.drop("found"), None
    for block in range(blocks):
        mine = windows.filter(F.pmod(F.xxhash64("words"), F.lit(blocks)) == block).collect()
        here = lookup(WindowSet([(r["words"], r["items"]) for r in mine]), spark)(F.col("text"))
        if found is None:
            out = out.withColumn("found", here)
        else:
            out = out.withColumn("_more", here).withColumn("found", _joined(F.col("found"), F.col("_more"))).drop("_more")
        found = True
        if blocks > 1:
            out = materialize(out, "decontaminated_block")
    return out


def _joined(one: Column, two: Column) -> Column:
    return F.struct(
        one["n_words"].alias("n_words"), F.array_union(one["hits"], two["hits"]).alias("hits"),
        F.array_union(one["spans"], two["spans"]).alias("spans"), F.array_union(one["items"], two["items"]).alias("items"),
    )


def is_contaminated(found: Column) -> Column:
    """At least one word is hit, and at least a twentieth of them."""
    return (F.size(found["hits"]) > 0) & (F.size(found["hits"]) * 20 >= found["n_words"])


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = find(docs.select("doc_id", "text"), benchmark)
    return found.select(
        "doc_id",
        F.col("found.n_words").alias("n_words"),
        F.size("found.hits").cast("long").alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("found.items"), ",").cast("binary"), 256).alias("items_sha256"),
        is_contaminated(F.col("found")).alias("contaminated"),
        F.col("found.spans").alias("spans"),
    )


def remove_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without contaminated rows; the rest as they are, texts with a few hits too."""
    found = find(docs, benchmark)
    return found.filter(~is_contaminated(F.col("found"))).select(*docs.columns)


def remove_spans(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with hit words cut out of their texts, everything else kept."""
    from affilix.llm.secret_scan import redact

    spans = F.sort_array("found.spans")
    cut = redact(F.col("text"), spans, "")
    return find(docs, benchmark).withColumn("text", cut).select(*docs.columns)
