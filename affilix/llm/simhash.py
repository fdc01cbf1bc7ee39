"""SimHash near-duplicates found with pivot distance tables.

Copies share a fingerprint and are one node. For distinct fingerprints a table of Hamming distances to reference
fingerprints is computed. Two fingerprints at distance ``d`` differ by at most ``d`` in every coordinate of that table, so a
pair with a larger difference is discarded unseen; survivors are compared bit by bit.

A table alone says which pairs to drop, not where to look. So the 64 bits are also cut into blocks, with references that
differ within one block only: if at most three bits differ, at least ``BLOCKS - 3`` blocks do not, and in these the block
distances of both fingerprints are the same. Fingerprints meet under every such choice of blocks. A meeting place with many
fingerprints is dealt into tiles, each pair of tiles being one row of work. Links inside a tile are reduced to a forest
before they leave it, so nothing that is written grows with the square of a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations, islice

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affilix.llm.common import chunks
from affilix.session import materialize

SHINGLE = 3
MAX_DISTANCE = 3
BLOCKS = 6
TILE = 512
SEED = 42
PIVOTS = 24

_SLICE = 1 << 15


def _references(count: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints: hashes of the numbers from 0, each followed by its reverse in the upper half of the bits."""
    half = np.uint64(0xFFFFFFFF00000000)
    base = [np.uint64(xxhash.xxh64_intdigest(str(n).encode(), seed=SEED)) for n in range(count // 2)]
    return np.array([p ^ m for p in base for m in (np.uint64(0), half)], dtype=np.uint64)


def fingerprint_of(text: bytes) -> int:
    """Fingerprint of a text: bits set in more than half of the hashes of its word 3-grams; zero without words."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles: Iterator[bytes] = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(*[words[k:] for k in range(SHINGLE)]))
    total = max(1, len(words) - SHINGLE + 1)
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, total, _SLICE):
        part = np.fromiter(
            (digest(s, SEED) for s in islice(shingles, min(_SLICE, total - start))), dtype=np.uint64
        )
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += np.count_nonzero(bits, axis=0) if len(bits) < 256 else np.add.reduce(bits, axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


@F.pandas_udf(T.LongType())
def fingerprint(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Fingerprint of every text, as a signed number; null counts as a text without words."""
    for batch in batches:
        out = [fingerprint_of(t.encode()) for t in batch.fillna("")]
        yield pd.Series(np.array(out, dtype=np.uint64).view(np.int64))


def hex_of(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def block_masks(blocks: int = BLOCKS) -> list[int]:
    edges = [64 * k // blocks for k in range(blocks + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]


def meeting_places(blocks: int = BLOCKS, most: int = MAX_DISTANCE) -> list[int]:
    """Masks of every choice of ``blocks - most`` blocks."""
    return [reduce(int.__or__, c) for c in combinations(block_masks(blocks), blocks - most)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _pairs(key: np.ndarray, fp: np.ndarray, most: int, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of rows with the same ``key``, by the pivot table.

    Rows are sorted by key and first coordinate, so a row is paired only with those after it whose first coordinate is in
    reach; step ``k`` looks at all pairs of rows ``k`` apart that still are.
    """
    order = np.lexsort((np.bitwise_count(fp ^ pivots[0]), key))
    key, fp = key[order], fp[order]
    first = np.bitwise_count(fp ^ pivots[0]).astype(np.int16)
    table = [np.bitwise_count(fp ^ p).astype(np.int16) for p in pivots[1:]]
    left, right = [], []
    live, step = np.arange(len(fp)), 0
    while len(live):
        step += 1
        live = live[live + step < len(fp)]
        live = live[(key[live] == key[live + step]) & (first[live + step] - first[live] <= most)]
        kept = live
        for coordinate in table:
            kept = kept[np.abs(coordinate[kept] - coordinate[kept + step]) <= most]
            if not len(kept):
                break
        kept = kept[np.bitwise_count(fp[kept] ^ fp[kept + step]) <= most]
        left.append(fp[kept])
        right.append(fp[kept + step])
    return np.concatenate([*left, fp[:0]]), np.concatenate([*right, fp[:0]])


def forest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same components with one link per node: every node and the smallest node of its component."""
    nodes, ends = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = ends[:len(left)], ends[len(left):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if np.array_equal(before, root):
            break
    while not np.array_equal(root, root[root]):
        root = root[root]
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def links(fingerprints: DataFrame, most: int = MAX_DISTANCE, blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """``node, root``: links that connect just those distinct fingerprints (``fp``) that chains of near pairs connect.

    Complete: two fingerprints at distance ``most`` or less share at least one meeting place, where they share a tile.
    """
    places = F.array(*[
        F.struct(F.lit(n).alias("place"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bits"))
        for n, m in enumerate(meeting_places(blocks, most))
    ])
    met = fingerprints.select("fp", F.inline(places))
    crowded = met.groupBy("place", "bits").agg(F.count("*").alias("n")).filter("n > 1")
    strips = F.ceil(F.col("n") / tile).cast("int")
    mine = F.pmod(F.xxhash64("fp"), strips).cast("int")
    dealt = met.join(crowded, ["place", "bits"]).select(
        "fp", "place", "bits", mine.alias("mine"), F.explode(F.sequence(F.lit(0), strips - 1)).alias("other")
    )
    tiles = dealt.groupBy(
        "place", "bits", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b")
    ).agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1).select("fps")
    pivots = _references()

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, group in batch.groupby(np.cumsum([len(x) for x in batch["fps"]]) // 100_000):
                sizes = [len(x) for x in group["fps"]]
                fps = np.concatenate(group["fps"].to_list()).astype(np.int64).view(np.uint64)
                node, root = forest(*_pairs(np.repeat(np.arange(len(sizes)), sizes), fps, most, pivots))
                yield pd.DataFrame({"node": node.view(np.int64), "root": root.view(np.int64)})

    return tiles.mapInPandas(compare, "node long, root long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges`` (``node, root``); nodes of one component have one label.

    Contraction: every node joins its least neighbour in the order of a hash, chains are cut short, and only links between
    different groups go on. Each round leaves fewer nodes by a constant factor. Rounds are written to the shared folder.
    """
    rank = F.xxhash64
    both = edges.select(F.col("node").alias("u"), F.col("root").alias("v"))
    both = materialize(both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v"))), "links")
    steps: list[DataFrame] = []
    while not both.isEmpty():
        least = both.groupBy("u").agg(F.min(F.struct(rank("v").alias("rank"), F.col("v").alias("v"))).alias("least"))
        own = F.struct(rank("u").alias("rank"), F.col("u").alias("v"))
        joined = materialize(least.select("u", F.least(own, F.col("least"))["v"].alias("label")), "joined")
        steps.append(joined)
        to = joined.select(F.col("u").alias("v"), F.col("label").alias("to"))
        both = materialize(
            both.join(joined, "u").join(to, "v").filter("label <> to")
            .select(F.col("label").alias("u"), F.col("to").alias("v")).distinct(),
            "links",
        )
    if not steps:
        return edges.select("node", F.col("root").alias("label"))
    # From the last round back: where a node's group ended up.
    final = steps[-1]
    for joined in reversed(steps[:-1]):
        after = final.select(F.col("u").alias("label"), F.col("label").alias("later"))
        final = joined.join(after, "label", "left").select("u", F.coalesce("later", "label").alias("label"))
    return final.select(F.col("u").alias("node"), "label")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row: the smallest ``doc_id`` that links lead to, its own included.

    Texts that are null, empty or blank have fingerprint zero and are linked like any other. Repeated rows stay, null ids
    are never the smallest unless a component has no other.
    """
    printed = materialize(docs.select("doc_id", fingerprint("text").alias("fp")), "fingerprints")
    distinct = printed.groupBy("fp").agg(F.min("doc_id").alias("least"))
    groups = materialize(components(links(distinct.select("fp"))), "groups")
    label = F.coalesce("label", "fp")
    placed = distinct.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select("fp", label.alias("label"), "least")
    least = placed.groupBy("label").agg(F.min("least").alias("component_id"))
    ids = placed.join(least, "label").select("fp", "component_id")
    return printed.join(ids, "fp").select("doc_id", hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest ``doc_id``; of rows repeating that id, one.

    Rows without an id stand for nothing else and stay.
    """
    kept = near_duplicates(docs).filter("doc_id = component_id").select("doc_id").distinct()
    chosen = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return chosen.unionByName(docs.filter("doc_id IS NULL"))
