"""Line dedup against a plain version of its contract, with keys that cross partitions and awkward rows."""

from __future__ import annotations

import hashlib
import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from affilix.llm import line_dedup  # noqa: E402

WHITE = " \t\n\x0b\x0c\r"


def plain(rows, min_chars=20, min_docs=3):
    """doc_id -> (n_lines, n_dropped, kept text), straight from the contract."""
    holders: dict[str, set] = {}
    split = []
    for doc_id, text in rows:
        lines = ("" if text is None else text).split("\n")
        keys = [line.strip(WHITE).translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
                for line in lines]
        split.append((doc_id, lines, keys))
        for k in keys:
            if len(k) >= min_chars and doc_id is not None:
                holders.setdefault(k, set()).add(doc_id)
    out = []
    for doc_id, lines, keys in split:
        kept = [
            line for line, k in zip(lines, keys)
            if not (len(k) >= min_chars and len(holders.get(k, ())) >= min_docs and doc_id != max(holders[k]))
        ]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[3]))


def rows_of(seed: int, n_docs: int):
    rng = random.Random(seed)
    common = [f"Shared line number {k} with enough characters" for k in range(6)]
    hot = "A VERY COMMON LINE THAT MANY DOCUMENTS HOLD"
    rows = []
    for d in range(n_docs):
        lines = [hot] if d % 3 else []
        for _ in range(rng.randrange(0, 6)):
            pick = rng.random()
            if pick < 0.4:
                lines.append(rng.choice(common))
            elif pick < 0.5:
                lines.append("  \t" + rng.choice(common).upper() + " \r")
            elif pick < 0.6:
                lines.append("short")
            else:
                lines.append(f"unique text {d} {rng.random()} padded out to length")
        rows.append((d * 7 % 101, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("parts", [1, 4, 13])
def test_matches_the_contract(spark, parts):
    rows = rows_of(parts, 90) + [
        (None, None), (500, ""), (501, "\n\n"), (502, "Shared line number 1 with enough characters\n" * 3),
        (None, "Shared line number 2 with enough characters"), (503, "x" * 19 + "\n" + "y" * 20),
        (504, "yyyyyyyyyyyyyyyyyyyy"), (505, "YYYYYYYYYYYYYYYYYYYY  "), (506, " yyyyyyyyyyyyyyyyyyyy"),
    ]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        got = line_dedup.drop_repeated_lines(docs).select("doc_id", "n_lines", "n_dropped", "text").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    got = sorted((tuple(r) for r in got), key=lambda r: (r[0] is None, r[0] or 0, r[3]))
    assert got == plain(rows)
    assert sum(r[2] for r in got) > 50


def test_one_key_in_most_documents_splits_over_partitions(spark):
    """A key in every document: all but the largest lose it, whatever the partition a document lands in."""
    rows = [(d, f"line of document {d}\nthe same line everywhere, long enough") for d in range(3000)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "17")
    try:
        got = line_dedup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"))
        counts = {r["doc_id"]: r["n_dropped"] for r in got.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert counts[2999] == 0 and all(counts[d] == 1 for d in range(2999))


def test_repeated_rows_and_clashing_columns(spark):
    line = "this line is in four rows of three documents"
    rows = [(1, line, "a"), (1, line, "a"), (2, line + "\nrest", "b"), (3, line, None), (3, "other\n" + line, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_lines string").withColumn("_doc", F.lit(1))
    got = line_dedup.drop_repeated_lines(docs).orderBy("doc_id", "text").collect()
    assert [(r.doc_id, r.text, r.n_dropped, r._doc) for r in got] == [
        (1, "", 1, 1), (1, "", 1, 1), (2, "rest", 1, 1), (3, "other\n" + line, 0, 1), (3, line, 0, 1),
    ]
    assert got[0].n_lines == 1 and isinstance(got[0].n_lines, int)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert line_dedup.drop_repeated_lines(empty).count() == 0
    assert line_dedup.keep_bitmaps(empty).count() == 0


def test_bitmaps_are_runs(spark):
    shared = [f"shared line {k} that is long enough" for k in range(4)]
    rows = [(d, "\n".join(shared[:2] + ["own"] + shared[2:])) for d in range(3)]
    got = {r.doc_id: [tuple(x) for x in r.dropped] for r in line_dedup.keep_bitmaps(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: [(0, 2), (3, 2)], 1: [(0, 2), (3, 2)]}


def test_long_text_digest(spark):
    text = "\n".join(f"row {k % 50} of a long text, long enough" for k in range(20_000))
    rows = [(1, text), (2, text), (3, text)]
    got = line_dedup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    digest = {r.doc_id: r.h for r in got.select("doc_id", F.sha2("text", 256).alias("h")).collect()}
    want = {d: hashlib.sha256(t.encode()).hexdigest() for d, _, _, t in plain(rows)}
    assert digest == want
