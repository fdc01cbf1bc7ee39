"""Token alignment against a plain version: overlaps by comparing every pair of tokens, counts by dictionaries."""

from __future__ import annotations

import hashlib
import sys
from collections import Counter, defaultdict
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import pandas as pd

from affilix.llm import token_alignment  # noqa: E402


def plain(rows, folder=token_alignment.TOKENIZERS):
    """The contract's A is the tokenizers file; the operator reads the same vocabulary as tiktoken ranks."""
    from tokenizers import Tokenizer

    _, a_bytes, _, b, b_bytes, _ = token_alignment._tokenizers(folder)
    a = Tokenizer.from_file(f"{folder}/byte_bpe_50k.json")
    a.encode_special_tokens = True
    per_row, held = [], defaultdict(set)
    for doc_id, text in rows:
        s = text or ""
        whole = (" " + s).encode()
        a_ids = a.encode(" " + s, add_special_tokens=False).ids
        b_ids = b.encode(s)
        if not s or b"".join(a_bytes[i] for i in a_ids) != whole or b"".join(b_bytes[i] for i in b_ids) != whole:
            a_ids, b_ids = [], []
        spans = []
        for ids, table in ((a_ids, a_bytes), (b_ids, b_bytes)):
            at, out = 0, []
            for i in ids:
                out.append((at, at + len(table[i]), i))
                at += len(table[i])
            spans.append(out)
        links = [(x[2], y[2]) for x in spans[0] for y in spans[1] if x[0] < y[1] and y[0] < x[1]]
        a_ends = {e for _, e, _ in spans[0]}
        cuts = sorted(a_ends & {e for _, e, _ in spans[1]})
        groups = []
        for k, cut in enumerate(cuts):
            low = cuts[k - 1] if k else 0
            groups.append(",".join(str(i) for s0, e, i in spans[0] if low < e <= cut) + "|"
                          + ",".join(str(i) for s0, e, i in spans[1] if low < e <= cut))
        text_of = ";".join(groups)
        per_row.append((doc_id, len(a_ids), len(b_ids), len(cuts), links,
                        hashlib.sha256(text_of.encode()).hexdigest() if text_of else ""))
        if doc_id is not None:
            for pair in links:
                held[pair].add(doc_id)
    count = {pair: len(d) for pair, d in held.items()}
    top = Counter()
    for (x, _), c in count.items():
        top[x] = max(top[x], c)
    return list(
        (d, na, nb, ng, len(links), sum(count.get(p, 0) == top[p[0]] and p in count for p in links),
         sum(count.get(p, 0) for p in links), h)
        for d, na, nb, ng, links, h in per_row
    )


ROWS = [
    (1, "Hello world, this is a test."), (2, "Hello  world<|endoftext|> é 😀 naïve café"), (3, None), (4, ""),
    (5, "ｆｕｌｌ width"), (6, "tabs\tand\nnew lines  and   spaces"), (7, "Hello world, this is a test."),
    (None, "Hello world again"), (8, "x" * 3000 + " " + "ab" * 500), (9, "日本語のテキストです。"),
]


def test_matches_plain_version(spark):
    rows = ROWS + [(1, ROWS[0][1]), (None, "Hello world again")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [tuple(r) for r in token_alignment.align(df).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()]
    key = str
    assert sorted(got, key=key) == sorted(plain(rows), key=key)
    by_id = {r[0]: r for r in got if r[0] is not None}
    assert by_id[3][1:] == (0, 0, 0, 0, 0, 0, "") and by_id[4][1:] == (0, 0, 0, 0, 0, 0, "")
    assert by_id[1][4] > 0 and by_id[1][6] > by_id[1][4]


def test_without_broadcast(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    got = [tuple(r) for r in token_alignment.align(df, broadcast_rows=0).collect()]
    assert sorted(got, key=str) == sorted(plain(ROWS), key=str)


def test_empty_table_and_extra_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, n_a string")
    assert token_alignment.align(empty).count() == 0
    df = spark.createDataFrame([(1, "a b", "x")], "doc_id long, text string, n_a string")
    assert token_alignment.align(df).collect()[0].n_a == 2


def test_a_batch_is_encoded_in_short_chunks():
    """No more than a quarter of a megabyte of text (or one text) has its tokens in memory at a time."""
    texts = ["some words and more " * 1000] * 40
    batch = pd.DataFrame({"doc_id": range(40), "text": texts, "text_hash": [7] * 40})
    parts = list(token_alignment._encode(token_alignment.TOKENIZERS)(iter([batch])))
    assert max(len(p) for p in parts) * len(texts[0]) <= 1 << 18
    whole = pd.concat(parts)
    assert whole["doc_id"].tolist() == list(range(40)) and whole["groups_sha256"].nunique() == 1


def test_sums_are_taken_per_row_without_a_shuffle_of_links(spark):
    """Rows of links went over the network with their document twice: for distinct counts and for the sums."""
    docs = spark.createDataFrame([(1, "one two"), (1, "one two"), (1, "three"), (2, "one")], "doc_id long, text string")
    plan = token_alignment.align(docs)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(row" in plan and "hashpartitioning(doc_id" not in plan


def test_token_bytes_are_compared_with_the_text():
    import numpy as np

    words = [b"a", b"bc", b"longer than eight", b"zz"]
    texts = [b"abc", b"longer than eighta", b"longer than eightb", b"longer thAn eighta", b"", b"abcd", b"zz", b"a"]
    ids = [[0, 1], [2, 0], [2, 0], [2, 0], [], [0, 1], [3], [1, 0]]
    _, n, fine = token_alignment._checked(
        ids, np.array([len(w) for w in words]), token_alignment._words(words), b"".join([*texts, bytes(8)]),
        np.array([len(t) for t in texts]),
    )
    assert n.tolist() == [2, 2, 2, 2, 0, 2, 1, 2]
    assert fine.tolist() == [True, True, False, False, True, False, True, False]
