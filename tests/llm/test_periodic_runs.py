"""Periodic runs against the definition checked period by period, and the grammar's LCE against plain comparison."""

from __future__ import annotations

import hashlib
import random
import re
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from affilix.llm import periodic_runs  # noqa: E402


def plain_runs(words: list[str]) -> list[tuple[int, int, int]]:
    """Maximal stretches with words q apart equal, of length >= max(24, 3q), each at its smallest period."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        x = 0
        while x < n - q:
            if words[x] != words[x + q]:
                x += 1
                continue
            y = x
            while y < n - q and words[y] == words[y + q]:
                y += 1
            start, length = x, y - x + q
            if length >= max(24, 3 * q) and (start, length) not in found:
                found[(start, length)] = q
            x = y
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(words)
    gone = set()
    for s, length, q in runs:
        gone.update(range(s + q, s + length))
    best = (None,) * 4
    if runs:
        s, length, q = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]))
        best = (s, length, q, 1000 * length // q)
    listing = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *best, hashlib.sha256(listing.encode()).hexdigest(),
            hashlib.sha256(kept.encode()).hexdigest())


def texts(seed: int) -> list[str]:
    rng = random.Random(seed)
    out = []
    for _ in range(40):
        words = [rng.choice("a b c d e f".split()) for _ in range(rng.randrange(0, 300))]
        for _ in range(rng.randrange(0, 4)):
            if not words:
                break
            unit = [rng.choice("x y z a".split()) for _ in range(rng.randrange(1, 12))]
            at = rng.randrange(len(words))
            words[at:at] = unit * rng.randrange(2, 40) + unit[: rng.randrange(len(unit))]
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_lce_matches_direct_comparison(seed):
    rng = np.random.default_rng(seed)
    seq = rng.integers(0, 3, 3000)
    seq[500:1400] = np.tile(seq[500:509], 100)
    grammar = periodic_runs.Grammar(seq)
    x = rng.integers(0, len(seq), 4000)
    y = rng.integers(0, len(seq), 4000)
    x[:1000] = rng.integers(500, 1300, 1000)
    y[:1000] = x[:1000] + 9 * rng.integers(0, 5, 1000)
    want = []
    for a, b in zip(x, y):
        k = 0
        while a + k < len(seq) and b + k < len(seq) and seq[a + k] == seq[b + k]:
            k += 1
        want.append(k)
    assert grammar.lce(x, y).tolist() == want


@pytest.mark.parametrize("seed", [4, 5])
def test_runs_match_the_definition(seed):
    docs = texts(seed)
    ids = [np.array([ord(c) for c in t.split() and t.replace(" ", "")], dtype=np.int64) if t else np.zeros(0, np.int64)
           for t in docs]
    got = periodic_runs.find_runs(ids)
    for t, runs in zip(docs, got):
        assert [tuple(r) for r in runs.tolist()] == plain_runs(t.split())


def test_query_rows_match_brute_force(spark):
    rows = [(d, t) for d, t in enumerate(texts(6))]
    rows += [(None, None), (1000, ""), (1001, " \t "), (10, "w " * 200), (10, "w " * 200), (None, "u v " * 30)]
    # Ids whose crc32 ends in 0 get the planted period.
    planted = [d for d in range(2000, 4000) if zlib.crc32(str(d).encode()) % 10 == 0][:5]
    rows += [(d, " ".join(f"w{(d * k) % 97}" for k in range(400))) for d in planted]
    rows += [(5000, "a b " * 20_000)]
    got = periodic_runs.detect(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[6], r[7])
    assert sorted((tuple(r) for r in got if r[0] != 5000), key=key) == sorted(
        (plain_row(d, t) for d, t in rows[:-1]), key=key
    )
    assert sum(r.n_runs for r in got) > 20
    long_one = [r for r in got if r.doc_id == 5000][0]
    assert (long_one.n_runs, long_one.start, long_one.length, long_one.period) == (1, 0, 40_000, 2)


def test_empty_table(spark):
    assert periodic_runs.detect(spark.createDataFrame([], "doc_id long, text string")).count() == 0
