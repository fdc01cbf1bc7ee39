"""Periodic runs of words, found on a harmonic grid and extended exactly by LCE queries on a recompression grammar.

A run of period ``q`` and length at least ``3q`` holds two words ``q`` apart at a multiple of ``q`` (the grid), so the
candidates are the grid places ``g`` with ``w[g] == w[g + q]``: about ``n ln n`` places for ``n`` words. Each candidate
needs how far the match goes on (the longest common extension, LCE, of ``g`` and ``g + q``) and back (the same on the
reversed words). A few steps are compared directly; longer ones ask a grammar.

The grammar is built by recompression: block compression turns every maximal stretch of one symbol into one symbol
``(symbol, count)``, pair compression merges neighbours ``ab`` where ``a`` falls on the left and ``b`` on the right side of
a split of the symbols by a hash; the two alternate until one symbol is left. Symbols are numbered by their content, so
equal ones spell equal words. An LCE query walks both places forward, each time by the highest symbol that starts at
both places (for blocks: the most whole copies of their symbol both have left) and is the same; when no level agrees
the first words differ. This needs no suffix array; the texts of a batch share one grammar, each ended by a symbol of
its own so that no match runs from one into the next.

Defined results: words are ``[^\\x20\\x09-\\x0D]+``; a null or empty text has none (no run, an empty collapsed text).
Every input row gives one row, repeated rows alike; a null ``doc_id`` is hashed as ``"None"`` and never rewritten.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import re
from pyspark.sql import DataFrame

from affilix.llm.common import chunks, mix

MIN_LENGTH = 24
MIN_EXPONENT = 3
DIRECT = 16
WORD = re.compile(r"[^\x20\x09-\x0D]+")
RESULT = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
    "collapsed_sha256 string"
)


def planted(doc_id, n: int) -> np.ndarray:
    """The word each place shows after the contract's rewrite: from ``a`` on, the words ``a .. a + p - 1`` over again."""
    order = np.arange(n)
    if doc_id is None or n == 0:
        return order
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return order
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    order[a:] = a + (np.arange(n - a) % p)
    return order


class Grammar:
    """Recompression of a sequence of non-negative symbols; ``lce`` answers longest common extensions."""

    def __init__(self, seq: np.ndarray):
        self.n = n = len(seq)
        syms = seq.astype(np.int64)
        starts = np.arange(n, dtype=np.int64)
        ends = starts + 1
        # (is block level, starts, symbols or bases, units, ends)
        self.levels = [(False, starts, syms, None, ends)]
        salt = 0
        while len(syms) > 1:
            m = len(syms)
            head = np.ones(m, dtype=bool)
            head[1:] = syms[1:] != syms[:-1]
            first = np.flatnonzero(head)
            if len(first) < m:
                counts = np.diff(np.append(first, m))
                base = syms[first]
                unit = ends[first] - starts[first]
                starts, ends = starts[first], ends[first + counts - 1]
                self.levels.append((True, starts, base, unit, ends))
                syms = np.unique(base * (int(counts.max()) + 1) + counts, return_inverse=True)[1].astype(np.int64)
                if len(syms) == 1:
                    break
            salt += 1
            side = (mix(syms.astype(np.uint64) ^ np.uint64(mix(np.array([salt], dtype=np.uint64))[0])) & np.uint64(1)) == 1
            merge = np.zeros(len(syms), dtype=bool)
            merge[:-1] = ~side[:-1] & side[1:]
            if not merge.any():
                continue
            keep = np.ones(len(syms), dtype=bool)
            keep[1:] = ~merge[:-1]
            at = np.flatnonzero(keep)
            right = np.where(merge[at], syms[np.minimum(at + 1, len(syms) - 1)], -1)
            pair_end = np.where(merge[at], ends[np.minimum(at + 1, len(syms) - 1)], ends[at])
            syms = np.unique(syms[at] * (len(syms) + 2) + right + 1, return_inverse=True)[1].astype(np.int64)
            starts, ends = starts[at], pair_end
            self.levels.append((False, starts, syms, None, ends))

    def lce(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """For each pair of places, how many symbols from them on are equal.

        Each query climbs: after a step at level ``k`` it tries ``k + 1`` first, and on a difference it goes down level by
        level; it ends when the words themselves differ. Equal symbols at both places are always a valid step.
        """
        x, y = x.astype(np.int64).copy(), y.astype(np.int64).copy()
        out = np.zeros(len(x), dtype=np.int64)
        top = len(self.levels) - 1
        level = np.full(len(x), min(1, top), dtype=np.int64)
        active = np.flatnonzero((x < self.n) & (y < self.n))
        while len(active):
            xa, ya, la = x[active], y[active], level[active]
            step = np.zeros(len(active), dtype=np.int64)
            took = np.full(len(active), -1, dtype=np.int64)
            todo = np.arange(len(active))
            for k in range(int(la.max()), -1, -1):
                asked = todo[la[todo] >= k]
                if not len(asked):
                    continue
                block, starts, syms, unit, ends = self.levels[k]
                xs, ys = xa[asked], ya[asked]
                if block:
                    ix = np.searchsorted(starts, xs, side="right") - 1
                    iy = np.searchsorted(starts, ys, side="right") - 1
                    ux, uy = unit[ix], unit[iy]
                    ok = ((xs - starts[ix]) % ux == 0) & ((ys - starts[iy]) % uy == 0) & (syms[ix] == syms[iy])
                    moved = np.minimum((ends[ix] - xs) // ux, (ends[iy] - ys) // uy) * ux
                else:
                    ix = np.minimum(np.searchsorted(starts, xs), len(starts) - 1)
                    iy = np.minimum(np.searchsorted(starts, ys), len(starts) - 1)
                    ok = (starts[ix] == xs) & (starts[iy] == ys) & (syms[ix] == syms[iy])
                    moved = ends[ix] - xs
                step[asked[ok]] = moved[ok]
                took[asked[ok]] = k
                done = np.zeros(len(active), dtype=bool)
                done[asked[ok]] = True
                todo = todo[~done[todo]]
            x[active] += step
            y[active] += step
            out[active] += step
            level[active] = np.minimum(took + 1, top)
            active = active[(step > 0) & (x[active] < self.n) & (y[active] < self.n)]
        return out


def _candidates(ids: np.ndarray, min_length: int, min_exponent: int, block: int = 1 << 22) -> tuple[np.ndarray, np.ndarray]:
    """Grid places ``g`` (multiples of ``q``) with ``ids[g] == ids[g + q]``, for every period a run may have.

    Periods are taken in ranges of about ``block`` grid places, so that memory stays bounded for very long texts.
    """
    n = len(ids)
    top = n // min_exponent
    places, periods = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if n < min_length or top < 1:
        return places[0], periods[0]
    lo = 1
    while lo <= top:
        hi = lo
        total = 0
        while hi <= top and total < block:
            total += (n - hi - 1) // hi + 1
            hi += 1
        q = np.arange(lo, hi, dtype=np.int64)
        count = (n - q - 1) // q + 1
        period = np.repeat(q, count)
        offset = np.arange(len(period), dtype=np.int64) - np.repeat(np.cumsum(count) - count, count)
        g = offset * period
        hit = ids[g] == ids[g + period]
        places.append(g[hit])
        periods.append(period[hit])
        lo = hi
    return np.concatenate(places), np.concatenate(periods)


def _direct(ids: np.ndarray, x: np.ndarray, y: np.ndarray, sign: int, steps: int) -> np.ndarray:
    """Equal words from ``x`` and ``y`` on (``sign`` 1) or back (-1), counted up to ``steps``."""
    n = len(ids)
    k = np.arange(steps, dtype=np.int64) * sign
    xs, ys = x[:, None] + k, y[:, None] + k
    inside = (xs >= 0) & (ys >= 0) & (xs < n) & (ys < n)
    same = inside & (ids[np.clip(xs, 0, n - 1)] == ids[np.clip(ys, 0, n - 1)])
    return np.where(same.all(axis=1), steps, np.argmin(same, axis=1))


def find_runs(docs: list[np.ndarray], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT,
              direct: int = DIRECT) -> list[np.ndarray]:
    """Runs ``(start, length, period)`` of each sequence of word ids, sorted by start and period."""
    found, hard = [], []
    for d, ids in enumerate(docs):
        g, q = _candidates(ids, min_length, min_exponent)
        ahead = _direct(ids, g, g + q, 1, direct)
        back = _direct(ids, g - 1, g + q - 1, -1, direct)
        long = (ahead == direct) | (back == direct)
        found.append((g[~long], q[~long], ahead[~long], back[~long]))
        hard.append((g[long], q[long]))
    if any(len(g) for g, _ in hard):
        _extend(docs, hard, found)
    out = []
    for g, q, ahead, back in found:
        start, length = g - back, ahead + back + q
        ok = length >= np.maximum(min_length, min_exponent * q)
        runs = np.stack([start[ok], length[ok], q[ok]], axis=1) if ok.any() else np.zeros((0, 3), np.int64)
        if len(runs):
            runs = runs[np.lexsort((runs[:, 2], runs[:, 0] + runs[:, 1], runs[:, 0]))]
            first = np.ones(len(runs), dtype=bool)
            first[1:] = (runs[1:, 0] != runs[:-1, 0]) | (runs[1:, 1] != runs[:-1, 1])
            runs = runs[first]
            runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
        out.append(runs.astype(np.int64))
    return out


def _extend(docs: list[np.ndarray], hard: list, found: list) -> None:
    """Exact extensions of the candidates that direct comparison could not settle, from one grammar each way over the
    texts that have such candidates."""
    asking = [d for d, (g, _) in enumerate(hard) if len(g)]
    vocab = max(int(docs[d].max()) + 1 for d in asking)
    parts, offsets, at = [], [], 0
    for k, d in enumerate(asking):
        offsets.append(at)
        parts.append(docs[d])
        parts.append(np.array([vocab + k], dtype=np.int64))  # a symbol of its own ends every text
        at += len(docs[d]) + 1
    seq = np.concatenate(parts)
    forward, backward = Grammar(seq), Grammar(seq[::-1].copy())
    n = len(seq)
    gs = np.concatenate([hard[d][0] + offsets[k] for k, d in enumerate(asking)])
    qs = np.concatenate([hard[d][1] for d in asking])
    ahead = forward.lce(gs, gs + qs)
    back = backward.lce(n - gs, n - gs - qs)  # reversed places of g - 1 and g + q - 1
    at = 0
    for d in asking:
        g, q = hard[d]
        k = len(g)
        fg, fq, fa, fb = found[d]
        found[d] = (np.append(fg, g), np.append(fq, q), np.append(fa, ahead[at:at + k]), np.append(fb, back[at:at + k]))
        at += k


def _digest(doc_id, words: list[str], runs: np.ndarray) -> tuple:
    listing = "".join(f"{s},{length},{p}\n" for s, length, p in runs.tolist())
    keep = np.ones(len(words), dtype=bool)
    if len(runs):
        marks = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(marks, runs[:, 0] + runs[:, 2], 1)
        np.add.at(marks, runs[:, 0] + runs[:, 1], -1)
        keep = np.cumsum(marks[:-1]) == 0
    collapsed = " ".join(words) if keep.all() else " ".join(w for w, k in zip(words, keep) if k)
    best = (None,) * 4
    if len(runs):
        length, period = runs[:, 1], runs[:, 2]
        # Greatest length / period exactly; ties by start, then period (runs are sorted so).
        i = max(range(len(runs)), key=lambda j: (_Ratio(int(length[j]), int(period[j])), -j))
        s, length_i, p = (int(v) for v in runs[i])
        best = (s, length_i, p, 1000 * length_i // p)
    return (
        doc_id, len(runs), *best, hashlib.sha256(listing.encode()).hexdigest(),
        hashlib.sha256(collapsed.encode()).hexdigest(),
    )


class _Ratio:
    __slots__ = ("a", "b")

    def __init__(self, a: int, b: int):
        self.a, self.b = a, b

    def __lt__(self, other: "_Ratio") -> bool:
        return self.a * other.b < other.a * self.b

    def __eq__(self, other) -> bool:
        return self.a * other.b == other.a * self.b


def _detect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = [("" if t is None else t).encode() for t in batch["text"]]
        ids_col = [None if pd.isna(v) else int(v) for v in batch["doc_id"]]
        out = []
        for first, part in chunks(texts):
            words = [WORD.findall(t.decode()) for t in part]
            flat = [w for ws in words for w in ws]
            codes = pd.factorize(pd.Series(flat, dtype=object))[0].astype(np.int64) if flat else np.zeros(0, np.int64)
            seqs, shown, at = [], [], 0
            for k, ws in enumerate(words):
                order = planted(ids_col[first + k], len(ws))
                seqs.append(codes[at:at + len(ws)][order])
                shown.append(ws if order[-1:].tolist() == [len(ws) - 1] and np.all(order == np.arange(len(ws)))
                             else [ws[i] for i in order.tolist()])
                at += len(ws)
            for k, runs in enumerate(find_runs(seqs)):
                out.append(_digest(ids_col[first + k], shown[k], runs))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in RESULT.split(", ")]).astype(
            {"n_runs": "int64", "start": "Int64", "length": "Int64", "period": "Int64", "exponent_milli": "Int64"}
        )


def detect(docs: DataFrame) -> DataFrame:
    """One row per document: its runs counted, the one of greatest exponent, and digests of all runs and of the words
    left when each run keeps only its first period. Rows are worked where they lie; nothing is shuffled."""
    return docs.select("doc_id", "text").mapInPandas(_detect, RESULT)
