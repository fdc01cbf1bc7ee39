"""The contracts written out plainly, for comparison on small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import xxhash


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def space_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def fingerprint(text: str | None) -> int:
    words = space_words(lower(text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash(rows: list[tuple]) -> list[tuple]:
    """(doc_id, fingerprint, component_id) of (doc_id, text) rows."""
    prints = [fingerprint(t) for _, t in rows]
    distinct = sorted(set(prints))
    root = {f: f for f in distinct}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    least: dict = {}
    for (doc, _), f in zip(rows, prints):
        if doc is not None:
            least[find(f)] = min(least.get(find(f), doc), doc)
    return [(doc, f"{f:016x}", least.get(find(f))) for (doc, _), f in zip(rows, prints)]


def secrets(text: str | None) -> tuple:
    text = text or ""
    found = []
    assign = r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for n, (kind, pattern, group, least) in enumerate((
        ("assign", assign, 2, 6), ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]+", 0, 24)
    )):
        for m in re.finditer(pattern, text):
            if len(m.group(group)) >= least:
                found.append((m.start(), n, kind, m.end()))
    found.sort()
    kinds = Counter(f[2] for f in found)
    written = ",".join(f"{k}:{s}:{e}" for s, _, k, e in found)
    return kinds["assign"], kinds["access"], kinds["hex"], sha(written), written


def content_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def contamination(text: str | None, items: list[tuple]) -> tuple:
    words = content_words(text)
    hit, ids = set(), set()
    for item, passage in items:
        own = content_words(passage)
        if not own:
            continue
        size = min(13, len(own))
        windows = {tuple(own[i:i + size]) for i in range(len(own) - size + 1)}
        for i in range(len(words) - size + 1):
            if tuple(words[i:i + size]) in windows:
                hit.update(range(i, i + size))
                if item is not None:
                    ids.add(str(item))
    return len(words), len(hit), len(ids), sha(",".join(sorted(ids))), bool(hit) and 20 * len(hit) >= len(words)


def quality(text: str | None) -> tuple:
    words = space_words(text)
    lines = [x for x in (text or "").split("\n") if space_words(x)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    repeated = {i + k for i, w in enumerate(windows) if w in often for k in range(5)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
        len(repeated), len(words) < 10 or 100 * len(repeated) > 20 * len(words),
    )


def conversations(rows: list[tuple]) -> dict:
    """conv_id -> (n_turns, turns_sha256, loss_chars, loss_sha256) of (conv_id, turn, role, text) rows."""
    by: dict = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        learned = "".join(t for _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(learned), sha(learned))
    return out
