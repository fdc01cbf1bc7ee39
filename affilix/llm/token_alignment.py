"""Alignment of two tokenizations of the same texts: groups with equal ends, overlapping token pairs, corpus counts.

Each batch of documents is encoded by both tokenizers in the Python worker (A: a byte-level BPE given ``" " + text``, B: a
sentencepiece BPE that adds the space itself; special-token strings inside texts stay plain text). Token bytes give
byte offsets. Groups are cut where an A and a B token end at the same offset. Overlapping A-B token pairs are found with
``pandas.merge_asof`` per chunk, whose texts lie end to end: every A token start finds the B token that covers it, every B
token start the A token that covers it, and the union of both directions is every overlapping pair. Each document leaves
one row with its counts, its groups digest and its links as ``(a, b, occurrences)`` arrays.

Spark then counts, for every ``(a, b)`` id pair, the documents that hold it linked (map-side combined, so a pair in
most documents sends one row per task), the highest such count per A id, and sums over each document's links. The
pair table is broadcast only when its row count is measured below ``BROADCAST_ROWS``; otherwise the join shuffles and
the adaptive skew join splits hot pairs. A row holds each of its pairs once, so no pair is shuffled with its document
except those of ids that come more than once; sums are added up per row before they leave a task.

Defined results: a null or empty text, or one whose A or B bytes do not join to ``" " + text`` (a tokenizer normalised
it), has no tokens: all counts are 0 and ``groups_sha256`` is ``""``. Documents are told apart by ``doc_id``; rows with
one id and one text are the same document and count once; a null ``doc_id`` gets its own counts but adds to no corpus
count. Extra columns of the input are dropped; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affilix.llm.common import chunks
from affilix.session import materialize

TOKENIZERS = "/opt/tokenizers"
A_FILE = "byte_bpe_50k.tiktoken"
# Fixed value: the pre-tokenizing pattern of this byte-level vocabulary, as published with it.
A_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
B_FILE = "piece_bpe_32k.model"
BROADCAST_ROWS = 2_000_000
CHUNK = 1 << 18
TOKENS = (
    "doc_id long, text_hash long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "link_a array<int>, link_b array<int>, link_n array<int>"
)
_loaded: dict = {}


def _tokenizers(folder: str):
    """Both tokenizers and the bytes of every id, loaded once per worker."""
    if folder not in _loaded:
        import base64

        import sentencepiece
        import tiktoken

        with open(os.path.join(folder, A_FILE), "rb") as ranks_file:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, ranks_file)}
        a = tiktoken.Encoding("byte_bpe", pat_str=A_PATTERN, mergeable_ranks=ranks, special_tokens={})
        a_bytes = [b""] * (max(ranks.values()) + 1)
        for word, rank in ranks.items():
            a_bytes[rank] = word
        b = sentencepiece.SentencePieceProcessor(model_file=os.path.join(folder, B_FILE))
        escaped = re.compile(r"<0x([0-9A-Fa-f]{2})>")
        b_bytes = []
        for i in range(b.get_piece_size()):
            piece = b.id_to_piece(i)
            hit = escaped.fullmatch(piece)
            b_bytes.append(bytes([int(hit.group(1), 16)]) if hit else piece.replace("▁", " ").encode())
        _loaded[folder] = (
            a, a_bytes, np.array([len(x) for x in a_bytes], dtype=np.int64),
            b, b_bytes, np.array([len(x) for x in b_bytes], dtype=np.int64),
        )
    return _loaded[folder]


def _digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of ``0 .. n - 1`` as bytes, right-aligned in rows with a free last place; and how many each has."""
    width = len(str(n))
    places = np.arange(n)[:, None] // 10 ** np.arange(width)[::-1]
    size = np.maximum((places > 0).sum(axis=1), 1)
    shown = np.arange(width)[::-1] < size[:, None]
    return np.hstack([np.where(shown, places % 10 + ord("0"), 0), np.zeros((n, 1), np.int64)]).astype(np.uint8), size


def _marks(group: np.ndarray, last: str) -> np.ndarray:
    """What follows each token: a comma if the next token is in its group, else ``last``."""
    return np.where(np.append(group[1:] == group[:-1], False), ord(","), ord(last)).astype(np.uint8)


def _words(tokens: list) -> np.ndarray:
    """The bytes of each token as rows of 64-bit words, filled up with zeros."""
    width = -(-max(map(len, tokens)) // 8) * 8
    return np.frombuffer(b"".join(t.ljust(width, b"\0") for t in tokens), dtype="<u8").reshape(len(tokens), -1)


def _checked(encoded: list, length: np.ndarray, words: np.ndarray, raw: bytes, size: np.ndarray):
    """Ids of all texts, their number per text, and whether a text's token bytes join to its ``size`` bytes of ``raw``,
    which ends in eight more bytes. Compared eight bytes of every token at a time."""
    n = np.array([len(x) for x in encoded], dtype=np.int64)
    ids = np.fromiter(itertools.chain.from_iterable(encoded), np.int64, int(n.sum()))
    long = length[ids]
    doc = np.repeat(np.arange(len(n)), n)
    fine = np.bincount(doc, weights=long, minlength=len(n)).astype(np.int64) == size
    # Of the texts with the right number of bytes, every token begins where it lies in ``raw``.
    known = fine[doc]
    at = (np.cumsum(long * known) - long) + (np.cumsum(size * ~fine) - size * ~fine)[doc]
    left = np.flatnonzero(known & (long > 0))
    window = np.ndarray((len(raw) - 7,), dtype="<u8", buffer=raw, strides=(1,))
    mask = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=np.uint64)
    word = 0
    while len(left):
        rest = long[left] - 8 * word
        wrong = window[at[left] + 8 * word] & mask[np.minimum(rest, 8)] != words[ids[left], word]
        fine[doc[left[wrong]]] = False
        word += 1
        left = left[rest > 8]
    return ids, n, fine


def _chunk(strings: list, a_enc, b_enc, tables, digits) -> list:
    """``n_a, n_b, n_groups, n_links, groups digest, link arrays`` of each text of a chunk.

    All tokens of the chunk lie on one line of bytes, each text after the one before, so ends, groups and links are
    found for the whole chunk at once.
    """
    a_len, a_words, b_len, b_words = tables
    whole = [(" " + s).encode() if s else b"" for s in strings]
    size = np.array([len(w) for w in whole], dtype=np.int64)
    raw = b"".join([*whole, bytes(8)])
    a_ids, n_a, a_fine = _checked(a_enc, a_len, a_words, raw, size)
    b_ids, n_b, b_fine = _checked(b_enc, b_len, b_words, raw, size)
    fine = a_fine & b_fine & (size > 0)
    if not fine.all():
        a_ids, b_ids = a_ids[np.repeat(fine, n_a)], b_ids[np.repeat(fine, n_b)]
        n_a, n_b = n_a * fine, n_b * fine
    a_doc, b_doc = np.repeat(np.arange(len(strings)), n_a), np.repeat(np.arange(len(strings)), n_b)
    a_end, b_end = np.cumsum(a_len[a_ids]), np.cumsum(b_len[b_ids])
    a_ends, b_ends = np.zeros(len(raw), dtype=bool), np.zeros(len(raw), dtype=bool)
    a_ends[a_end], b_ends[b_end] = True, True
    a_cut, b_cut = b_ends[a_end], a_ends[b_end]
    a_group, b_group = np.cumsum(a_cut) - a_cut, np.cumsum(b_cut) - b_cut
    n_groups = np.bincount(a_doc[a_cut], minlength=len(strings))

    # Groups text: A ids then B ids of each group, groups in order; one line of bytes for the chunk, cut per text.
    order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
    ids = np.concatenate([a_ids, b_ids])[order]
    shown = digits[0][ids]
    shown[:, -1] = np.concatenate([_marks(a_group, "|"), _marks(b_group, ";")])[order]
    line = shown[shown != 0].tobytes()
    ends = np.concatenate([[0], np.cumsum(digits[1][ids] + 1)])
    bounds = ends[np.concatenate([[0], np.cumsum(n_a + n_b)])].tolist()

    # Links: each start finds the other side's token that covers it. Both sides of a text begin and end at the same bytes
    # of the line, so no start finds a token of another text.
    a_tok = pd.DataFrame({"at": a_end - a_len[a_ids], "i": np.arange(len(a_ids))})
    b_tok = pd.DataFrame({"at": b_end - b_len[b_ids], "j": np.arange(len(b_ids))})
    a_to_b = pd.merge_asof(a_tok, b_tok, on="at", direction="backward")
    b_to_a = pd.merge_asof(b_tok, a_tok.assign(a_at=a_tok["at"]), on="at", direction="backward")
    # A pair found both ways starts at one place on both sides; the second way keeps only A tokens that start before.
    inside = b_to_a["a_at"].to_numpy(np.float64, na_value=np.inf) < b_to_a["at"].to_numpy()
    i = np.concatenate([a_to_b["i"].to_numpy(), b_to_a["i"].to_numpy(np.float64, na_value=-1)[inside]]).astype(np.int64)
    j = np.concatenate([a_to_b["j"].to_numpy(np.float64, na_value=-1), b_to_a["j"].to_numpy()[inside]]).astype(np.int64)
    real = (i >= 0) & (j >= 0)
    i, j = i[real], j[real]
    # Distinct (doc, a, b) with their occurrences; ids below 2**20 and docs of a chunk fit one 64-bit key.
    key, l_n = np.unique((a_doc[i] << 40) | (a_ids[i] << 20) | b_ids[j], return_counts=True)
    l_doc, l_a, l_b = key >> 40, (key >> 20) & 0xFFFFF, key & 0xFFFFF
    l_bounds = np.searchsorted(l_doc, np.arange(len(strings) + 1))

    out = []
    for k in range(len(strings)):
        text = line[bounds[k]:max(bounds[k + 1] - 1, bounds[k])]
        lo, hi = l_bounds[k], l_bounds[k + 1]
        out.append((
            int(n_a[k]), int(n_b[k]), int(n_groups[k]), int(l_n[lo:hi].sum()),
            hashlib.sha256(text).hexdigest() if text else "",
            l_a[lo:hi].astype(np.int32), l_b[lo:hi].astype(np.int32), l_n[lo:hi].astype(np.int32),
        ))
    return out


def _encode(folder: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, a_bytes, a_len, b, b_bytes, b_len = _tokenizers(folder)
        digits = _digits(max(len(a_bytes), len(b_bytes)))
        tables = (a_len, _words(a_bytes), b_len, _words(b_bytes))
        for batch in batches:
            doc_ids = [None if pd.isna(v) else int(v) for v in batch["doc_id"]]
            hashes = batch["text_hash"].astype("int64").tolist()
            texts = (("" if t is None else t).encode() for t in batch["text"])
            for first, part in chunks(texts, CHUNK):
                strings = [x.decode() for x in part]
                a_enc = [a.encode_ordinary(" " + s) for s in strings]
                b_enc = b.encode(strings, num_threads=1)
                rows = [
                    (doc_ids[first + k], hashes[first + k], *found)
                    for k, found in enumerate(_chunk(strings, a_enc, b_enc, tables, digits))
                ]
                # Tokens take some hundred times the memory of their text, so only a short chunk of it is open at a time.
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in TOKENS.split(", ")])

    return run


def tokens(docs: DataFrame, folder: str = TOKENIZERS) -> DataFrame:
    """One row per input row: both tokenizations' counts, the groups digest and the links as parallel arrays."""
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text",
        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_hash"),
    )
    return keyed.mapInPandas(_encode(folder), TOKENS)


def align(docs: DataFrame, folder: str = TOKENIZERS, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    ``n_best`` counts the links whose pair count is the highest of their A id, ties included; ``count_sum`` sums the
    pair counts over the links.
    """
    encoded = materialize(
        tokens(docs, folder).withColumn("row", F.monotonically_increasing_id()), "token_alignment"
    )
    ids = encoded.filter(F.col("doc_id").isNotNull())
    repeated = materialize(ids.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id"), "repeated")

    def pairs(rows: DataFrame, *keys: str) -> DataFrame:
        return rows.select(*keys, F.explode(F.arrays_zip("link_a", "link_b")).alias("l")).select(
            *keys, F.col("l.link_a").alias("a"), F.col("l.link_b").alias("b"))

    # A row holds a pair once, so rows are documents; only the rows of ids that come again are told apart by their id.
    once = pairs(ids.join(repeated, "doc_id", "left_anti"))
    again = pairs(ids.join(repeated, "doc_id", "left_semi"), "doc_id").distinct().select("a", "b")
    counts = once.unionByName(again).groupBy("a", "b").agg(F.count("*").alias("docs"))
    counts = materialize(counts, "token_pair_counts")
    counts = counts.join(counts.groupBy("a").agg(F.max("docs").alias("top")), "a")
    counts = materialize(counts, "token_pair_tops")
    if counts.count() <= broadcast_rows:
        counts = F.broadcast(counts)
    links = encoded.select("row", F.explode(F.arrays_zip("link_a", "link_b", "link_n")).alias("l")).select(
        "row", F.col("l.link_a").alias("a"), F.col("l.link_b").alias("b"), F.col("l.link_n").cast("long").alias("n"))
    per_row = (
        links.join(counts, ["a", "b"], "left").groupBy("row").agg(
            F.sum(F.when(F.col("docs") == F.col("top"), F.col("n")).otherwise(0)).alias("n_best"),
            F.sum(F.col("n") * F.coalesce(F.col("docs"), F.lit(0))).alias("count_sum"),
        )
    )
    return encoded.join(per_row, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), "groups_sha256",
    )
