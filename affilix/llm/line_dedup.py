"""Lines repeated across documents, found by range-partitioned hashes and streamed first occurrences.

Every line whose key (the line without white space ``[\\x20\\x09-\\x0D]`` at both ends, A-Z in lower case) has at least
``min_chars`` code points becomes a row ``(hash of key, doc_id, text hash, line number)``. These rows are range-partitioned
on the key hash and the document, and sorted in each partition by key, document (largest first) and position, so that
the rows of one key lie together and a hot key is split over several partitions by document. One pass over the sorted
partitions notes, for the first and the last key of each partition, how many documents hold it there and its largest
document: at most two rows a partition reach the driver. The second pass streams the rows: the first document of a key
is the largest one and keeps its lines; the lines of the others are dropped once three documents are known to hold the
key. Only the rows of the first two documents of an open key are held back, never a whole key.

The dropped lines come back as runs of line numbers per document, a run-length coded keep bitmap, which is applied to
the texts at the end; no text is shuffled before that.

Defined results: a null or empty text is one empty line. Documents are told apart by ``doc_id``; rows with the same id
are one document (their lines count once for a key and, if it is the largest, all of them keep their lines). A null
``doc_id`` holds no key for counting and is never the largest, so it loses the lines of keys that three other documents
hold. Empty tables give empty results, and extra columns pass through; ``n_lines`` and ``n_dropped`` replace columns of
those names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affilix.llm.common import ensure_checkpoint_dir, lower_ascii

MIN_CHARS = 20
MIN_DOCS = 3
WHITE = " \t\n\x0b\x0c\r"
_NULL = np.iinfo(np.int64).min


def line_key(line) -> F.Column:
    return lower_ascii(F.btrim(line, F.lit(WHITE)))


def _columns(batch: pd.DataFrame):
    k1 = batch["k1"].to_numpy(dtype=np.int64)
    k2 = batch["k2"].to_numpy(dtype=np.int64)
    doc = batch["doc"].fillna(_NULL).to_numpy(dtype=np.int64)
    return k1, k2, doc


def _groups(k1: np.ndarray, k2: np.ndarray, doc: np.ndarray, key0=None, doc0=None):
    """Start flags of keys and of documents (null ids never start one), given the key and document before the batch."""
    n = len(k1)
    new_key = np.ones(n, dtype=bool)
    new_key[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
    if key0 is not None and n:
        new_key[0] = (k1[0], k2[0]) != key0
    new_doc = new_key.copy()
    new_doc[1:] |= doc[1:] != doc[:-1]
    if doc0 is not None and n and not new_key[0]:
        new_doc[0] = doc[0] != doc0
    new_doc &= doc != _NULL
    return new_key, new_doc


def _segments(new_key: np.ndarray) -> np.ndarray:
    """Bounds of the runs of one key in a batch; the first run may continue a key of the batch before."""
    starts = np.flatnonzero(new_key)
    bounds = np.append(starts, len(new_key))
    if not len(starts) or starts[0] != 0:
        bounds = np.insert(bounds, 0, 0)
    return bounds


def _first_and_last(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For the first and the last key of the partition: its documents here and the largest of them."""
    pid = TaskContext.get().partitionId()
    first = last = None  # [k1, k2, n_docs, max_doc, last_doc]
    for batch in batches:
        if batch.empty:
            continue
        k1, k2, doc = _columns(batch)
        key0 = None if last is None else (last[0], last[1])
        new_key, new_doc = _groups(k1, k2, doc, key0, None if last is None else last[4])
        bounds = _segments(new_key)
        counts = np.add.reduceat(new_doc.astype(np.int64), bounds[:-1])
        # Only the first run of a batch can continue a key, only the last one can go on; those in between are neither
        # the first nor the last key of the partition, unless the batch is the first.
        picked = sorted({0, len(counts) - 1})
        for j in picked:
            s, e = bounds[j], bounds[j + 1]
            top, tail = int(doc[s]), int(doc[s:e][doc[s:e] != _NULL][-1]) if (doc[s:e] != _NULL).any() else _NULL
            if last is not None and (int(k1[s]), int(k2[s])) == (last[0], last[1]):
                last[2] += int(counts[j])
                last[3] = last[3] if last[3] != _NULL else top
                last[4] = tail if tail != _NULL else last[4]
            else:
                last = [int(k1[s]), int(k2[s]), int(counts[j]), top, tail]
                if first is None:
                    first = last
    rows = [] if first is None else [first] if first is last else [first, last]
    yield pd.DataFrame(
        [(pid, r[0], r[1], r[2], None if r[3] == _NULL else r[3]) for r in rows],
        columns=["pid", "k1", "k2", "n", "top"],
    )


def _spans(summary: list) -> dict:
    """``(partition, key) -> (documents before, documents after, largest document)`` of keys that cross partitions."""
    by_key: dict = {}
    for pid, k1, k2, n, top in summary:
        by_key.setdefault((k1, k2), []).append((pid, n, top))
    out = {}
    for key, parts in by_key.items():
        if len(parts) < 2:
            continue
        parts.sort()
        total = sum(n for _, n, _ in parts)
        tops = [t for _, _, t in parts if t is not None]
        top = max(tops) if tops else _NULL
        before = 0
        for pid, n, _ in parts:
            out[(pid, *key)] = (before, total - before - n, top)
            before += n
    return out


def _dropped(spans: dict, min_docs: int):
    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pid = TaskContext.get().partitionId()
        held = None  # rows of an open key not yet known to be common: of two documents at most
        decided = None  # (k1, k2, largest doc, last doc) of an open key known to be common
        for batch in batches:
            if held is not None:
                batch = pd.concat([held, batch], ignore_index=True)
                held = None
            if batch.empty:
                continue
            k1, k2, doc = _columns(batch)
            open_key = None if decided is None else (decided[0], decided[1])
            new_key, new_doc = _groups(k1, k2, doc, open_key, None if decided is None else decided[3])
            bounds = _segments(new_key)
            starts, ends = bounds[:-1], bounds[1:]
            counts = np.add.reduceat(new_doc.astype(np.int64), starts)
            tops = doc[starts]
            lengths = ends - starts
            # Keys inside the batch are whole: their documents here are all their documents.
            drop = np.repeat(counts >= min_docs, lengths) & (doc != np.repeat(tops, lengths))
            last = len(starts) - 1
            for j in sorted({0, last}):
                s, e = starts[j], ends[j]
                key = (int(k1[s]), int(k2[s]))
                if j == 0 and decided is not None and key == open_key:
                    common, top = True, decided[2]
                else:
                    before, after, top = spans.get((pid, *key), (0, 0, int(tops[j])))
                    common = before + int(counts[j]) + after >= min_docs
                drop[s:e] = common & (doc[s:e] != top)
                if j == last:
                    decided = (*key, top, int(doc[e - 1])) if common else None
                    if not common:
                        held = batch.iloc[s:e]
                        drop = drop[:s]
                        batch = batch.iloc[:s]
            out = batch.loc[drop, ["doc", "th", "pos"]]
            if len(out):
                yield out
        if held is not None and len(held):
            k1, k2, doc = _columns(held)
            key = (int(k1[0]), int(k2[0]))
            _, new_doc = _groups(k1, k2, doc)
            before, after, top = spans.get((pid, *key), (0, 0, int(doc[0])))
            if before + int(new_doc.sum()) + after >= min_docs:
                out = held.loc[doc != top, ["doc", "th", "pos"]]
                if len(out):
                    yield out

    return stream


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``doc_id, text_hash, dropped``: per document, the runs of dropped lines as ``array<struct<start, length>>``.

    Documents that lose no line have no row. ``text_hash`` is ``xxhash64`` of the text (null as empty), so that rows
    with one id and different texts are told apart when the bitmaps are applied.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = docs.select(
        F.col("doc_id").cast("long").alias("doc"), F.xxhash64(text).alias("th"),
        F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"),
    )
    keyed = lines.select(
        "doc", "th", "pos", line_key(F.col("line")).alias("key")
    ).filter(F.char_length("key") >= min_chars)
    rows = keyed.select(F.xxhash64("key").alias("k1"), F.hash("key").alias("k2"), "doc", "th", F.col("pos").cast("int"))
    order = ["k1", "k2", F.col("doc").desc_nulls_last()]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ensure_checkpoint_dir(spark)
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order, "th", "pos").checkpoint()
    summary = [tuple(r) for r in ranged.mapInPandas(_first_and_last, "pid int, k1 long, k2 int, n long, top long").collect()]
    dropped = ranged.mapInPandas(_dropped(_spans(summary), min_docs), "doc long, th long, pos int")
    by_doc = Window.partitionBy("doc", "th").orderBy("pos")
    runs = (
        dropped.withColumn("run", F.col("pos") - F.dense_rank().over(by_doc))
        .groupBy("doc", "th", "run").agg(F.min("pos").alias("start"), (F.max("pos") - F.min("pos") + 1).alias("length"))
        .groupBy("doc", "th").agg(F.sort_array(F.collect_list(F.struct("start", "length"))).alias("dropped"))
    )
    return runs.withColumnRenamed("doc", "doc_id").withColumnRenamed("th", "text_hash")


@F.pandas_udf(T.StructType([
    T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()), T.StructField("text", T.StringType()),
]))
def _apply(text: pd.Series, runs: pd.Series) -> pd.DataFrame:
    n_lines, n_dropped, kept = [], [], []
    for t, r in zip(text, runs):
        lines = ("" if t is None else t).split("\n")
        n_lines.append(len(lines))
        if r is None or len(r) == 0:
            n_dropped.append(0)
            kept.append("\n".join(lines))
            continue
        keep = np.ones(len(lines), dtype=bool)
        for run in r:
            keep[run["start"]: run["start"] + run["length"]] = False
        n_dropped.append(int(len(lines) - keep.sum()))
        kept.append("\n".join(line for line, k in zip(lines, keep) if k))
    return pd.DataFrame({"n_lines": n_lines, "n_dropped": n_dropped, "text": kept})


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text`` and ``n_lines``, ``n_dropped`` added.

    A line goes if its key has at least ``min_chars`` code points and at least ``min_docs`` documents hold it, unless its
    document has the largest ``doc_id`` among them. Kept lines are joined by ``\\n``; a null text comes back as ``""``.
    """
    tag = uuid.uuid4().hex[:8]
    doc, th, runs, out = f"_doc_{tag}", f"_th_{tag}", f"_runs_{tag}", f"_out_{tag}"
    bitmaps = keep_bitmaps(docs, min_chars, min_docs).select(
        F.col("doc_id").alias(doc), F.col("text_hash").alias(th), F.col("dropped").alias(runs)
    )
    keyed = docs.withColumns({doc: F.col("doc_id").cast("long"), th: F.xxhash64(F.coalesce(F.col("text"), F.lit("")))})
    joined = keyed.join(bitmaps, [keyed[doc].eqNullSafe(bitmaps[doc]), keyed[th] == bitmaps[th]], "left").drop(
        bitmaps[doc], bitmaps[th]
    )
    result = joined.withColumn(out, _apply(F.col("text"), F.col(runs)))
    return result.withColumns({
        "text": F.col(f"{out}.text"), "n_lines": F.col(f"{out}.n_lines"), "n_dropped": F.col(f"{out}.n_dropped"),
    }).drop(doc, th, runs, out)
