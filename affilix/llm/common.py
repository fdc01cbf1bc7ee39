"""Helpers the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affilix.session import shared_root

SPACE = r"[\x20\x09-\x0D]"
CHUNK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give ``DataFrame.checkpoint`` the shared folder of :func:`shared_root` where the session names none."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(f"{shared_root(spark)}/checkpoints")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other letter as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body's lambdas read it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether a document belongs to the part that no model may learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def labelled_sample(labels: DataFrame, label: str, bound: int, where: Column) -> DataFrame:
    """``doc_id, label`` of at most ``bound`` labelled documents, those of the smallest hashes; for fitting only.

    A document labelled several times counts once, by its mean label (a tie is 1). Null ids and labels are left out.
    """
    rows = labels.filter(where & F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    return (
        rows.groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    )


def with_labels(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """``doc_id, text, label`` of the documents in a bounded sample. The sample is what is broadcast."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")


def chunks(texts: Iterable[bytes], size: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Whole texts in lists of about ``size`` bytes (a longer text alone), each with the number of its first text."""
    part: list[bytes] = []
    total = first = 0
    for n, text in enumerate(texts):
        if part and total + len(text) > size:
            yield first, part
            part, total, first = [], 0, n
        part.append(text)
        total += len(text)
    if part:
        yield first, part


_powers: dict[str, np.ndarray] = {}


def _power(kind: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        steps = np.full(max(n, CHUNK_BYTES + 4096), base, dtype=np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if n <= 8 * CHUNK_BYTES:
            _powers[kind] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all others."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29))


class Tokens:
    """Tokens of several texts at once: runs of bytes of one class.

    ``table[b]`` is what byte ``b`` counts as (0: between tokens), ``kinds[b]`` its class. ``starts`` and ``ends`` are byte
    offsets into ``data``, ``hashes`` 64-bit values that depend on a token's bytes only, ``text`` the number of its text.
    """

    def __init__(self, texts: list[bytes], table: np.ndarray, kinds: np.ndarray | None = None):
        self.data = b"\x00".join([b"", *texts, b""])
        raw = np.frombuffer(self.data, dtype=np.uint8)
        sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
        self.offsets = np.cumsum(sizes) - sizes + 1
        value = table[raw]
        kind = (value != 0) if kinds is None else kinds[raw]
        change = np.flatnonzero(kind[1:] != kind[:-1]) + 1
        inside = kind[change] != 0
        self.starts = change[inside]
        self.ends = np.append(change[1:], len(raw))[inside]
        sums = np.cumsum(value * _power("up", _BASE, len(raw)), dtype=np.uint64)
        self.hashes = mix((sums[self.ends - 1] - sums[self.starts - 1]) * _power("down", _INVERSE, len(raw))[self.starts])
        self.text = np.searchsorted(self.offsets, self.starts, side="right") - 1
        self.counts = np.bincount(self.text, minlength=len(texts))
        self.first = np.cumsum(self.counts) - self.counts
