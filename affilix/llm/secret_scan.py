"""Secret scans over an incremental blob ledger.

Every version of a text is addressed by its content. The ledger, a Parquet table, holds one row for each blob and rule
version that has been scanned, with what was found. A run scans only pairs the ledger lacks, adds them, and joins findings
back to all paths that hold the blob. DataFrame functions only.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affilix.session import scratch_path


class Rule(NamedTuple):
    """A kind of secret. ``pattern`` matches never overlap; one is kept if its ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int
    least: int
    version: str = "1"

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The rules of the base scan, in the order in which they are listed.
RULES = [
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    # Runs of fewer than 24 characters fail anyway, and none of them begins inside a longer run.
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
]

LEDGER_SCHEMA = "blob_id string, rule string, spans array<struct<start: int, end: int>>"


def spans_of(text: Column, rule: Rule) -> Column:
    """Spans of a rule in code points, end exclusive: the gaps between matches and the matches, added up."""
    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    judged = matches if rule.group == 0 else F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    gaps = F.split(text, rule.pattern, -1)
    parts = F.zip_with(
        F.transform(F.slice(gaps, 1, F.size(gaps) - 1), lambda g: F.char_length(g)),
        F.arrays_zip(
            F.transform(matches, lambda m: F.char_length(m)).alias("size"),
            F.transform(judged, lambda m: F.char_length(m)).alias("judged"),
        ),
        lambda gap, m: F.struct(gap.alias("gap"), m["size"].alias("size"), m["judged"].alias("judged")),
    )
    none = F.array().cast("array<struct<start: int, end: int>>")
    begin = F.struct(F.lit(0).alias("at"), none.alias("found"))

    def step(acc: Column, p: Column) -> Column:
        start = acc["at"] + p["gap"]
        end = start + p["size"]
        kept = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(
            end.alias("at"), F.when(p["judged"] >= rule.least, F.concat(acc["found"], kept)).otherwise(acc["found"]).alias("found")
        )

    found = F.aggregate(parts, begin, step, lambda acc: acc["found"])
    return F.when(F.size(matches) > 0, found).otherwise(none)


def blob_of(text: Column) -> Column:
    """Address of a text; null counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def update_ledger(docs: DataFrame, ledger: str, rules: list[Rule] = RULES) -> None:
    """Scan the blobs of ``docs`` (``text``) for the rule versions the ledger at path ``ledger`` lacks, and add them.

    A text that occurs many times is scanned once. A run that fails half-way leaves the ledger as it was, and rows
    written twice count once.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    blobs = docs.select(blob_of(F.col("text")).alias("blob_id"), text.alias("text")).groupBy("blob_id").agg(
        F.first("text").alias("text")
    )
    known = read_ledger(spark, ledger)
    every = F.array(*[F.lit(r.key) for r in rules])
    if known is None:
        todo = blobs.withColumn("todo", every)
    else:
        seen = known.groupBy("blob_id").agg(F.collect_set("rule").alias("seen"))
        todo = blobs.join(seen, "blob_id", "left").select(
            "blob_id", "text", F.array_except(every, F.coalesce("seen", F.array().cast("array<string>"))).alias("todo")
        ).filter(F.size("todo") > 0)
    results = F.array(*[
        F.struct(
            F.lit(r.key).alias("rule"),
            F.when(F.array_contains("todo", r.key), spans_of(F.col("text"), r)).alias("spans"),
        ) for r in rules
    ])
    todo.select("blob_id", F.inline(results)).filter(F.col("spans").isNotNull()).write.mode("append").parquet(ledger)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame | None:
    """The ledger at a path, or None where none has been written yet."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(ledger)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def secret_spans(spark: SparkSession, ledger: str, rules: list[Rule] = RULES) -> DataFrame:
    """``blob_id, spans(start, kind, end)`` of the blobs in the ledger that hold something by these rule versions.

    Spans are sorted by start, then in the order of the rules.
    """
    order = F.create_map(*[x for n, r in enumerate(rules) for x in (F.lit(r.key), F.lit(n))])
    kinds = F.array(*[F.lit(r.kind) for r in rules])

    def ordered(s: Column) -> Column:
        return F.struct(s["start"].alias("start"), F.element_at(order, F.col("rule")).alias("n"), s["end"].alias("end"))

    def named(s: Column) -> Column:
        return F.struct(s["start"].alias("start"), F.get(kinds, s["n"]).alias("kind"), s["end"].alias("end"))

    return (
        read_ledger(spark, ledger)
        .filter(F.col("rule").isin([r.key for r in rules]) & (F.size("spans") > 0))
        .dropDuplicates(["blob_id", "rule"])
        .groupBy("blob_id").agg(F.collect_list(F.transform("spans", ordered)).alias("lists"))
        .select("blob_id", F.transform(F.sort_array(F.flatten("lists")), named).alias("spans"))
    )


def findings(docs: DataFrame, ledger: str, rules: list[Rule] = RULES) -> DataFrame:
    """``doc_id, blob_id, spans(start, kind, end)`` of every row of ``docs``: the ledger joined back to all its paths.

    Null texts count as empty, repeated rows and null ids stay.
    """
    paths = docs.select("doc_id", blob_of(F.col("text")).alias("blob_id"))
    none = F.array().cast("array<struct<start: int, kind: string, end: int>>")
    return paths.join(secret_spans(docs.sparkSession, ledger, rules), "blob_id", "left").select(
        "doc_id", "blob_id", F.coalesce("spans", none).alias("spans")
    )


def scan(docs: DataFrame, ledger: str | None = None, rules: list[Rule] = RULES) -> DataFrame:
    """:func:`findings` after :func:`update_ledger`; without a path the ledger is a new one in the shared folder."""
    ledger = ledger or scratch_path(docs.sparkSession, "blob_ledger")
    update_ledger(docs, ledger, rules)
    return findings(docs, ledger, rules)


def written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
    )), ",")


def digest(found: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(r.kind).alias(f"n_{r.kind}") for r in rules]
    return found.select(
        "doc_id", *counts, F.sha2(written(F.col("spans")).cast("binary"), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )


def redact(text: Column, spans: Column, mask: str = "[REDACTED]") -> Column:
    """``text`` with every span, overlapping ones as one, replaced by ``mask``."""
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substr(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        joined = (s["start"] < acc["at"]) & (acc["at"] > 0)
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(joined, acc["parts"]).otherwise(F.concat(acc["parts"], F.array(gap, F.lit(mask)))).alias("parts"),
        )

    def finish(acc: Column) -> Column:
        return F.concat(F.array_join(acc["parts"], ""), F.substr(text, acc["at"] + 1))

    return F.when(F.size(spans) > 0, F.aggregate(spans, begin, step, finish)).otherwise(text)


def redact_documents(docs: DataFrame, ledger: str, rules: list[Rule] = RULES) -> DataFrame:
    """``docs`` with the secrets of every text replaced, and ``n_chars``, where there is one, counted again.

    Only blobs with findings travel to their documents; a null text stays null.
    """
    update_ledger(docs, ledger, rules)
    found = secret_spans(docs.sparkSession, ledger, rules).select(
        F.col("blob_id").alias("_blob"), F.col("spans").alias("_spans")
    )
    joined = docs.withColumn("_blob", blob_of(F.col("text"))).join(found, "_blob", "left")
    spans = F.coalesce("_spans", F.array().cast("array<struct<start: int, kind: string, end: int>>"))
    out = joined.withColumn("text", redact(F.col("text"), spans))
    if "n_chars" in docs.columns:
        changed = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.size(spans) > 0, changed).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
