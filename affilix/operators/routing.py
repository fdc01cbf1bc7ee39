"""Which source an unseen paper's affiliations come from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Patterns on the licence, and the routes they mean. A licence may match several.
LICENSE_RULES = [("elsevier", "els"), ("medr", "medr"), ("bior", "bio"), ("others", "unk|arx")]
OTHERS = "others"


def has_archive_id() -> Column:
    """Either identifier of the article archive is known."""
    return F.coalesce("pmcid", F.col("pubmed_id").cast("string")).isNotNull()


def routes(rules: list[tuple[str, str]] = LICENSE_RULES) -> Column:
    """Array of a paper's routes: ``pmc`` alone if it has an archive id, else every rule its licence matches."""
    matched = [F.when(F.col("license").rlike(pattern), F.lit(name)) for name, pattern in rules]
    return F.when(has_archive_id(), F.array(F.lit("pmc"))).otherwise(F.array_compact(F.array(*matched)))


def route(metadata: DataFrame, rules: list[tuple[str, str]] = LICENSE_RULES) -> DataFrame:
    """One row per paper and route (column ``route``), in one scan. Papers without a route are left out."""
    return metadata.withColumn("route", F.explode(routes(rules)))


def route_counts(metadata: DataFrame, rules: list[tuple[str, str]] = LICENSE_RULES) -> DataFrame:
    """``route, n``; papers without a route count as ``unrouted``."""
    return (
        metadata.select(F.explode_outer(routes(rules)).alias("route"))
        .groupBy(F.coalesce("route", F.lit("unrouted")).alias("route")).agg(F.count("*").alias("n"))
    )
