"""Stand-ins: the benchmark tables read as papers, registries, payloads and earlier results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affilix.functions.text import join_commas, words
from affilix.operators.segments import Scorer, lexicon_scorer

RULES = [("elsevier", "1"), ("medr", "2"), ("bior", "5|7"), ("others", "3")]
BIAS = -2.0


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def letters(name: Column) -> Column:
    return F.translate(name, "0123456789", "abcdefghij")


def no_list() -> Column:
    return F.array().cast("array<string>")


def titles(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select(
        "page_id", F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1).alias("title")
    )


def metadata(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source")
    doc_id = F.col("doc_id").cast("string")
    return docs.join(table(spark, sf, "labels"), "doc_id", "left").select(
        doc_id.alias("cord_uid"),
        F.col("lang").alias("source_x"),
        F.lit(None).cast("string").alias("sha"),
        F.concat(F.lit("d/"), doc_id).alias("doi"),
        F.col("source").alias("license"),
        F.when(F.col("quality") == 1, F.concat(F.lit("PMC"), doc_id)).alias("pmcid"),
        F.when((F.col("toxic") == 1) | (F.col("quality") == 0), F.concat(doc_id, F.lit(".0"))).alias("pubmed_id"),
    )


def prior(spark: SparkSession, sf: str) -> DataFrame:
    doc_id = F.col("doc_id").cast("string")
    found = F.array(F.concat(F.lit("prior "), doc_id), F.lit("shared"))
    text = F.lit(None).cast("string")
    return table(spark, sf, "labels").select(
        doc_id.alias("cord_uid"),
        *[text.alias(c) for c in ("source_x", "sha", "doi")],
        F.when(F.col("toxic") == 1, None).when(F.col("quality") == 1, found).otherwise(no_list()).alias("affiliate"),
        *[text.alias(c) for c in ("license", "pmcid", "pubmed_id")],
    )


def places(spark: SparkSession, sf: str) -> DataFrame:
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", letters(F.col("n_name")).alias("city"), F.col("r_name").alias("country")
    )


def customer_strings(spark: SparkSession, sf: str) -> DataFrame:
    customer, where = table(spark, sf, "customer"), places(spark, sf)
    return customer.join(where, customer.c_nationkey == where.n_nationkey).select(
        "c_custkey", "c_mktsegment", "c_name", "city", F.col("country").alias("r_name"),
        join_commas(F.col("c_name"), F.col("city"), F.col("country")).alias("affiliate"),
    )


def suppliers(spark: SparkSession, sf: str) -> DataFrame:
    supplier, where = table(spark, sf, "supplier"), places(spark, sf)
    return supplier.join(where, supplier.s_nationkey == where.n_nationkey).select(
        F.col("s_suppkey").cast("string").alias("id"), "s_suppkey", F.col("s_name").alias("name"), "city", "country",
        "s_acctbal", "n_nationkey",
    )


def registry(rows: DataFrame, aliases: Column | None = None, code: Column | None = None) -> DataFrame:
    """A registry from ``id, name, city, country``."""
    address = F.struct(
        F.col("city").alias("city"), F.col("country").alias("country"),
        (F.lit(None).cast("string") if code is None else code).alias("country_code"),
    )
    return rows.select(
        "id", "name", (no_list() if aliases is None else aliases).alias("aliases"), no_list().alias("acronyms"),
        F.array(address).alias("addresses"),
    )


def nation_registry(spark: SparkSession, sf: str) -> DataFrame:
    rows = places(spark, sf).select(
        F.col("n_nationkey").cast("string").alias("id"), F.col("city").alias("name"), "city", "country"
    )
    return registry(rows)


def part_registry(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("city"),
        F.col("p_type").alias("country"),
    )
    both = F.array(F.concat_ws(" ", "country", "name"), F.col("city"))
    return registry(rows, aliases=both, code=F.substring("country", 1, 3))


def document_registry(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as a registry of free texts: a name and nothing else."""
    none = F.lit(None).cast("array<struct<city: string, country: string, country_code: string>>")
    return table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("id"), F.col("text").alias("name"), no_list().alias("aliases"),
        no_list().alias("acronyms"), none.alias("addresses"),
    )


def supplier_addresses(spark: SparkSession, sf: str) -> DataFrame:
    return suppliers(spark, sf).select(
        F.col("id").alias("grid_id"), F.col("n_nationkey").cast("bigint").alias("geonames_city_id"),
        F.col("name").alias("institute_name"), F.col("s_acctbal").alias("lat"), (-F.col("s_acctbal")).alias("lng"),
        "city", F.lit(None).cast("string").alias("state"), F.lit(None).cast("string").alias("state_code"), "country",
    )


def paper_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as papers; each supplier on an order, with the line's status, is one affiliation."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_linestatus")
    named = suppliers(spark, sf)
    return lines.join(named, lines.l_suppkey == named.s_suppkey).select(
        F.col("l_orderkey").cast("string").alias("cord_uid"),
        join_commas(F.col("name"), F.col("city"), F.col("country"), F.col("l_linestatus")).alias("affiliate"),
    ).distinct()


def papers(spark: SparkSession, sf: str) -> DataFrame:
    """The same with ``affiliate`` as a list. One list per affiliation: nothing is gathered per order."""
    return paper_rows(spark, sf).select("cord_uid", F.array("affiliate").alias("affiliate"))


def lexicon(spark: SparkSession, sf: str) -> DataFrame:
    def weighed(name: str, text: Column, weight: float) -> DataFrame:
        return table(spark, sf, name).select(F.explode(words(text)).alias("token")).distinct().withColumn(
            "weight", F.lit(weight)
        )

    def firm(column: str) -> Column:
        return F.substring_index(column, "#", 1)

    return (
        weighed("supplier", firm("s_name"), 4.0)
        .unionByName(weighed("customer", firm("c_name"), 3.0))
        .unionByName(weighed("region", F.col("r_name"), -1.5))
    )


def scorer(spark: SparkSession, sf: str) -> Scorer:
    return lexicon_scorer(lexicon(spark, sf), BIAS)
