"""Affiliation lists out of stored payloads: article XML, citation XML, JSON and HTML.

Payloads are parsed where they are read; only ids and short lists travel further. A payload that cannot be parsed gives
an empty list: collected, nothing found.
"""

from __future__ import annotations

from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affilix.functions.markup import extract_items
from affilix.functions.text import join_commas

# Markup of the two preprint servers: the block, its entries, and the parts one of them keeps apart.
ADDRESS_BLOCK = r"""(?s)<ol\b[^>]*\bclass\s*=\s*["']affiliation-list["'][^>]*>(.*?)</ol\s*>"""
ADDRESS_ITEM = r"(?s)<address\b[^>]*>(.*?)</address\s*>"
ADDRESS_PART = r"(?s)<span\b[^>]*>(.*?)</span\s*>"

XML_TAGS = {"archive": "aff", "citation": "Affiliation"}
PROVIDERS = ["pmc", "elsevier", "medr", "bior"]


def archive_id(pmcid: Column) -> Column:
    """The id without any leading letters P, M or C."""
    return F.regexp_replace(pmcid, "^[PMC]+", "")


def numeric_id(value: Column) -> Column:
    """Whole number of an id that may be written ``123.0``; NULL if it is none."""
    return value.try_cast("double").try_cast("bigint")


def xml_tag() -> Column:
    """Tag to look for: the citation's when there is no archive id, else the article's."""
    return F.when(F.col("pmcid").isNull(), F.lit(XML_TAGS["citation"])).otherwise(F.lit(XML_TAGS["archive"]))


def xml_request() -> Column:
    """Identifier a payload is stored under: the archive id, else the numeric citation id."""
    return F.coalesce(archive_id(F.col("pmcid")), numeric_id(F.col("pubmed_id")).cast("string"))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _xml_texts(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    def direct_text(element) -> str:
        return (element.text or "") + "".join(child.tail or "" for child in element)

    def texts(body, tag):
        if body is None or tag is None:
            return []
        try:
            return [direct_text(found) for found in ElementTree.fromstring(body).iter(tag)]
        except (ElementTree.ParseError, ValueError):
            return []

    for bodies, tags in batches:
        yield pd.Series([texts(b, t) for b, t in zip(bodies, tags)], dtype=object)


def xml_affiliations(body: Column, tag: Column) -> Column:
    """Per element of that tag at any depth: its own text and the text between its children, not theirs."""
    return _xml_texts(body, tag)


def json_affiliations(body: Column) -> Column:
    """``name,city,country`` per entry of ``affiliation``, which is an object or a list of objects.

    A missing or null value is the empty string, so ``",,"`` can occur.
    """
    doc = F.try_parse_json(body)
    several = F.try_variant_get(doc, "$.affiliation", "array<variant>")
    single = F.try_variant_get(doc, "$.affiliation", "map<string,variant>")
    whole = F.try_variant_get(doc, "$.affiliation", "variant")
    entries = F.coalesce(several, F.when(F.size(single) > 0, F.array(whole)))

    def text(entry: Column, key: str) -> Column:
        return F.try_variant_get(entry, f"$['{key}']", "string")

    lines = F.transform(
        entries,
        lambda e: join_commas(text(e, "affilname"), text(e, "affiliation-city"), text(e, "affiliation-country")),
    )
    return F.coalesce(lines, F.array().cast("array<string>"))


def html_addresses(body: Column, parts: bool = False) -> Column:
    """Entries of the affiliation list; with ``parts`` every part of an entry is its own."""
    return extract_items(body, ADDRESS_BLOCK, ADDRESS_ITEM, ADDRESS_PART if parts else None)


def extract(payloads: DataFrame) -> DataFrame:
    """``cord_uid, provider, tag, affiliate``: the list in each payload. Only XML payloads go through Python workers.

    ``tag`` is that of the payload. XML without a tag is read as an article.
    """
    provider, body = F.col("provider"), F.col("body")
    empty = F.array().cast("array<string>")
    tag = F.coalesce("tag", F.lit(XML_TAGS["archive"]))
    lists = (
        F.when(provider == "elsevier", json_affiliations(body))
        .when(provider == "medr", html_addresses(body))
        .when(provider == "bior", html_addresses(body, parts=True))
    )

    def found(where: Column, affiliate: Column) -> DataFrame:
        return payloads.filter(where).select(
            "cord_uid", "provider", "tag", F.coalesce(affiliate, empty).alias("affiliate")
        )

    others = [name for name in PROVIDERS if name != "pmc"]
    return found(provider == "pmc", xml_affiliations(body, tag)).unionByName(found(provider.isin(others), lists))


def yield_report(extracted: DataFrame) -> DataFrame:
    """``provider, payloads, without, affiliations``."""
    return extracted.groupBy("provider").agg(
        F.count("*").alias("payloads"),
        F.count_if(F.size("affiliate") == 0).alias("without"),
        F.sum(F.size("affiliate")).cast("bigint").alias("affiliations"),
    )
