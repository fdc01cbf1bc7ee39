"""The collect job: which papers still lack affiliations, and the lists found for them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affilix import schemas
from affilix.operators.extraction import extract, xml_tag
from affilix.operators.incremental import diff_papers, union_all
from affilix.operators.routing import LICENSE_RULES, OTHERS, route

XML_ROUTE = "pmc"


def collect(
    metadata: DataFrame,
    payloads: DataFrame,
    prev: DataFrame | None = None,
    rules: list[tuple[str, str]] = LICENSE_RULES,
    skip_if_prior_larger: bool = False,
) -> DataFrame:
    """Papers with their affiliation list: those of ``prev``, and those found in ``payloads`` for the rest.

    A paper with several routes gives one row per route. Papers of the route ``others`` get an empty list. A paper whose
    payload is not stored yet has no list and is left out, so a later run tries it again; so do papers without a route.
    Of two XML payloads of a paper the article counts if the paper has an archive id, else the citation; one without a
    tag serves either.
    """
    diff = diff_papers(metadata, prev, skip_if_prior_larger)
    routed = route(diff.todo.drop("affiliate"), rules)
    found = extract(payloads).select(
        F.col("cord_uid").alias("paper"), F.col("provider").alias("from"), "tag", F.col("affiliate").alias("stored")
    )
    wanted = (F.col("from") != XML_ROUTE) | F.col("tag").isNull() | (F.col("tag") == xml_tag())
    match = (F.col("cord_uid") == F.col("paper")) & (F.col("route") == F.col("from")) & wanted
    # One pass over the routed papers: the others have no payload and get an empty list.
    empty = F.array().cast("array<string>")
    listed = routed.join(found, match, "left").withColumn(
        "affiliate", F.when(F.col("route") == OTHERS, F.coalesce("stored", empty)).otherwise(F.col("stored"))
    )
    columns = schemas.COLLECTED_COLUMNS
    return union_all(diff.done.select(*columns), listed.select(*columns)).dropna(subset=["affiliate"])
