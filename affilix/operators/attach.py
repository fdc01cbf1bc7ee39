"""Joins that bring results back to strings and papers.

The right side has one row per key, or a few; a key held by many rows on the left is split by the adaptive skew join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affilix import schemas
from affilix.operators.similarity import class_of


def attach_best(strings: DataFrame, best: DataFrame) -> DataFrame:
    """``affiliate, grid_id``: the entry its class chose, or ``not found``. ``best`` is ``class_id, inst_id``."""
    keyed = strings.select("affiliate", class_of(F.col("affiliate")).alias("class_id"))
    joined = keyed.join(
        best.select("class_id", F.col("inst_id").alias("grid_id")), "class_id", "left"
    )
    return joined.select("affiliate", F.coalesce("grid_id", F.lit(schemas.NOT_FOUND)).alias("grid_id"))


def attach_address(resolved: DataFrame, addresses: DataFrame) -> DataFrame:
    """Address columns by ``grid_id``; an id with several address rows gives several rows."""
    columns = ["grid_id", *schemas.ADDRESS_COLUMNS]
    joined = resolved.join(addresses.select(*columns), "grid_id", "left")
    return joined.select(*resolved.columns, *schemas.ADDRESS_COLUMNS)


def attach_papers(rows: DataFrame, resolved: DataFrame) -> DataFrame:
    """Every (paper, affiliation) row with its result columns; blank strings keep NULLs."""
    joined = rows.join(resolved, "affiliate", "left")
    return joined.select(*schemas.RESULT_COLUMNS)
