"""What an earlier run has already done.

NULL means "not collected, try again"; an empty list means "collected, nothing there". The difference is kept throughout.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affilix import schemas
from affilix.functions.text import normalize


class Diff(NamedTuple):
    done: DataFrame
    todo: DataFrame


def optional(spark, df: DataFrame | None, schema: str) -> DataFrame:
    """``df``, or an empty table of that schema when there is none."""
    if df is not None:
        return df
    fields = spark.createDataFrame([], schema).schema
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])


def _covered(prior: DataFrame, new: DataFrame) -> Column:
    """The prior result has rows, and at least as many as the new input."""
    def count(df: DataFrame) -> Column:
        return df.agg(F.count("*").alias("n")).scalar()

    return (count(prior) > 0) & (count(prior) >= count(new))


def diff_papers(data: DataFrame, prev: DataFrame | None, skip_if_prior_larger: bool = False) -> Diff:
    """Papers whose list an earlier run holds, and the rest. Repeated ids multiply, as in any join.

    ``skip_if_prior_larger`` takes row counts for proof: if the earlier result has as many rows as the input, everything
    is done. Off by default, as the keys may differ.
    """
    prior = optional(data.sparkSession, prev, schemas.COLLECTED)
    lists = prior.select("cord_uid", "affiliate")
    joined = data.drop("affiliate").join(lists, "cord_uid", "left").select(*schemas.COLLECTED_COLUMNS)
    done, todo = joined.filter("affiliate IS NOT NULL"), joined.filter("affiliate IS NULL")
    if skip_if_prior_larger:
        covered = _covered(prior, data)
        done = prior.select(*schemas.COLLECTED_COLUMNS).filter(covered).unionByName(done.filter(~covered))
        todo = todo.filter(~covered)
    return Diff(done, todo)


def affiliation_rows(papers: DataFrame) -> DataFrame:
    """``cord_uid, affiliate``: one normalised string per row. NULL and empty lists give no row, blank strings do."""
    return (
        papers.select("cord_uid", F.explode("affiliate").alias("affiliate"))
        .filter("affiliate IS NOT NULL")
        .select("cord_uid", normalize(F.col("affiliate")).alias("affiliate"))
    )


def distinct_affiliations(rows: DataFrame) -> DataFrame:
    """The strings to resolve: distinct and not blank."""
    return rows.select("affiliate").filter("affiliate <> ''").distinct()


def diff_strings(strings: DataFrame, cache: DataFrame | None, skip_if_prior_larger: bool = False) -> Diff:
    """Strings an earlier run has resolved (``not found`` counts), with its columns, and those still to do."""
    prior = optional(strings.sparkSession, cache, schemas.CACHE)
    if cache is None:
        return Diff(prior, strings)
    joined = strings.join(prior, "affiliate", "left")
    done, todo = joined.filter("grid_id IS NOT NULL"), joined.filter("grid_id IS NULL")
    if skip_if_prior_larger:
        covered = _covered(prior, strings)
        done = prior.filter(covered).unionByName(done.filter(~covered))
        todo = todo.filter(~covered)
    return Diff(done, todo.select("affiliate").distinct())


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, by column name; a missing column becomes NULL."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
