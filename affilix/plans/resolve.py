"""The resolve job: the institute and place of every (paper, affiliation)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affilix import schemas
from affilix.operators.attach import attach_address, attach_best, attach_papers
from affilix.operators.gazetteer import build_gazetteer, describe, parse_places
from affilix.operators.incremental import affiliation_rows, diff_strings, distinct_affiliations, union_all
from affilix.operators.retrieval import TOP_K, SearchIndex, build_index, search_join
from affilix.operators.segments import MIN_PROB, Scorer, best_segments, distinct_segments, segments
from affilix.operators.similarity import THRESHOLD, Neighbours, class_of, neighbours
from affilix.operators.voting import best_entry, class_votes
from affilix.session import materialize


def describe_strings(strings: DataFrame, gazetteer: DataFrame, scorer: Scorer, min_prob: float = MIN_PROB) -> DataFrame:
    """``affiliate, extracted, country, city``: the institute part and the place of each string."""
    parts = segments(strings)
    scored = materialize(scorer(distinct_segments(parts)), "scores")
    return describe(strings, best_segments(parts, scored, min_prob), parse_places(strings, gazetteer))


def choose_entries(
    described: DataFrame, found: Neighbours, index: SearchIndex, top_k: int = TOP_K, cascade: bool = False
) -> DataFrame:
    """``class_id, inst_id, votes``: the registry entry each class of strings votes for."""
    asked = materialize(
        described.filter("extracted <> ''")
        .select(class_of(F.col("affiliate")).alias("class_id"), F.col("extracted").alias("institute"), "country", "city")
        .filter("class_id IS NOT NULL"),
        "asked",
    )
    query = F.struct("institute", "country", "city").alias("query_id")
    hits = search_join(asked, index, top_k, cascade).select(query, "inst_id", "score")
    return best_entry(class_votes(asked.select("class_id", query), hits, found.pairs))


def resolve_strings(
    strings: DataFrame,
    institutes: DataFrame,
    addresses: DataFrame,
    scorer: Scorer,
    *,
    gazetteer: DataFrame | None = None,
    index: SearchIndex | None = None,
    threshold: float = THRESHOLD,
    top_k: int = TOP_K,
    cascade: bool = False,
) -> DataFrame:
    """``affiliate, grid_id`` and the address columns for distinct strings, which are read several times."""
    places = build_gazetteer(institutes) if gazetteer is None else gazetteer
    described = describe_strings(strings, places, scorer)
    found = neighbours(strings, threshold=threshold)
    best = choose_entries(described, found, index or build_index(institutes), top_k, cascade)
    return attach_address(attach_best(strings, materialize(best, "best")), addresses)


def resolve(
    papers: DataFrame,
    institutes: DataFrame,
    addresses: DataFrame,
    scorer: Scorer,
    cache: DataFrame | None = None,
    *,
    gazetteer: DataFrame | None = None,
    index: SearchIndex | None = None,
    threshold: float = THRESHOLD,
    top_k: int = TOP_K,
    cascade: bool = False,
    skip_if_prior_larger: bool = False,
    save_cache: str | None = None,
) -> DataFrame:
    """One row per (paper, affiliation) with the eleven result columns.

    Strings in ``cache`` are not resolved again. The rest see only each other as neighbours and weigh terms by
    themselves, so a cached run may answer differently from a full one; by default everything is resolved. For the same
    reason string results are kept for later runs only if ``save_cache`` names a folder.
    """
    # Read at both ends of the job, and what papers come from may be as large as they are.
    rows = materialize(affiliation_rows(papers), "rows")
    diff = diff_strings(distinct_affiliations(rows), cache, skip_if_prior_larger)
    todo = materialize(diff.todo, "todo")
    new = resolve_strings(
        todo, institutes, addresses, scorer,
        gazetteer=gazetteer, index=index, threshold=threshold, top_k=top_k, cascade=cascade,
    )
    columns = ["affiliate", "grid_id", *schemas.ADDRESS_COLUMNS]
    resolved = materialize(union_all(diff.done.select(*columns), new.select(*columns)), "resolved")
    if save_cache is not None:
        resolved.write.parquet(save_cache)
    return attach_papers(rows, resolved)


def attach_cached(papers: DataFrame, cache: DataFrame) -> DataFrame:
    """The same result when nothing is left to resolve: normalise, then join the cache."""
    return attach_papers(affiliation_rows(papers), cache)


def resolve_in_runs(
    papers: DataFrame,
    institutes: DataFrame,
    addresses: DataFrame,
    scorer: Scorer,
    state: str | None = None,
    save_state: str | None = None,
    *,
    gazetteer: DataFrame | None = None,
    index: SearchIndex | None = None,
    threshold: float = THRESHOLD,
    top_k: int = TOP_K,
    cascade: bool = False,
) -> DataFrame:
    """The rows of ``papers`` and of every run whose state ``state`` holds, as one full run over all of them gives.

    A run keeps, below ``save_state``, three tables: its affiliation rows, the description (institute part, country,
    city) of every string, and the search hits of every query. Both are functions of one string or one query alone, so a
    later run computes them for new strings and new queries only and reads the rest. Term weights depend on all strings,
    and with them the classes of neighbours and their votes; these are computed again over the strings of all runs, so
    a new string can change the answer of an old one, as it would in a full run. A plain cache of answers cannot.
    """
    spark = papers.sparkSession
    # Only new rows are written; those of the runs before stay where they are and are read from there.
    rows = materialize(affiliation_rows(papers), "rows")
    old_described = old_hits = None
    if state is not None:
        rows = rows.unionByName(spark.read.parquet(f"{state}/rows"))
        old_described = spark.read.parquet(f"{state}/described")
        old_hits = spark.read.parquet(f"{state}/hits")
    strings = materialize(distinct_affiliations(rows), "strings")
    places = build_gazetteer(institutes) if gazetteer is None else gazetteer
    new_strings = strings if old_described is None else strings.join(old_described, "affiliate", "left_anti")
    described = describe_strings(new_strings, places, scorer)
    if old_described is not None:
        described = described.unionByName(old_described.join(strings, "affiliate", "left_semi"))
    described = materialize(described, "described")

    asked = described.filter("extracted <> ''").select(
        class_of(F.col("affiliate")).alias("class_id"), F.col("extracted").alias("institute"), "country", "city"
    ).filter("class_id IS NOT NULL")
    query = F.struct("institute", "country", "city").alias("query_id")
    wanted = asked.select("institute", "country", "city").distinct()
    if old_hits is not None:
        wanted = wanted.join(old_hits.select(F.col("query_id.*")).distinct(), ["institute", "country", "city"], "left_anti")
    hits = search_join(wanted, index or build_index(institutes), top_k, cascade).select(query, "inst_id", "score")
    if old_hits is not None:
        hits = hits.unionByName(old_hits)
    hits = materialize(hits, "hits")

    found = neighbours(strings, threshold=threshold)
    best = materialize(best_entry(class_votes(asked.select("class_id", query), hits, found.pairs)), "best")
    columns = ["affiliate", "grid_id", *schemas.ADDRESS_COLUMNS]
    resolved = materialize(attach_address(attach_best(strings, best), addresses).select(*columns), "resolved")
    if save_state is not None:
        rows.write.parquet(f"{save_state}/rows")
        described.write.parquet(f"{save_state}/described")
        hits.write.parquet(f"{save_state}/hits")
    return attach_papers(rows, resolved)
