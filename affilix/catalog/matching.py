"""Queries on similarity, retrieval, voting, segment scoring and place names."""

from __future__ import annotations

from pyspark.sql import functions as F

from affilix.catalog import sql as S
from affilix.catalog import tables as T
from affilix.catalog.register import ORACLES, query
from affilix.functions.text import clean
from affilix.operators.gazetteer import build_gazetteer, parse_places
from affilix.operators.impact_search import block_max_search
from affilix.operators.retrieval import build_index, load_index, save_index, search_join
from affilix.operators.segments import (
    best_segments, distinct_segments, fit_segment_model, model_scorer, segments,
)
from affilix.operators.similarity import class_of, neighbour_counts, neighbour_rows, neighbours, term_classes, tfidf_terms
from affilix.operators.voting import best_entry, class_votes
from affilix.plans.resolve import describe_strings
from affilix.session import materialize, scratch_path


@query(f"""
    WITH {S.tfidf('benchmark', 'item_id', 'text')}
    SELECT item_id, term, round(w, 6) AS weight FROM weights
""")
def tfidf_weights(spark, sf):
    items = T.table(spark, sf, "benchmark")
    classes = materialize(term_classes(items, "text"), "classes")
    n_rows = items.agg(F.count("*").cast("double").alias("n")).scalar()
    keyed = items.select("item_id", class_of(F.col("text")).alias("class_id"))
    return keyed.join(tfidf_terms(classes, n_rows), "class_id").select(
        "item_id", "term", F.round("weight", 6).alias("weight")
    )


_TITLE_PAIRS = f"""
    WITH titles AS ({S.TITLES}), {S.tfidf('titles', 'page_id', 'title')},
    one AS (SELECT bag, min(page_id) AS page_id, count(*) AS copies FROM bags GROUP BY bag),
    v AS (SELECT o.bag, w.term, w.w FROM one o JOIN weights w USING (page_id)),
    sims AS (SELECT a.bag, b.bag AS neighbour, sum(a.w * b.w) AS sim FROM v a JOIN v b USING (term) GROUP BY ALL),
    near AS (SELECT * FROM sims WHERE round(sim, 9) > 0.65)
"""


@query(_TITLE_PAIRS + "SELECT bag, neighbour, round(sim, 6) AS similarity FROM near")
def cosine_neighbours(spark, sf):
    found = neighbours(T.titles(spark, sf), "title")
    bag = F.array_join("terms", " ")
    here = found.classes.select("class_id", bag.alias("bag"))
    there = found.classes.select(F.col("class_id").alias("neighbour_id"), bag.alias("neighbour"))
    return found.pairs.join(here, "class_id").join(there, "neighbour_id").select(
        "bag", "neighbour", F.round("similarity", 6).alias("similarity")
    )


@query(f"""
    WITH {S.tfidf('documents', 'doc_id', 'text')},
    one AS (SELECT bag, min(doc_id) AS doc_id FROM bags GROUP BY bag),
    v AS (SELECT o.doc_id, w.term, w.w FROM one o JOIN weights w USING (doc_id)),
    sims AS (SELECT a.doc_id, b.doc_id AS neighbour, sum(a.w * b.w) AS sim FROM v a JOIN v b USING (term) GROUP BY ALL)
    SELECT doc_id, neighbour, round(sim, 6) AS similarity FROM sims WHERE round(sim, 9) > 0.65
""")
def document_neighbours(spark, sf):
    """Whole documents; a class of copies goes by its smallest id."""
    docs = T.table(spark, sf, "documents").select("doc_id", "text")
    return neighbours(docs, "text", label="doc_id").pairs.select(
        F.col("label").alias("doc_id"), "neighbour", F.round("similarity", 6).alias("similarity")
    )


@query(_TITLE_PAIRS + """
    SELECT t.title, u.title AS neighbour FROM titles t JOIN bags b USING (page_id) JOIN near n ON n.bag = b.bag
    JOIN bags c ON c.bag = n.neighbour JOIN titles u ON u.page_id = c.page_id
""")
def neighbour_lists(spark, sf):
    """The neighbour list of every string, written out."""
    pages = T.titles(spark, sf)
    return neighbour_rows(pages, neighbours(pages, "title"), "title")


@query(_TITLE_PAIRS + """
    SELECT t.page_id, coalesce(CAST(sum(o.copies) AS BIGINT), 0) AS n_neighbours
    FROM titles t LEFT JOIN bags b USING (page_id) LEFT JOIN near n ON n.bag = b.bag LEFT JOIN one o ON o.bag = n.neighbour
    GROUP BY t.page_id
""")
def neighbour_list_sizes(spark, sf):
    pages = T.titles(spark, sf)
    return neighbour_counts(pages, neighbours(pages, "title"), "title").select("page_id", "n_neighbours")


@query(f"""
    WITH reg AS (SELECT CAST(p_partkey AS VARCHAR) AS id, p_name, p_type || ' ' || p_name || ' ' || p_brand AS alias,
                 p_brand, p_type, substr(p_type, 1, 3) AS code FROM part),
    rows AS ({S.registry_rows('reg', name='p_name', aliases='alias', country='p_type', country_code='code', city='p_brand')}),
    none AS (SELECT '' AS qid, '' AS institute, '' AS country, '' AS city WHERE false),
    {S.search('rows', 'none')}
    SELECT field, tok AS token, id AS inst_id, round(impact, 6) AS impact FROM s_imp
""")
def registry_index(spark, sf):
    index = build_index(T.part_registry(spark, sf))
    return index.postings.select("field", "token", "inst_id", F.round("impact", 6).alias("impact"))


@query(f"""
    WITH reg AS (SELECT CAST(p_partkey AS VARCHAR) AS id, p_name, p_type || ' ' || p_name || ' ' || p_brand AS alias,
                 p_brand, p_type, substr(p_type, 1, 3) AS code FROM part),
    rows AS ({S.registry_rows('reg', name='p_name', aliases='alias', country='p_type', country_code='code', city='p_brand')}),
    none AS (SELECT '' AS qid, '' AS institute, '' AS country, '' AS city WHERE false),
    {S.search('rows', 'none')}
    SELECT field, tok AS token, id AS inst_id, round(impact, 6) AS impact FROM s_imp
""")
def registry_index_saved(spark, sf):
    """The index written by one run and read by another."""
    path = scratch_path(spark, "saved_index")
    save_index(build_index(T.part_registry(spark, sf)), path)
    return load_index(spark, path).postings.select("field", "token", "inst_id", F.round("impact", 6).alias("impact"))


_DOCUMENTS = "reg AS (SELECT CAST(doc_id AS VARCHAR) AS id, text FROM documents), rows AS (" + S.registry_rows(
    "reg", name="text"
) + ")"


@query(f"""
    WITH {_DOCUMENTS},
    q AS (SELECT CAST(item_id AS VARCHAR) AS qid, {S.clean('text')} AS institute, '' AS country, '' AS city FROM benchmark),
    {S.search('rows', 'q')}
    SELECT CAST(qid AS BIGINT) AS item_id, id AS doc, round(score, 6) AS score, rank FROM s_hits
""")
def bm25_top20(spark, sf):
    items = T.table(spark, sf, "benchmark").select("item_id", clean(F.col("text")).alias("institute"))
    asked = items.select("institute", F.lit("").alias("country"), F.lit("").alias("city"))
    hits = search_join(asked, build_index(T.document_registry(spark, sf)))
    return items.join(hits, "institute").select(
        "item_id", F.col("inst_id").alias("doc"), F.round("score", 6).alias("score"), F.col("rank").cast("bigint")
    )


@query(ORACLES["bm25_top20"])
def bm25_top20_blocks(spark, sf):
    """bm25_top20 through impact-ordered blocks: only blocks whose bound reaches a query's k-th seed score are read."""
    items = T.table(spark, sf, "benchmark").select("item_id", clean(F.col("text")).alias("institute"))
    asked = items.select("institute").filter("institute <> ''").distinct().withColumn("query_id", F.col("institute"))
    hits = block_max_search(asked, build_index(T.document_registry(spark, sf))).withColumnRenamed("query_id", "institute")
    return items.join(hits, "institute").select(
        "item_id", F.col("inst_id").alias("doc"), F.round("score", 6).alias("score"), F.col("rank").cast("bigint")
    )


_PARTS = (
    "reg AS (SELECT CAST(p_partkey AS VARCHAR) AS id, p_name, p_type || ' ' || p_name || ' ' || p_brand AS alias, "
    "p_brand, p_type, substr(p_type, 1, 3) AS code FROM part), rows AS ("
    + S.registry_rows("reg", name="p_name", aliases="alias", country="p_type", country_code="code", city="p_brand") + ")"
)


# Each part asks for its own name: anywhere, in its type (or the type's code), and in its type and brand.
_PART_QUERIES = f"""
    SELECT DISTINCT {S.clean('p_name')} AS institute, '' AS country, '' AS city FROM part
    UNION SELECT DISTINCT {S.clean('p_name')}, {S.clean('p_type')}, '' FROM part
    UNION SELECT DISTINCT {S.clean('p_name')}, lower(substr(p_type, 1, 3)), {S.clean('p_brand')} FROM part
    UNION SELECT DISTINCT {S.clean('p_name')}, '', {S.clean('p_brand')} FROM part
    UNION SELECT DISTINCT '', {S.clean('p_type')}, '' FROM part
"""


@query(f"""
    WITH {_PARTS},
    q AS (SELECT institute || '/' || country || '/' || city AS qid, * FROM ({_PART_QUERIES})),
    {S.search('rows', 'q')}
    SELECT institute, country, city, id AS part, round(score, 6) AS score, rank FROM s_hits JOIN q USING (qid)
""")
def required_match_search(spark, sf):
    part = T.table(spark, sf, "part")
    name, kind, brand = clean(F.col("p_name")), clean(F.col("p_type")), clean(F.col("p_brand"))
    code, empty = F.lower(F.substring("p_type", 1, 3)), F.lit("")

    def ask(institute, country, city):
        return part.select(institute.alias("institute"), country.alias("country"), city.alias("city"))

    asked = (
        ask(name, empty, empty).union(ask(name, kind, empty)).union(ask(name, code, brand))
        .union(ask(name, empty, brand)).union(ask(empty, kind, empty))
    )
    hits = search_join(asked, build_index(T.part_registry(spark, sf)))
    return hits.select(
        "institute", "country", "city", F.col("inst_id").alias("part"), F.round("score", 6).alias("score"),
        F.col("rank").cast("bigint"),
    )


# Parts ask in another part's brand, or in a type that does not exist: some queries have to let go of their place.
_CASCADE = f"""
    WITH {_PARTS},
    asked AS (SELECT DISTINCT {S.clean('p_name')} AS institute,
        CASE WHEN p_size > 25 THEN {S.clean('p_type')} ELSE 'nowhere' END AS country,
        CASE WHEN p_size > 40 THEN {S.clean('p_brand')} ELSE 'atlantis' END AS city FROM part),
    q AS (SELECT institute || '/' || country || '/' || city AS qid, * FROM asked),
    {S.search('rows', 'q', 'a')},
    open2 AS (SELECT * FROM q WHERE qid NOT IN (SELECT qid FROM a_hits)),
    q2 AS (SELECT qid, institute, country, '' AS city FROM open2),
    {S.search('rows', 'q2', 'b')},
    open3 AS (SELECT * FROM q2 WHERE qid NOT IN (SELECT qid FROM b_hits)),
    q3 AS (SELECT qid, institute, '' AS country, '' AS city FROM open3),
    {S.search('rows', 'q3', 'c')},
    every AS (SELECT *, 1 AS level FROM a_hits UNION ALL SELECT *, 2 FROM b_hits UNION ALL SELECT *, 3 FROM c_hits)
    SELECT institute, country, city, id AS part, round(score, 6) AS score, rank, level
    FROM every JOIN q USING (qid)
"""


@query(_CASCADE)
def search_cascade(spark, sf):
    size = F.col("p_size")
    asked = T.table(spark, sf, "part").select(
        clean(F.col("p_name")).alias("institute"),
        F.when(size > 25, clean(F.col("p_type"))).otherwise("nowhere").alias("country"),
        F.when(size > 40, clean(F.col("p_brand"))).otherwise("atlantis").alias("city"),
    )
    hits = search_join(asked, build_index(T.part_registry(spark, sf)), cascade=True)
    return hits.select(
        "institute", "country", "city", F.col("inst_id").alias("part"), F.round("score", 6).alias("score"),
        F.col("rank").cast("bigint"), "level",
    )


@query(f"""
    WITH titles AS ({S.TITLES}), strings AS (SELECT DISTINCT title FROM titles WHERE {S.clean('title')} <> ''),
    {S.tfidf('strings', 'title', 'title')}, {_DOCUMENTS},
    q AS (SELECT DISTINCT {S.clean('title')} AS qid, {S.clean('title')} AS institute, '' AS country, '' AS city FROM strings),
    {S.search('rows', 'q')},
    near AS (SELECT a.title, b.title AS neighbour FROM weights a JOIN weights b USING (term)
             GROUP BY ALL HAVING round(sum(a.w * b.w), 9) > 0.65),
    votes AS (SELECT n.title, h.id, sum(h.score) AS votes FROM near n JOIN s_hits h ON h.qid = {S.clean('n.neighbour')}
              GROUP BY ALL),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY title ORDER BY round(votes, 6) DESC, id DESC) AS rk FROM votes)
    SELECT title, id AS doc, round(votes, 6) AS votes FROM ranked WHERE rk = 1
""")
def vote_best(spark, sf):
    strings = materialize(
        T.titles(spark, sf).select("title").distinct().filter(clean(F.col("title")) != ""), "strings"
    )
    asked = strings.select(
        "title", class_of(F.col("title")).alias("class_id"), clean(F.col("title")).alias("institute"),
        F.lit("").alias("country"), F.lit("").alias("city"),
    )
    hits = search_join(asked, build_index(T.document_registry(spark, sf), written=False)).withColumnRenamed("institute", "query_id")
    found = neighbours(strings, "title")
    votes = class_votes(
        asked.filter("class_id IS NOT NULL").select("class_id", F.col("institute").alias("query_id")), hits, found.pairs
    )
    return asked.join(best_entry(votes), "class_id").select(
        "title", F.col("inst_id").alias("doc"), F.round("votes", 6).alias("votes")
    )


_CUSTOMERS = f"strings AS (SELECT DISTINCT affiliate FROM ({S.CUSTOMER_STRINGS}))"


@query(f"WITH {_CUSTOMERS}, {S.parts('strings')} SELECT segment, round(prob, 6) AS prob FROM probs")
def segment_scores(spark, sf):
    strings = T.customer_strings(spark, sf).select("affiliate").distinct()
    scored = T.scorer(spark, sf)(distinct_segments(segments(strings)))
    return scored.select("segment", F.round("prob", 6).alias("prob"))


@query(f"""
    WITH {_CUSTOMERS}, {S.parts('strings')}
    SELECT affiliate, coalesce(extracted, '') AS extracted FROM strings LEFT JOIN best USING (affiliate)
""")
def best_segment(spark, sf):
    strings = T.customer_strings(spark, sf).select("affiliate").distinct()
    parts = materialize(segments(strings), "segments")
    best = best_segments(parts, materialize(T.scorer(spark, sf)(distinct_segments(parts)), "scores"))
    keyed = strings.select("affiliate", F.unhex(F.md5("affiliate")).alias("aff_id"))
    return keyed.join(best, "aff_id", "left").select("affiliate", F.coalesce("extracted", F.lit("")).alias("extracted"))


@query(f"""
    WITH {_CUSTOMERS},
    {S.places('strings', f"SELECT {S.letters('n_name')} FROM nation", "SELECT r_name FROM region")}
    SELECT affiliate, city, country FROM places
""")
def gazetteer_parse(spark, sf):
    strings = T.customer_strings(spark, sf).select("affiliate").distinct()
    found = parse_places(strings, build_gazetteer(T.nation_registry(spark, sf)))
    keyed = strings.select("affiliate", F.unhex(F.md5("affiliate")).alias("aff_id"))
    return keyed.join(found, "aff_id").select("affiliate", "city", "country")


@query(f"""
    WITH suppliers AS ({S.SUPPLIERS}), paper_rows AS ({S.PAPER_ROWS}),
    strings AS (SELECT DISTINCT affiliate FROM paper_rows), {S.parts('strings')},
    {S.places('strings', 'SELECT city FROM suppliers', 'SELECT country FROM suppliers')}
    SELECT affiliate, coalesce(extracted, '') AS extracted, coalesce(country, '') AS country, coalesce(city, '') AS city
    FROM strings LEFT JOIN best USING (affiliate) LEFT JOIN places USING (affiliate)
""")
def city_country_institute(spark, sf):
    strings = materialize(T.paper_rows(spark, sf).select("affiliate").distinct(), "strings")
    gazetteer = build_gazetteer(T.registry(T.suppliers(spark, sf)))
    return describe_strings(strings, gazetteer, T.scorer(spark, sf))


def _labelled_segments(spark, sf):
    """Parts of customer strings; the first part of a string is the institute."""
    parts = segments(T.customer_strings(spark, sf).select("affiliate").distinct())
    return parts.select("segment", (F.col("pos") == 0).cast("double").alias("label")).distinct()


@query(f"WITH {_CUSTOMERS}, {S.parts('strings')} SELECT DISTINCT segment, pos = 0 AS institute FROM parts")
def ml_scores(spark, sf):
    """What a fitted model takes for institutes. The labels can be told apart, so it has to agree with all of them."""
    labelled = materialize(_labelled_segments(spark, sf), "labelled")
    model = fit_segment_model(labelled)
    scored = model_scorer(model)(labelled.select("segment").distinct())
    return scored.select("segment", (F.col("prob") > 0.5).alias("institute"))


@query(f"""
    WITH {_CUSTOMERS}, {S.parts('strings')}
    SELECT pos, CAST(pos = 0 AS DOUBLE) AS prediction, count(*) AS n FROM parts GROUP BY pos
""")
def fit_parts_scorer(spark, sf):
    """A model fitted on the distinct parts, and what it says of every part of every string."""
    model = fit_segment_model(materialize(_labelled_segments(spark, sf), "labelled"), iterations=10)
    parts = segments(T.customer_strings(spark, sf).select("affiliate").distinct())
    judged = model.transform(parts).select(F.col("pos").cast("long").alias("pos"), "prediction")
    return judged.groupBy("pos", "prediction").agg(F.count("*").alias("n"))


@query()
def fit_scorer(spark, sf):
    """Quality model on labelled documents, and how often it agrees with the labels. Not always, hence without SQL."""
    documents = T.table(spark, sf, "documents").select("doc_id", clean(F.col("text")).alias("segment"))
    labelled = materialize(
        documents.join(T.table(spark, sf, "labels"), "doc_id")
        .select("doc_id", "segment", F.col("quality").cast("double").alias("label")),
        "labelled",
    )
    model = fit_segment_model(labelled, iterations=5)
    scored = model.transform(labelled).select("label", "prediction")
    return scored.groupBy("label", "prediction").agg(F.count("*").alias("n"))
