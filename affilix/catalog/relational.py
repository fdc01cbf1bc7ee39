"""Queries on text expressions, routing, diffs, unions and sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from affilix import schemas
from affilix.catalog import sql as S
from affilix.catalog import tables as T
from affilix.catalog.register import query
from affilix.functions.address import canonical_country, invert_map, label_value
from affilix.functions.text import clean, join_commas, normalize, split_commas, strip_digits
from affilix.operators.extraction import archive_id, numeric_id, xml_request, xml_tag
from affilix.operators.incremental import (
    affiliation_rows, diff_papers, diff_strings, distinct_affiliations, union_all,
)
from affilix.operators.routing import OTHERS, has_archive_id, route, route_counts
from affilix.session import scratch_path
from affilix.sources.readers import read_collected, read_csv, read_optional, read_registry
from affilix.sources.writers import read_latest, write_csv, write_run


@query(f"SELECT doc_id, {S.clean('text')} AS cleaned, {S.normalize('text')} AS normalized FROM documents")
def clean_text(spark, sf):
    text = F.col("text")
    return T.table(spark, sf, "documents").select(
        "doc_id", clean(text).alias("cleaned"), normalize(text).alias("normalized")
    )


@query(f"""
    SELECT DISTINCT affiliate FROM (SELECT {S.normalize('line')} AS affiliate FROM
        (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)) WHERE affiliate <> ''
""")
def explode_distinct(spark, sf):
    papers = T.table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("cord_uid"), F.split("text", "\n", -1).alias("affiliate")
    )
    return distinct_affiliations(affiliation_rows(papers))


@query(f"""
    WITH strings AS ({S.CUSTOMER_STRINGS}),
    cut AS (SELECT c_custkey, string_split(affiliate, ',') AS l FROM strings)
    SELECT c_custkey, unnest(range(len(l)))::INT AS pos, trim(unnest(l), ' ') AS part FROM cut
""")
def split_segments(spark, sf):
    return T.customer_strings(spark, sf).select(
        "c_custkey", F.posexplode(split_commas(F.col("affiliate"))).alias("pos", "part")
    )


@query("""
    SELECT c_custkey, c_name || ',' || n_name || ',' || r_name AS affiliate FROM customer
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def concat_affiliation(spark, sf):
    customer, nation, region = (T.table(spark, sf, n) for n in ("customer", "nation", "region"))
    return (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select("c_custkey", join_commas(F.col("c_name"), F.col("n_name"), F.col("r_name")).alias("affiliate"))
    )


@query(r"""SELECT c_custkey, regexp_replace(c_name, '\p{Nd}+', '', 'g') AS stripped FROM customer""")
def digit_stripping(spark, sf):
    return T.table(spark, sf, "customer").select("c_custkey", strip_digits(F.col("c_name")).alias("stripped"))


@query("""
    SELECT c_custkey, CASE lower(c_mktsegment) WHEN 'building' THEN 'construction' WHEN 'machinery' THEN 'engines'
        ELSE lower(c_mktsegment) END AS renamed, lower(c_mktsegment) AS kept FROM customer
""")
def canonical_names(spark, sf):
    name = F.lower("c_mktsegment")
    return T.table(spark, sf, "customer").select(
        "c_custkey",
        canonical_country(name, {"building": "construction", "machinery": "engines"}).alias("renamed"),
        canonical_country(name).alias("kept"),
    )


_ROUTED = f"""
    WITH meta AS ({S.METADATA}), free AS (SELECT * FROM meta WHERE pmcid IS NULL AND pubmed_id IS NULL),
    routed AS (
        SELECT *, 'pmc' AS route FROM meta WHERE pmcid IS NOT NULL OR pubmed_id IS NOT NULL
        UNION ALL SELECT *, 'elsevier' FROM free WHERE regexp_matches(license, '1')
        UNION ALL SELECT *, 'medr' FROM free WHERE regexp_matches(license, '2')
        UNION ALL SELECT *, 'bior' FROM free WHERE regexp_matches(license, '5|7')
        UNION ALL SELECT *, 'others' FROM free WHERE regexp_matches(license, '3'))
"""


@query(_ROUTED + "SELECT cord_uid, license, route FROM routed")
def route_rules(spark, sf):
    return route(T.metadata(spark, sf), T.RULES).select("cord_uid", "license", "route")


@query(_ROUTED + """
    SELECT route, count(*) AS n FROM routed GROUP BY route
    UNION ALL SELECT 'unrouted', count(*) FROM meta WHERE cord_uid NOT IN (SELECT cord_uid FROM routed)
""")
def route_report(spark, sf):
    return route_counts(T.metadata(spark, sf), T.RULES)


@query(_ROUTED + "SELECT cord_uid, 0::INT AS n_affiliations FROM routed WHERE route = 'others'")
def empty_list_default(spark, sf):
    others = route(T.metadata(spark, sf), T.RULES).filter(F.col("route") == OTHERS)
    return others.withColumn("affiliate", T.no_list()).select("cord_uid", F.size("affiliate").alias("n_affiliations"))


@query(f"""
    WITH meta AS ({S.METADATA})
    SELECT cord_uid, pmcid IS NOT NULL OR pubmed_id IS NOT NULL AS has_id, regexp_matches(license, '1') AS first_rule,
        regexp_replace(pmcid, '^[PMC]+', '') AS archive_id,
        CAST(TRY_CAST(pubmed_id AS DOUBLE) AS BIGINT) AS citation_id,
        CASE WHEN pmcid IS NULL THEN 'Affiliation' ELSE 'aff' END AS tag,
        coalesce(regexp_replace(pmcid, '^[PMC]+', ''), CAST(CAST(TRY_CAST(pubmed_id AS DOUBLE) AS BIGINT) AS VARCHAR))
            AS stored_under
    FROM meta
""")
def canonical_ids(spark, sf):
    return T.metadata(spark, sf).select(
        "cord_uid", has_archive_id().alias("has_id"), F.col("license").rlike("1").alias("first_rule"),
        archive_id(F.col("pmcid")).alias("archive_id"), numeric_id(F.col("pubmed_id")).alias("citation_id"),
        xml_tag().alias("tag"), xml_request().alias("stored_under"),
    )


@query(f"""
    WITH meta AS ({S.METADATA}), prior AS ({S.PRIOR})
    SELECT m.cord_uid, m.doi, m.license, p.affiliate IS NOT NULL AS done, len(p.affiliate)::INT AS n_affiliations
    FROM meta m LEFT JOIN prior p ON m.cord_uid = p.cord_uid
""")
def paper_diff(spark, sf):
    diff = diff_papers(T.metadata(spark, sf), T.prior(spark, sf))
    both = diff.done.withColumn("done", F.lit(True)).unionByName(diff.todo.withColumn("done", F.lit(False)))
    return both.select(
        "cord_uid", "doi", "license", "done",
        F.when(F.col("affiliate").isNotNull(), F.size("affiliate")).alias("n_affiliations"),
    )


@query(f"""
    WITH meta AS ({S.METADATA}), prior AS ({S.PRIOR}),
    guard AS (SELECT (SELECT count(*) FROM prior) > 0
              AND (SELECT count(*) FROM prior) >= (SELECT count(*) FROM meta) AS covered)
    SELECT cord_uid, true AS done FROM prior, guard WHERE covered
    UNION ALL SELECT m.cord_uid, p.affiliate IS NOT NULL FROM meta m LEFT JOIN prior p ON m.cord_uid = p.cord_uid, guard
    WHERE NOT covered
""")
def guarded_diff(spark, sf):
    diff = diff_papers(T.metadata(spark, sf), T.prior(spark, sf), skip_if_prior_larger=True)
    return diff.done.select("cord_uid", F.lit(True).alias("done")).unionByName(
        diff.todo.select("cord_uid", F.lit(False).alias("done"))
    )


def _string_cache(spark, sf):
    """Strings of three market segments: resolved, searched in vain, and never searched."""
    strings = T.customer_strings(spark, sf)
    segment = F.col("c_mktsegment")
    known = F.when(segment == "BUILDING", F.col("c_name")).when(segment == "MACHINERY", F.lit(schemas.NOT_FOUND))
    text, number = F.lit(None).cast("string"), F.lit(None).cast("double")
    return strings.filter(segment.isin("BUILDING", "MACHINERY", "FURNITURE")).select(
        "affiliate", known.alias("grid_id"), F.lit(None).cast("bigint").alias("geonames_city_id"),
        text.alias("institute_name"), number.alias("lat"), number.alias("lng"), "city", text.alias("state"),
        text.alias("state_code"), F.col("r_name").alias("country"),
    )


_STRING_DIFF = f"""
    WITH strings AS ({S.CUSTOMER_STRINGS}),
    cache AS (SELECT affiliate, CASE c_mktsegment WHEN 'BUILDING' THEN c_name WHEN 'MACHINERY' THEN 'not found' END
              AS grid_id FROM strings WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE'))
    SELECT s.affiliate, c.grid_id FROM (SELECT DISTINCT affiliate FROM strings) s LEFT JOIN cache c USING (affiliate)
"""


@query(_STRING_DIFF)
def string_diff(spark, sf):
    strings = T.customer_strings(spark, sf).select("affiliate").distinct()
    diff = diff_strings(strings, _string_cache(spark, sf))
    return diff.done.select("affiliate", "grid_id").unionByName(
        diff.todo.select("affiliate", F.lit(None).cast("string").alias("grid_id"))
    )


@query("SELECT doc_id, text, lang, source, n_chars, NULL::BIGINT AS item_id FROM documents "
       "UNION ALL SELECT NULL, text, NULL, NULL, NULL, item_id FROM benchmark")
def union_missing_cols(spark, sf):
    return union_all(T.table(spark, sf, "documents"), T.table(spark, sf, "benchmark"))


@query("""
    SELECT c_custkey, c_mktsegment AS value, 'second segment' AS label, '' AS missing FROM customer
    UNION ALL SELECT c_custkey, n_name, 'nation', '' FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def inverted_map(spark, sf):
    customer, nation = T.table(spark, sf, "customer"), T.table(spark, sf, "nation")
    labels = F.create_map(
        F.lit("segment"), F.col("c_mktsegment"), F.lit("nation"), F.col("n_name"),
        F.lit("second segment"), F.col("c_mktsegment"),
    )
    return (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .select("c_custkey", invert_map(labels).alias("m"))
        .select("c_custkey", F.explode("m").alias("value", "label"), label_value(F.col("m"), "city").alias("missing"))
    )


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_round_trip(spark, sf):
    documents = T.table(spark, sf, "documents")
    path = scratch_path(spark, "documents_csv")
    write_csv(documents, path)
    return read_csv(spark, path, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT")


@query(f"""
    WITH prior AS ({S.PRIOR})
    SELECT cord_uid, array_to_string(affiliate, '|') AS affiliations, len(affiliate)::INT AS n FROM prior
""")
def list_round_trip(spark, sf):
    path = f"{scratch_path(spark, 'collected')}.csv"
    write_csv(T.prior(spark, sf), path)
    back = read_collected(spark, path)
    n = F.when(F.col("affiliate").isNotNull(), F.size("affiliate"))
    return back.select("cord_uid", F.array_join("affiliate", "|").alias("affiliations"), n.alias("n"))


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def parquet_round_trip(spark, sf):
    path = scratch_path(spark, "customers")
    write_run(T.table(spark, sf, "customer"), path)
    return read_latest(spark, path, "c_custkey BIGINT, c_name STRING, c_mktsegment STRING")


@query("""
    SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, p_type || ' ' || p_name || '|' || p_brand AS aliases,
        p_brand AS city, p_type AS country, substr(p_type, 1, 3) AS country_code FROM part
""")
def registry_json_read(spark, sf):
    path = scratch_path(spark, "registry")
    whole = T.part_registry(spark, sf).select(
        F.to_json(F.struct(F.array(F.struct(*T.part_registry(spark, sf).columns)).alias("institutes"))).alias("value")
    )
    whole.write.text(path)
    return read_registry(spark, path, multi_line=False).select(
        "id", "name", F.array_join("aliases", "|").alias("aliases"), F.explode("addresses").alias("a")
    ).select("id", "name", "aliases", "a.city", "a.country", "a.country_code")


@query(f"WITH meta AS ({S.METADATA}) SELECT cord_uid, doi FROM meta")
def optional_input(spark, sf):
    prev = read_optional(spark, scratch_path(spark, "absent"), read_collected)
    return diff_papers(T.metadata(spark, sf), prev).todo.select("cord_uid", "doi")


@query("""
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'caf' || chr(233) || chr(160) || c_name ELSE c_name END AS first_item,
        'O''Neil, ' || n_name AS second_item, 2::INT AS n
    FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def literal_decode(spark, sf):
    from affilix.functions.literals import decode_list

    customer, nation = T.table(spark, sf, "customer"), T.table(spark, sf, "nation")
    first = F.when(F.col("c_acctbal") < 0, F.concat(F.lit("caf\\xe9\\xa0"), F.col("c_name"))).otherwise(F.col("c_name"))
    cell = F.concat(F.lit("['"), first, F.lit("', \"O'Neil, "), F.col("n_name"), F.lit('"]'))
    return (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .select("c_custkey", decode_list(cell).alias("l"))
        .select("c_custkey", F.try_element_at("l", F.lit(1)).alias("first_item"),
                F.try_element_at("l", F.lit(2)).alias("second_item"), F.size("l").alias("n"))
    )
