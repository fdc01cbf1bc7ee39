"""Queries on extraction from payloads and on the two jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from affilix.catalog import sql as S
from affilix.catalog import tables as T
from affilix.catalog.register import ORACLES, query
from affilix.functions.markup import extract_items, plain_text
from affilix.operators.extraction import extract, html_addresses, json_affiliations, xml_affiliations, yield_report
from affilix.plans.collect import collect
from affilix.plans.resolve import attach_cached, resolve, resolve_in_runs
from affilix.session import dealt, scratch_path

_UL = r"(?s)<ul>(.*?)</ul>"
_LI = r"(?s)<li>(.*?)</li>"


@query(r"""
    WITH blocks AS (SELECT page_id, unnest(regexp_extract_all(html, '(?s)<ul>(.*?)</ul>', 1)) AS block FROM pages),
    items AS (SELECT page_id, unnest(regexp_extract_all(block, '(?s)<li>(.*?)</li>', 1)) AS item FROM blocks)
    SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(regexp_replace(item, '<[^>]*>', '', 'g'),
        '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g')) AS item, count(*) AS n
    FROM items GROUP BY ALL
""")
def html_list_extract(spark, sf):
    items = T.table(spark, sf, "pages").select("page_id", F.explode(extract_items(F.col("html"), _UL, _LI)).alias("item"))
    return items.groupBy("page_id", "item").agg(F.count("*").alias("n"))


def _each(rows, lists):
    return dealt(rows, "c_custkey", "c_name").select("c_custkey", F.posexplode(lists).alias("pos", "affiliation"))


@query(f"""
    WITH s AS ({S.CUSTOMER_STRINGS})
    SELECT c_custkey, 0::INT AS pos, c_name || ', ' || city || ' & ' || r_name AS affiliation FROM s
    UNION ALL SELECT c_custkey, 1, chr(201) || 'cole ' || c_mktsegment FROM s
""")
def html_address_extract(spark, sf):
    name, city, region, segment = (F.col(c) for c in ("c_name", "city", "r_name", "c_mktsegment"))
    body = F.concat(
        F.lit('<p><ol class="x"><li><address>no</address></li></ol><ol class="affiliation-list"><li><address><span>'),
        name, F.lit("</span>, <span>\n"), city, F.lit(" &amp;</span> "), region,
        F.lit("</address></li><li><address>&#201;cole <b>"), segment, F.lit("</b></address></li></ol>"),
    )
    return _each(T.customer_strings(spark, sf), html_addresses(body))


@query(f"""
    WITH s AS ({S.CUSTOMER_STRINGS})
    SELECT c_custkey, 0::INT AS pos, c_name AS affiliation FROM s
    UNION ALL SELECT c_custkey, 1, city || ' <' || r_name || '>' FROM s
""")
def html_part_extract(spark, sf):
    body = F.concat(
        F.lit("<ol class='affiliation-list'><li><address><span class=\"a\">"), F.col("c_name"),
        F.lit("</span>, outside<span>"), F.col("city"), F.lit(" &lt;"), F.col("r_name"), F.lit("&#x3e;</span></address></li></ol>"),
    )
    return _each(T.customer_strings(spark, sf), html_addresses(body, parts=True))


@query(f"""
    WITH s AS ({S.CUSTOMER_STRINGS})
    SELECT c_custkey, 0::INT AS pos, c_name || ',' || city || ',' AS affiliation FROM s WHERE c_mktsegment = 'BUILDING'
    UNION ALL SELECT c_custkey, 0, c_name || ',,' || r_name FROM s WHERE c_mktsegment = 'MACHINERY'
    UNION ALL SELECT c_custkey, 1, ',,' FROM s WHERE c_mktsegment = 'MACHINERY'
""")
def json_extract(spark, sf):
    segment = F.col("c_mktsegment")
    name, city, region = F.col("c_name").alias("affilname"), F.col("city").alias("affiliation-city"), F.col("r_name")
    one = F.to_json(F.struct(F.struct(name, city).alias("affiliation")))
    two = F.concat(
        F.lit('{"affiliation":['), F.to_json(F.struct(name, region.alias("affiliation-country"))), F.lit(",{}]}")
    )
    body = (
        F.when(segment == "BUILDING", one).when(segment == "MACHINERY", two)
        .when(segment == "FURNITURE", F.lit("{}")).otherwise(F.col("c_name"))
    )
    return _each(T.customer_strings(spark, sf), json_affiliations(body))


@query(f"""
    WITH s AS ({S.CUSTOMER_STRINGS})
    SELECT c_custkey, 0::INT AS pos, c_name || ', , ' || city AS affiliation FROM s WHERE c_mktsegment <> 'BUILDING'
    UNION ALL SELECT c_custkey, 1, r_name FROM s WHERE c_mktsegment <> 'BUILDING'
""")
def xml_extract(spark, sf):
    whole = F.concat(
        F.lit("<article><front><aff id='1'><label>1</label>"), F.col("c_name"), F.lit(", <b>X</b>, "), F.col("city"),
        F.lit("</aff></front><aff>"), F.col("r_name"), F.lit("</aff><Affiliation>no</Affiliation></article>"),
    )
    body = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("<article><aff>cut off")).otherwise(whole)
    return _each(T.customer_strings(spark, sf), xml_affiliations(body, F.lit("aff")))


# One stored payload per paper and provider. Short documents have a damaged one.
def _payloads(spark, sf):
    docs = T.table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    lang, source, size = F.col("lang"), F.col("source"), F.col("n_chars").cast("string")
    bodies = {
        "pmc": F.concat(F.lit("<r><aff><label>a</label>"), source, F.lit(", <i>x</i>"), lang, F.lit("</aff><aff>"), size,
                        F.lit("</aff></r>")),
        "elsevier": F.concat(F.lit('{"affiliation":{"affilname":"'), source, F.lit('","affiliation-country":"'), lang,
                             F.lit('"}}')),
        "medr": F.concat(F.lit('<ol class="affiliation-list"><li><address><span>'), source, F.lit("</span> <span>"), lang,
                         F.lit("</span></address></li></ol>")),
        "bior": F.concat(F.lit('<ol class="affiliation-list"><li><address><span>'), source, F.lit("</span> <span>"), lang,
                         F.lit("</span></address></li></ol>")),
    }
    stored = F.array(*[
        F.struct(
            F.lit(p).alias("provider"), F.lit(None).cast("string").alias("tag"),
            F.when(F.col("n_chars") < 400, F.lit("<damaged")).otherwise(b).alias("body"),
        )
        for p, b in bodies.items()
    ])
    return docs.select(F.col("doc_id").cast("string").alias("cord_uid"), F.explode(stored).alias("s")).select(
        "cord_uid", "s.provider", "s.tag", "s.body"
    )


_FOUND = """
    found AS (SELECT CAST(doc_id AS VARCHAR) AS cord_uid, provider, CASE WHEN n_chars < 400 THEN '' ELSE list END AS list,
            CASE WHEN n_chars < 400 THEN 0 ELSE n END AS n FROM (
        SELECT doc_id, n_chars, 'pmc' AS provider, source || ', ' || lang || '|' || n_chars AS list, 2 AS n FROM documents
        UNION ALL SELECT doc_id, n_chars, 'elsevier', source || ',,' || lang, 1 FROM documents
        UNION ALL SELECT doc_id, n_chars, 'medr', source || ' ' || lang, 1 FROM documents
        UNION ALL SELECT doc_id, n_chars, 'bior', source || '|' || lang, 2 FROM documents))
"""


@query(f"""
    WITH {_FOUND} SELECT provider, count(*) AS payloads, count(*) FILTER (WHERE n = 0) AS without,
        CAST(sum(n) AS BIGINT) AS affiliations FROM found GROUP BY provider
""")
def extraction_yield(spark, sf):
    return yield_report(extract(_payloads(spark, sf)))


@query(f"""
    WITH meta AS ({S.METADATA}), prior AS ({S.PRIOR}), {_FOUND},
    joined AS (SELECT m.*, p.affiliate FROM meta m LEFT JOIN prior p ON m.cord_uid = p.cord_uid),
    todo AS (SELECT * FROM joined WHERE affiliate IS NULL),
    free AS (SELECT * FROM todo WHERE pmcid IS NULL AND pubmed_id IS NULL),
    routed AS (
        SELECT *, 'pmc' AS route FROM todo WHERE pmcid IS NOT NULL OR pubmed_id IS NOT NULL
        UNION ALL SELECT *, 'elsevier' FROM free WHERE license LIKE '%1%'
        UNION ALL SELECT *, 'medr' FROM free WHERE license LIKE '%2%'
        UNION ALL SELECT *, 'bior' FROM free WHERE license LIKE '%5%' OR license LIKE '%7%'
        UNION ALL SELECT *, 'others' FROM free WHERE license LIKE '%3%')
    SELECT cord_uid, doi, license, array_to_string(affiliate, '|') AS affiliations, len(affiliate)::INT AS n
    FROM joined WHERE affiliate IS NOT NULL
    UNION ALL SELECT cord_uid, doi, license, list, f.n::INT FROM routed r JOIN found f USING (cord_uid)
        WHERE r.route = f.provider
    UNION ALL SELECT cord_uid, doi, license, '', 0 FROM routed WHERE route = 'others'
""")
def collect_job(spark, sf):
    out = collect(T.metadata(spark, sf), _payloads(spark, sf), T.prior(spark, sf), rules=T.RULES)
    return out.select(
        "cord_uid", "doi", "license", F.array_join("affiliate", "|").alias("affiliations"), F.size("affiliate").alias("n")
    )


_RESULT = """cord_uid, affiliate, grid_id, n_nationkey::BIGINT AS geonames_city_id, name AS institute_name,
    s_acctbal AS lat, -s_acctbal AS lng, city, CAST(NULL AS VARCHAR) AS state, CAST(NULL AS VARCHAR) AS state_code, country"""


@query(f"""
    WITH suppliers AS ({S.SUPPLIERS}), paper_rows AS ({S.PAPER_ROWS})
    SELECT {_RESULT} FROM (
        SELECT p.cord_uid, p.affiliate, s.id AS grid_id, s.* FROM paper_rows p LEFT JOIN suppliers s
        ON p.affiliate = s.name || ',' || s.city || ',' || s.country || ',O')
""")
def attach_known(spark, sf):
    """Strings of open lines are known from before, all others are not."""
    known = F.concat_ws(",", "institute_name", "city", "country", F.lit("O")).alias("affiliate")
    cache = T.supplier_addresses(spark, sf).select(known, "*")
    return attach_cached(T.papers(spark, sf), cache)


@query(f"""
    WITH suppliers AS ({S.SUPPLIERS}), paper_rows AS ({S.PAPER_ROWS}),
    strings AS (SELECT DISTINCT affiliate FROM paper_rows WHERE affiliate <> ''),
    {S.parts('strings')}, {S.places('strings', 'SELECT city FROM suppliers', 'SELECT country FROM suppliers')},
    described AS (SELECT affiliate, coalesce(extracted, '') AS institute, coalesce(country, '') AS country,
        coalesce(city, '') AS city FROM strings LEFT JOIN best USING (affiliate) LEFT JOIN places USING (affiliate)),
    asked AS (SELECT *, institute || '/' || country || '/' || city AS qid FROM described),
    q AS (SELECT DISTINCT qid, institute, country, city FROM asked),
    rows AS ({S.registry_rows('suppliers', name='name', country='country', city='city')}),
    {S.search('rows', 'q')}, {S.tfidf('strings', 'affiliate', 'affiliate')},
    near AS (SELECT a.affiliate, b.affiliate AS neighbour FROM weights a JOIN weights b USING (term)
             GROUP BY ALL HAVING round(sum(a.w * b.w), 9) > 0.65),
    votes AS (SELECT n.affiliate, h.id, sum(h.score) AS votes FROM near n JOIN asked a ON a.affiliate = n.neighbour
              JOIN s_hits h USING (qid) GROUP BY ALL),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY affiliate ORDER BY round(votes, 6) DESC, id DESC) AS rk FROM votes),
    resolved AS (SELECT s.affiliate, coalesce(r.id, 'not found') AS grid_id
                 FROM strings s LEFT JOIN ranked r ON s.affiliate = r.affiliate AND rk = 1)
    SELECT {_RESULT} FROM (
        SELECT p.cord_uid, p.affiliate, r.grid_id, s.* FROM paper_rows p LEFT JOIN resolved r USING (affiliate)
        LEFT JOIN suppliers s ON s.id = r.grid_id)
""")
def resolve_e2e(spark, sf):
    institutes = T.registry(T.suppliers(spark, sf))
    return resolve(T.papers(spark, sf), institutes, T.supplier_addresses(spark, sf), T.scorer(spark, sf))


@query(ORACLES["resolve_e2e"])
def resolve_two_runs(spark, sf):
    """resolve_e2e in two runs: papers of even and of odd checksum, the second run with the state of the first."""
    institutes = T.registry(T.suppliers(spark, sf))
    papers, addresses, scorer = T.papers(spark, sf), T.supplier_addresses(spark, sf), T.scorer(spark, sf)
    even = F.crc32(F.col("cord_uid").cast("binary")) % 2 == 0
    state = scratch_path(spark, "resolve_state")
    resolve_in_runs(papers.filter(even), institutes, addresses, scorer, save_state=state)
    return resolve_in_runs(papers.filter(~even), institutes, addresses, scorer, state=state)


@query("""
    SELECT CAST(doc_id AS VARCHAR) AS cord_uid, CASE WHEN quality = 1 THEN 'A ' || source ELSE 'B ' || lang END AS list
    FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL OR toxic = 1
""")
def xml_choice(spark, sf):
    """Papers with an article and a citation stored: the id space decides which is read."""
    docs = T.table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("cord_uid"), "source", "lang")
    article = F.concat(F.lit("<r><aff>A "), F.col("source"), F.lit("</aff><Affiliation>no</Affiliation></r>"))
    citation = F.concat(F.lit("<r><Affiliation>B "), F.col("lang"), F.lit("</Affiliation><aff>no</aff></r>"))
    both = F.array(
        F.struct(F.lit("aff").alias("tag"), article.alias("body")),
        F.struct(F.lit("Affiliation").alias("tag"), citation.alias("body")),
    )
    payloads = docs.select("cord_uid", F.lit("pmc").alias("provider"), F.inline(both))
    found = collect(T.metadata(spark, sf), payloads).filter(F.size("affiliate") > 0)
    return found.select("cord_uid", F.array_join("affiliate", "|").alias("list"))


@query("""
    SELECT page_id, 'O''Neil, Gda' || chr(324) || 'sk ' || chr(8211) || ' a b ' || chr(321) || chr(243) || 'd & &lt; '
        || page_id AS text FROM pages
""")
def html_references(spark, sf):
    """References of HTML 5, of Windows-1252 numbers and of doubly escaped text; a line break parts words."""
    markup = "<span>O&apos;Neil, Gda&nacute;sk &#150; a<br>b&nbsp;&Lstrok;&oacute;d &amp; &amp;lt; "
    return T.table(spark, sf, "pages").select(
        "page_id", plain_text(F.concat(F.lit(markup), F.col("page_id"), F.lit("</span>"))).alias("text")
    )
