"""Pieces of SQL that the oracles share. Every one is written from the definitions, not from the Spark plans."""

from __future__ import annotations


def clean(c: str) -> str:
    return f"trim(lower(regexp_replace({c}, '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g')))"


_SPACE = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"


def normalize(c: str) -> str:
    return f"regexp_replace(replace({c}, chr(10), ''), '^{_SPACE}+|{_SPACE}+\\z', '', 'g')"


def words(c: str) -> str:
    return f"[w for w in string_split({clean(c)}, ' ') if w <> '']"


def letters(c: str) -> str:
    """Digits as letters, so that place names keep apart when digits are deleted."""
    return f"translate({c}, '0123456789', 'abcdefghij')"


TITLES = r"SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title FROM pages"

METADATA = """
    SELECT CAST(d.doc_id AS VARCHAR) AS cord_uid, d.lang AS source_x, CAST(NULL AS VARCHAR) AS sha,
           'd/' || d.doc_id AS doi, d.source AS license,
           CASE WHEN l.quality = 1 THEN 'PMC' || d.doc_id END AS pmcid,
           CASE WHEN l.toxic = 1 OR l.quality = 0 THEN d.doc_id || '.0' END AS pubmed_id
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""

# An earlier collection: some papers with a list, some with an empty one, some without.
PRIOR = """
    SELECT CAST(doc_id AS VARCHAR) AS cord_uid,
           CASE WHEN toxic = 1 THEN NULL WHEN quality = 1 THEN ['prior ' || doc_id, 'shared'] ELSE [] END AS affiliate
    FROM labels
"""

CUSTOMER_STRINGS = f"""
    SELECT c.c_custkey, c.c_mktsegment, c.c_name, {letters('n.n_name')} AS city, r.r_name,
           c.c_name || ',' || {letters('n.n_name')} || ',' || r.r_name AS affiliate
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
"""

SUPPLIERS = f"""
    SELECT CAST(s.s_suppkey AS VARCHAR) AS id, s.s_suppkey, s.s_name AS name, {letters('n.n_name')} AS city,
           r.r_name AS country, s.s_acctbal, n.n_nationkey
    FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
"""

PAPER_ROWS = """
    SELECT DISTINCT CAST(l.l_orderkey AS VARCHAR) AS cord_uid,
           s.name || ',' || s.city || ',' || s.country || ',' || l.l_linestatus AS affiliate
    FROM lineitem l JOIN suppliers s ON l.l_suppkey = s.s_suppkey
"""

# Token weights: names of firms speak for an institute, names of regions against.
LEXICON = f"""
    SELECT DISTINCT unnest({words("split_part(s_name, '#', 1)")}) AS token, 4.0::DOUBLE AS weight FROM supplier
    UNION ALL SELECT DISTINCT unnest({words("split_part(c_name, '#', 1)")}), 3.0::DOUBLE FROM customer
    UNION ALL SELECT DISTINCT unnest({words('r_name')}), -1.5::DOUBLE FROM region
"""
BIAS = -2.0


def tfidf(source: str, key: str, text: str) -> str:
    """CTEs ending in ``weights(key, term, w)`` and ``bags(key, bag)``; one row of ``source`` is one document."""
    return f"""
    terms AS (SELECT {key}, unnest(string_split({clean(text)}, ' ')) AS term FROM {source}),
    tf AS (SELECT {key}, term, count(*) AS tf FROM terms WHERE length(term) >= 2 GROUP BY ALL),
    bags AS (SELECT {key}, string_agg(term, ' ' ORDER BY term) AS bag FROM terms WHERE length(term) >= 2 GROUP BY ALL),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
    raw AS (SELECT {key}, term, tf * (ln((1 + (SELECT count(*) FROM {source})::DOUBLE) / (1 + df)) + 1) AS x
            FROM tf JOIN df USING (term)),
    norms AS (SELECT {key}, sqrt(sum(x * x)) AS norm FROM raw GROUP BY {key}),
    weights AS (SELECT {key}, term, x / norm AS w FROM raw JOIN norms USING ({key}))"""


def search(registry: str, queries: str, prefix: str = "s") -> str:
    """CTEs ending in ``{prefix}_hits(qid, id, score, rank)``.

    ``registry`` has ``id, field, txt`` rows; ``queries`` has ``qid, institute, country, city``.
    """
    p = prefix
    return f"""
    {p}_fields AS (SELECT id, field, {words('txt')} AS terms FROM {registry}),
    {p}_stats AS (SELECT field, count(*) AS n, avg(len(terms)) AS avgl FROM {p}_fields WHERE len(terms) > 0 GROUP BY field),
    {p}_tf AS (SELECT field, id, l, tok, count(*) AS tf FROM
        (SELECT field, id, len(terms) AS l, unnest(terms) AS tok FROM {p}_fields) GROUP BY ALL),
    {p}_df AS (SELECT field, tok, count(*) AS df FROM {p}_tf GROUP BY ALL),
    {p}_imp AS (SELECT field, tok, id,
        ln(1 + (n - df + 0.5) / (df + 0.5)) * 2.2 * tf / (tf + 1.2 * (0.25 + 0.75 * l / avgl)) AS impact
        FROM {p}_tf JOIN {p}_df USING (field, tok) JOIN {p}_stats USING (field)),
    {p}_qtok AS (
        SELECT qid, 'institute' AS clause, unnest({words('institute')}) AS tok FROM {queries} WHERE institute <> ''
        UNION ALL SELECT qid, 'country', unnest({words('country')}) FROM {queries} WHERE institute <> ''
        UNION ALL SELECT qid, 'city', unnest({words('city')}) FROM {queries} WHERE institute <> ''),
    {p}_q AS (SELECT qid, clause, tok, count(*) AS qtf FROM {p}_qtok GROUP BY ALL),
    {p}_need AS (SELECT qid, clause, count(*) AS need FROM {p}_q GROUP BY ALL),
    {p}_clauses(clause, field) AS (VALUES ('institute', 'name'), ('institute', 'aliases'), ('institute', 'acronyms'),
        ('country', 'country'), ('country', 'country_code'), ('city', 'city')),
    {p}_part AS (SELECT q.qid, q.clause, i.id, i.field, sum(qtf * impact) AS sc, count(*) AS got
        FROM {p}_q q JOIN {p}_clauses c USING (clause) JOIN {p}_imp i ON i.tok = q.tok AND i.field = c.field
        GROUP BY ALL),
    {p}_clause AS (SELECT p.qid, p.clause, p.id, max(p.sc) AS sc
        FROM {p}_part p JOIN {p}_need n ON p.qid = n.qid AND p.clause = n.clause
        WHERE p.clause = 'institute' OR got = need GROUP BY ALL),
    {p}_must AS (SELECT qid, (country <> '')::INT + (city <> '')::INT AS must FROM {queries}),
    {p}_score AS (SELECT c.qid, c.id, sum(c.sc) AS score
        FROM {p}_clause c JOIN {p}_must m ON c.qid = m.qid
        GROUP BY c.qid, c.id, m.must HAVING count(*) FILTER (WHERE c.clause <> 'institute') = m.must),
    {p}_hits AS (SELECT qid, id, score, rank FROM (
        SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 6) DESC, id) AS rank FROM {p}_score)
        WHERE rank <= 20)"""


def registry_rows(table: str, **fields: str) -> str:
    """``id, field, txt`` rows of a registry table; each keyword gives a field's expression."""
    return " UNION ALL ".join(f"SELECT id, '{f}' AS field, {c} AS txt FROM {table}" for f, c in fields.items())


def parts(strings: str) -> str:
    """CTEs ``parts(affiliate, pos, segment)`` and ``probs(segment, prob)`` under the lexicon."""
    return f"""
    cut AS (SELECT affiliate, string_split(affiliate, ',') AS l FROM {strings}),
    numbered AS (SELECT affiliate, unnest(range(len(l))) AS pos, unnest(l) AS part FROM cut),
    parts AS (SELECT affiliate, pos, {clean("trim(part, ' ')")} AS segment FROM numbered),
    ptok AS (SELECT segment, unnest({words('segment')}) AS token FROM (SELECT DISTINCT segment FROM parts)),
    lexicon AS ({LEXICON}),
    sums AS (SELECT segment, sum(weight) AS z FROM ptok JOIN lexicon USING (token) GROUP BY segment),
    probs AS (SELECT d.segment, 1 / (1 + exp(-({BIAS} + coalesce(z, 0)))) AS prob
              FROM (SELECT DISTINCT segment FROM parts) d LEFT JOIN sums USING (segment)),
    likely AS (SELECT affiliate, segment, row_number() OVER (PARTITION BY affiliate ORDER BY prob DESC, pos) AS rk
               FROM parts JOIN probs USING (segment) WHERE prob > 0.1),
    best AS (SELECT affiliate, segment AS extracted FROM likely WHERE rk = 1)"""


def places(strings: str, cities: str, countries: str) -> str:
    """CTE ``places(affiliate, city, country)`` from one-column selects of known names."""
    return f"""
    gaz AS (SELECT DISTINCT {clean('name')} AS name, kind FROM (
        SELECT name, 'city' AS kind FROM ({cities}) a(name) UNION ALL
        SELECT name, 'country' FROM ({countries}) b(name))),
    gsize AS (SELECT max(len(string_split(name, ' '))) AS longest FROM gaz),
    gtok AS (SELECT affiliate, {words('affiliate')} AS w FROM {strings}),
    gpos AS (SELECT affiliate, w, unnest(range(len(w))) AS pos FROM gtok),
    glen AS (SELECT affiliate, w, pos, unnest(range(1, longest + 1)) AS n FROM gpos, gsize),
    gram AS (SELECT affiliate, pos, n, array_to_string(list_slice(w, pos + 1, pos + n), ' ') AS name
             FROM glen WHERE pos + n <= len(w)),
    seen AS (SELECT affiliate, kind, name,
             row_number() OVER (PARTITION BY affiliate, kind ORDER BY n DESC, pos DESC) AS rk
             FROM gram JOIN gaz USING (name)),
    places AS (SELECT affiliate,
               max(regexp_replace(name, '\\p{{Nd}}+', '', 'g')) FILTER (WHERE kind = 'city') AS city,
               max(name) FILTER (WHERE kind = 'country') AS country
               FROM seen WHERE rk = 1 GROUP BY affiliate)"""
