from pyspark.sql import functions as F

from affilix import collect, schemas
from affilix.catalog import QUERIES
from affilix.operators.extraction import extract, html_addresses, json_affiliations, numeric_id, archive_id, xml_affiliations
from affilix.operators.incremental import diff_papers, diff_strings, union_all
from affilix.operators.routing import route, route_counts
from affilix.session import scratch_path
from affilix.sources.readers import read_cache, read_collected, read_metadata, read_optional, read_registry
from affilix.sources.writers import read_latest, write_csv, write_run


def meta(spark, *rows):
    """``cord_uid, license, pmcid, pubmed_id``"""
    full = [(u, "src", None, "d" + u, lic, pmc, pub) for u, lic, pmc, pub in rows]
    return spark.createDataFrame(full, schemas.METADATA)


def collected(spark, *rows):
    return spark.createDataFrame([(u, None, None, None, a, None, None, None) for u, a in rows], schemas.COLLECTED)


def test_routes(spark):
    papers = meta(
        spark, ("a", "els-covid", None, "1"), ("b", "els-bio", None, None), ("c", "ELS", None, None),
        ("d", "arxiv", None, None), ("e", "cc-by", None, None), ("f", None, None, None), ("g", "medrxiv", "PMC1", None),
    )
    got = sorted((r.cord_uid, r.route) for r in route(papers).collect())
    assert got == [("a", "pmc"), ("b", "bior"), ("b", "elsevier"), ("d", "others"), ("g", "pmc")]
    assert {r.route: r.n for r in route_counts(papers).collect()} == {
        "pmc": 2, "bior": 1, "elsevier": 1, "others": 1, "unrouted": 3,
    }


def test_paper_diff_keeps_null_and_empty_apart(spark):
    papers = meta(spark, *[(u, "x", None, None) for u in "abcd"])
    diff = diff_papers(papers, collected(spark, ("a", []), ("b", None), ("c", ["x"]), ("c", ["y"])))
    assert sorted((r.cord_uid, r.affiliate) for r in diff.done.collect()) == [("a", []), ("c", ["x"]), ("c", ["y"])]
    assert sorted(r.cord_uid for r in diff.todo.collect()) == ["b", "d"]
    assert diff.done.columns == schemas.COLLECTED_COLUMNS


def test_paper_diff_without_prior(spark):
    diff = diff_papers(meta(spark, ("a", "x", None, None)), None)
    assert diff.done.count() == 0 and diff.todo.count() == 1


def test_row_count_guard(spark):
    papers = meta(spark, *[(u, "x", None, None) for u in "abc"])
    prior = collected(spark, ("x", ["1"]), ("y", ["2"]), ("z", []))
    diff = diff_papers(papers, prior, skip_if_prior_larger=True)
    assert diff.todo.count() == 0 and diff.done.count() == 3
    assert diff_papers(papers, prior).todo.count() == 3
    assert diff_papers(papers, prior.limit(0), skip_if_prior_larger=True).todo.count() == 3


def test_string_diff(spark):
    cache = spark.createDataFrame(
        [("a", "g1"), ("b", "not found"), ("c", None)], "affiliate STRING, grid_id STRING"
    )
    strings = spark.createDataFrame([(s,) for s in "abcd"], "affiliate STRING")
    diff = diff_strings(strings, cache)
    assert sorted(r.affiliate for r in diff.done.collect()) == ["a", "b"]
    assert sorted(r.affiliate for r in diff.todo.collect()) == ["c", "d"]


def test_union_by_name(spark):
    out = union_all(spark.sql("SELECT 1 a, 2 b"), spark.sql("SELECT 3 c, 4 a"))
    assert sorted(map(tuple, out.select("a", "b", "c").collect())) == [(1, 2, None), (4, None, 3)]


def one(spark, body, function):
    return spark.createDataFrame([(body,)], "b STRING").select(function(F.col("b"))).first()[0]


def test_xml(spark):
    whole = '<r><f><aff id="1"><label>1</label>Dept A, <b>X</b>, City</aff></f><aff>Dept B</aff><Affiliation>Z</Affiliation></r>'
    aff = lambda b: xml_affiliations(b, F.lit("aff"))
    assert one(spark, whole, aff) == ["Dept A, , City", "Dept B"]
    assert one(spark, whole, lambda b: xml_affiliations(b, F.lit("Affiliation"))) == ["Z"]
    assert one(spark, "<bad", aff) == [] and one(spark, None, aff) == []


def test_json(spark):
    cases = {
        '{"affiliation":{"affilname":"U","affiliation-city":"C"}}': ["U,C,"],
        '{"affiliation":[{"affilname":"U","affiliation-country":"K"},{}]}': ["U,,K", ",,"],
        '{"affiliation":[{"affilname":null,"affiliation-city":5}]}': [",5,"],
        '{"affiliation":{}}': [], '{"affiliation":[]}': [], '{"affiliation":null}': [], "{}": [], "oops": [],
    }
    for body, expected in cases.items():
        assert one(spark, body, json_affiliations) == expected, body
    assert one(spark, None, json_affiliations) == []


def test_html(spark):
    page = '<ol class="affiliation-list"><li><address><span>A</span><span>B</span></address></li></ol>'
    assert one(spark, page, html_addresses) == ["AB"]
    assert one(spark, page, lambda b: html_addresses(b, parts=True)) == ["A", "B"]
    assert one(spark, "<ol><li><address>A</address></li></ol>", html_addresses) == []


def test_ids(spark):
    assert one(spark, "PMC123", archive_id) == "123" and one(spark, "123", archive_id) == "123"
    assert one(spark, "123.0", numeric_id) == 123 and one(spark, "PMC1", numeric_id) is None


def payload_rows(spark):
    return spark.createDataFrame([
        ("a", "pmc", "aff", "<r><aff>One</aff></r>"), ("b", "pmc", None, "<bad"),
        ("c", "elsevier", None, '{"affiliation":{"affilname":"U"}}'),
        ("c", "bior", None, "<ol class='affiliation-list'><li><address><span>S</span></address></li></ol>"),
        ("x", "other", None, "ignored"),
    ], schemas.PAYLOADS)


def test_extract_all_providers(spark):
    got = {(r.cord_uid, r.provider): r.affiliate for r in extract(payload_rows(spark)).collect()}
    assert got == {("a", "pmc"): ["One"], ("b", "pmc"): [], ("c", "elsevier"): ["U,,"], ("c", "bior"): ["S"]}


def test_collect_twice_does_nothing_new(spark):
    papers = meta(
        spark, ("a", "x", "PMC1", None), ("b", "x", None, "2.0"), ("c", "els-bio", None, None), ("d", "unk", None, None),
        ("e", "cc-by", None, None), ("f", "medr", None, None), ("g", "x", "PMC7", None),
    )
    prior = collected(spark, ("g", ["known"]))
    first = collect(papers, payload_rows(spark), prior)
    rows = sorted((r.cord_uid, r.affiliate) for r in first.collect())
    # e has no route, f no stored payload: both stay to do.
    assert rows == [("a", ["One"]), ("b", []), ("c", ["S"]), ("c", ["U,,"]), ("d", []), ("g", ["known"])]
    path = scratch_path(spark, "first")
    first.write.parquet(path)
    again = collect(papers, payload_rows(spark), spark.read.parquet(path))
    assert sorted((r.cord_uid, r.affiliate) for r in again.collect()) == rows
    assert sorted(r.cord_uid for r in diff_papers(papers, again).todo.collect()) == ["e", "f"]


def test_files(spark, tmp_path):
    (tmp_path / "m.csv").write_text('cord_uid,title,doi,pubmed_id,license\nu1,"two\nlines, ""q""",d1,123.0,cc\nu2,t,,,\n')
    rows = read_metadata(spark, str(tmp_path / "m.csv")).orderBy("cord_uid").collect()
    assert [(r.cord_uid, r.doi, r.pubmed_id, r.license, r.pmcid) for r in rows] == [
        ("u1", "d1", "123.0", "cc", None), ("u2", None, None, None, None),
    ]
    (tmp_path / "c.csv").write_text(""",cord_uid,affiliate\n0,u1,"['A, b', ""O'Neil""]"\n1,u2,[]\n2,u3,\n""")
    got = {r.cord_uid: r.affiliate for r in read_collected(spark, str(tmp_path / "c.csv")).collect()}
    assert got == {"u1": ["A, b", "O'Neil"], "u2": [], "u3": None}
    (tmp_path / "r.json").write_text('{"institutes": [{"id": "g1", "name": "U",\n "aliases": ["V"], "addresses": [{"city": "C"}]}]}')
    row = read_registry(spark, str(tmp_path / "r.json")).first()
    assert (row.id, row.aliases, row.acronyms, row.addresses[0].city) == ("g1", ["V"], None, "C")
    assert read_optional(spark, str(tmp_path / "absent"), read_cache) is None


def test_runs_do_not_overwrite(spark, tmp_path):
    path = str(tmp_path / "table")
    assert read_latest(spark, path, "n INT") is None
    write_run(spark.sql("SELECT 1 AS n"), path)
    old = read_latest(spark, path, "n INT")
    write_run(old.selectExpr("n + 1 AS n"), path)
    assert read_latest(spark, path, "n INT").first().n == 2 and old.first().n == 1


def test_collected_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "out.csv")
    write_csv(collected(spark, ("a", ['x, "y"', "l\nf"]), ("b", []), ("c", None)), path)
    assert {r.cord_uid: r.affiliate for r in read_collected(spark, path).collect()} == {
        "a": ['x, "y"', "l\nf"], "b": [], "c": None,
    }


def test_id_space_chooses_between_two_xml_payloads(spark):
    papers = meta(spark, ("a", "x", "PMC1", "5"), ("b", "x", None, "5"))
    payloads = spark.createDataFrame(
        [(p, "pmc", tag, f"<r><{tag}>{text}</{tag}></r>") for p in "ab" for tag, text in (("aff", "A"), ("Affiliation", "B"))],
        schemas.PAYLOADS,
    )
    rows = sorted((r.cord_uid, r.affiliate) for r in collect(papers, payloads).collect())
    assert rows == [("a", ["A"]), ("b", ["B"])]


def test_few_rows_in_one_file_are_read_by_several_tasks(spark, tmp_path):
    """A customer table of one small file: the expensive expressions run in as many tasks as shuffles have."""
    names = [(i, f"Customer#{i:09d}", i % 2, "BUILDING") for i in range(40)]
    tables = {
        "customer": (names, "c_custkey LONG, c_name STRING, c_nationkey LONG, c_mktsegment STRING"),
        "nation": ([(0, "NATION_0", 0), (1, "NATION_1", 0)], "n_nationkey LONG, n_name STRING, n_regionkey LONG"),
        "region": ([(0, "ASIA")], "r_regionkey LONG, r_name STRING"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    out = QUERIES["html_part_extract"](spark, str(tmp_path))
    used = out.withColumn("p", F.spark_partition_id()).collect()
    assert len({r.p for r in used}) > 2
    want = {(i, 0, n) for i, n, _, _ in names} | {(i, 1, f"NATION_{'ab'[k]} <ASIA>") for i, _, k, _ in names}
    assert {(r.c_custkey, r.pos, r.affiliation) for r in used} == want and len(used) == 80
