import pytest
from pyspark.sql import functions as F

from affilix import attach_cached, resolve, schemas
from affilix.operators.gazetteer import build_gazetteer, parse_places
from affilix.operators.segments import (
    best_segments, distinct_segments, fit_segment_model, function_scorer, lexicon_scorer, model_scorer, segments,
)
from affilix.plans.resolve import describe_strings

INSTITUTES = [
    ("g1", "Alpha University", ["Alpha Uni"], ["AU"], [("Paris", "France", "FR")]),
    ("g2", "Beta Institute of Physics", [], [], [("Boston", "United States", "US"), ("Leeds", "United Kingdom", "GB")]),
    ("g3", "Alpha College", [], [], [("Boston", "United States", "US")]),
]
ADDRESSES = [
    ("g1", 1, "Alpha University", 48.8, 2.3, "Paris", None, None, "France"),
    ("g2", 2, "Beta Institute of Physics", 42.3, -71.0, "Boston", "Massachusetts", "MA", "United States"),
    ("g2", 3, "Beta Institute of Physics", 53.8, -1.5, "Leeds", None, None, "United Kingdom"),
]


@pytest.fixture(scope="module")
def inputs(spark):
    weights = [("university", 4.0), ("college", 4.0), ("institute", 4.0), ("department", 1.0)]
    return (
        spark.createDataFrame(INSTITUTES, schemas.INSTITUTES),
        spark.createDataFrame(ADDRESSES, schemas.ADDRESSES),
        lexicon_scorer(spark.createDataFrame(weights, schemas.SEGMENT_WEIGHTS), bias=-3.0),
    )


def papers(spark, *rows):
    return spark.createDataFrame(rows, "cord_uid STRING, affiliate ARRAY<STRING>")


def strings(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "affiliate STRING")


def test_first_of_the_best_segments(spark):
    parts = segments(strings(spark, "p, Q!, r", "s"))
    scored = spark.createDataFrame([("p", 0.2), ("q", 0.9), ("r", 0.9), ("s", 0.1)], "segment STRING, prob DOUBLE")
    assert [r.extracted for r in best_segments(parts, scored).collect()] == ["q"]


def test_lexicon(spark, inputs):
    got = {r.segment: round(r.prob, 4) for r in inputs[2](distinct_segments(segments(strings(spark, "Department university,x,")))).collect()}
    assert got == {"department university": 0.8808, "x": 0.0474, "": 0.0474}


def test_model_and_function_scorers(spark):
    labelled = spark.createDataFrame(
        [(f"university {w}", 1.0) for w in "abcdef"] + [(f"street {w}", 0.0) for w in "abcdef"], "segment STRING, label DOUBLE"
    )
    model = model_scorer(fit_segment_model(labelled))
    probs = {r.segment: r.prob for r in model(spark.createDataFrame([("university z",), ("street z",)], "segment STRING")).collect()}
    assert probs["university z"] > 0.5 > probs["street z"]
    length = function_scorer(lambda c: F.length(c) / 10)
    assert length(spark.sql("SELECT 'abcde' AS segment")).first().prob == 0.5


def test_places(spark):
    names = spark.createDataFrame(
        [("New York", "city"), ("York", "city"), ("Paris", "city"), ("France", "country"), ("USA", "country"),
         ("Democratic Republic of the Congo", "country"), ("Congo", "country")], schemas.GAZETTEER,
    )
    texts = ["York, New York 10001, USA", "Paris, York, France", "x, the Democratic Republic of the Congo, Congo", "none"]
    found = parse_places(strings(spark, *texts), names)
    keyed = strings(spark, *texts).withColumn("aff_id", F.unhex(F.md5("affiliate"))).join(found, "aff_id", "left")
    assert {r.affiliate: (r.city, r.country) for r in keyed.collect()} == {
        texts[0]: ("new york", "united states"), texts[1]: ("york", "france"),
        texts[2]: (None, "democratic republic of the congo"), texts[3]: (None, None),
    }


def test_gazetteer_holds_registry_and_aliases(spark, inputs):
    names = {(r.name, r.kind) for r in build_gazetteer(inputs[0]).collect()}
    assert {("paris", "city"), ("france", "country"), ("uk", "country"), ("españa", "country")} <= names


def test_description(spark, inputs):
    got = describe_strings(
        strings(spark, "Department X, Alpha University, Paris, France", "?"), build_gazetteer(inputs[0]), inputs[2]
    )
    assert {tuple(r) for r in got.select("extracted", "country", "city").collect()} == {
        ("alpha university", "france", "paris"), ("", "", ""),
    }


def result(df):
    return sorted((r.cord_uid, r.affiliate, r.grid_id, r.city) for r in df.collect())


def test_resolve(spark, inputs):
    rows = papers(
        spark,
        ("p1", ["Department X, Alpha University, Paris, France\n", "  ", "a b c"]),
        ("p2", ["Dept. X, Alpha University, Paris, France", "Beta Institute of Physics, Boston, USA"]),
        ("p3", []), ("p4", None), ("p5", ["Nothing here"]),
    )
    out = resolve(rows, *inputs)
    assert out.columns == schemas.RESULT_COLUMNS
    assert result(out.fillna("-", ["grid_id", "city"])) == [
        ("p1", "", "-", "-"),
        ("p1", "Department X, Alpha University, Paris, France", "g1", "Paris"),
        ("p1", "a b c", "not found", "-"),
        ("p2", "Beta Institute of Physics, Boston, USA", "g2", "Boston"),
        ("p2", "Beta Institute of Physics, Boston, USA", "g2", "Leeds"),
        ("p2", "Dept. X, Alpha University, Paris, France", "g1", "Paris"),
        ("p5", "Nothing here", "not found", "-"),
    ]


def test_copies_get_one_answer_by_vote(spark, inputs):
    """The last string names no place, so alone it could not tell the two Alphas apart; its near copies can."""
    texts = [f"Alpha University, Paris, France {'.' * i}" for i in range(30)] + ["Alpha University,, Paris France"]
    out = resolve(papers(spark, *[(f"p{i}", [t]) for i, t in enumerate(texts)]), *inputs)
    assert {r.grid_id for r in out.collect()} == {"g1"}


def test_cache(spark, inputs):
    cached = spark.createDataFrame(
        [("Old string", "g9", 9, "Old", 0.0, 0.0, "Oldtown", None, None, "Oldland"),
         ("Lost string", "not found", None, None, None, None, None, None, None, None)], schemas.CACHE,
    )
    rows = papers(spark, ("p1", ["Old string", "Lost string", "Alpha University, Paris, France"]))
    assert result(resolve(rows, *inputs, cache=cached).fillna("-", ["city"])) == [
        ("p1", "Alpha University, Paris, France", "g1", "Paris"), ("p1", "Lost string", "not found", "-"),
        ("p1", "Old string", "g9", "Oldtown"),
    ]
    known = papers(spark, ("p1", ["Old\n string ", ""]))
    assert result(attach_cached(known, cached).fillna("-", ["grid_id", "city"])) == [
        ("p1", "", "-", "-"), ("p1", "Old string", "g9", "Oldtown"),
    ]


def test_saved_cache_is_read_again(spark, inputs, tmp_path):
    rows = papers(spark, ("p1", ["Alpha University, Paris, France"]))
    first = result(resolve(rows, *inputs, save_cache=str(tmp_path / "cache")))
    assert result(resolve(rows, *inputs, cache=spark.read.parquet(str(tmp_path / "cache")))) == first


def test_two_runs_answer_as_one(spark, inputs, tmp_path):
    """The second run reads the state of the first and answers as one run over both; strings meet across runs."""
    from affilix.operators.similarity import class_of, neighbours
    from affilix.plans.resolve import resolve_in_runs

    first = papers(
        spark, ("p1", ["Alpha University, Paris, France"]), ("p2", ["Alpha College, Boston, USA"]),
        ("p3", ["Beta Institute of Physics Department, Leeds"]), ("p4", None),
    )
    second = papers(
        spark, ("p5", ["Alpha University Paris France"]), ("p6", ["Beta Institute of Physics, Department Leeds", ""]),
        ("p7", ["Alpha College Boston, USA"]), ("p1", ["Alpha University, Paris, France"]),
    )
    state = str(tmp_path / "state")
    resolve_in_runs(first, *inputs, save_state=state)
    got = resolve_in_runs(second, *inputs, state=state)
    whole = resolve(first.unionByName(second), *inputs)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
    assert got.count() == whole.count() == 10
    # Strings of the two runs fall into one class: the second run's copies count in the first run's weights.
    texts = ["alpha university, paris, france", "alpha university paris france"]
    strings = spark.createDataFrame([(t,) for t in texts], "affiliate STRING")
    assert strings.select(class_of(F.col("affiliate")).alias("c")).distinct().count() == 1
    assert neighbours(strings).classes.first().copies == 2


def test_papers_are_read_once(spark, inputs, tmp_path):
    """The rows are needed at both ends of the job; what the papers come from is not computed again for the result."""
    papers(spark, ("1", ["Department of Physics, Alpha University, Paris, France"]), ("2", [])).write.parquet(str(tmp_path / "papers"))
    out = resolve(spark.read.parquet(str(tmp_path / "papers")), *inputs)
    assert not any("/papers/" in f for f in out.inputFiles())
    assert [r.cord_uid for r in out.collect()] == ["1"]


def test_rows_of_earlier_runs_are_not_written_again(spark, inputs, tmp_path):
    from affilix.plans.resolve import resolve_in_runs

    state = str(tmp_path / "state")
    resolve_in_runs(papers(spark, ("1", ["Alpha University, Paris, France"])), *inputs, save_state=state)
    out = resolve_in_runs(papers(spark, ("2", ["Alpha College, Boston, United States"])), *inputs, state=state)
    assert any(f"{state}/rows/" in f for f in out.inputFiles())
    assert {r.cord_uid for r in out.collect()} == {"1", "2"}
