import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from affilix.functions.address import canonical_country, invert_map, label_value
from affilix.functions.literals import decode_list, encode_list
from affilix.functions.markup import plain_text
from affilix.functions.text import clean, digest, join_commas, match_terms, normalize, split_commas, strip_digits, words


def apply(spark, function, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, c STRING")
    return [r[0] for r in df.select(function(F.col("c")).alias("x"), "i").orderBy("i").select("x").collect()]


@pytest.mark.parametrize("function, text, expected", [
    (clean, "Université d'Été, Zürich", "université d été zürich"),
    (clean, "a_b  c²½", "a_b c²½"),
    (clean, "हिन्दी", "ह न द"),
    (clean, " --- ", ""),
    (normalize, " x\ny\t", "xy"),
    (normalize, "  x y\x1f\r", "x y"),
    (split_commas, "  a b, c ,,d ", ["a b", "c", "", "d"]),
    (split_commas, "\ta,", ["\ta", ""]),
    (strip_digits, "paris 75005", "paris "),
    (canonical_country, "uk", "united kingdom"),
    (canonical_country, "hong kong", "china"),
    (canonical_country, "españa", "spain"),
    (canonical_country, "france", "france"),
    (words, "B b, a!", ["b", "b", "a"]),
    (match_terms, "A bc, def g", ["bc", "def"]),
    (plain_text, " <b>A&amp;lt;</b>\n &eacute;&#233;&#xE9;&nbsp;&unknown; ", "A&lt; ééé &unknown;"),
])
def test_expression(spark, function, text, expected):
    assert apply(spark, function, [text]) == [expected]


def test_null_stays_null(spark):
    for function in (clean, normalize, split_commas, strip_digits, decode_list, canonical_country):
        assert apply(spark, function, [None]) == [None]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(max_codepoint=0x2FF, exclude_characters="\x00")), min_size=20, max_size=40))
def test_cleaning_equals_python(spark, texts):
    def reference(t):
        return " ".join(re.sub(r"\W+", " ", t).lower().split())

    assert apply(spark, clean, texts) == [reference(t) for t in texts]
    assert apply(spark, normalize, texts) == [t.replace("\n", "").strip() for t in texts]


def test_all_white_space_is_trimmed(spark):
    spaces = [chr(i) for i in range(0x10000) if chr(i).isspace() and chr(i) != "\n"]
    assert apply(spark, normalize, [f"{c}x{c}y{c}" for c in spaces]) == [f"x{c}y" for c in spaces]


def test_join_commas_keeps_places(spark):
    row = spark.sql("SELECT 'U' a, CAST(NULL AS STRING) b, 'K' c").select(join_commas(F.col("a"), F.col("b"), F.col("c")))
    assert row.first()[0] == "U,,K"


def test_literal_lists(spark):
    cells = [
        """['A, b', "O'Neil"]""", "[]", r"['x\xa0y']", r"['ok', 'x\xa0y']", r"['a\'b', 'c\\d']", "['a', None]", "nonsense",
        "['a', 'b'", '["json", "é"]', r"['tab\t', 'é']",
    ]
    assert apply(spark, decode_list, cells) == [
        ["A, b", "O'Neil"], [], ["x\xa0y"], ["ok", "x\xa0y"], ["a'b", "c\\d"], ["a", None], None, None, ["json", "é"],
        ["tab\t", "é"],
    ]


def test_list_text_round_trip(spark):
    lists = [["a", 'q"x', "l\nf"], [], ["é\\", "it's"]]
    df = spark.createDataFrame([(x,) for x in lists], "l ARRAY<STRING>")
    assert [r[0] for r in df.select(decode_list(encode_list(F.col("l")))).collect()] == lists


def test_maps(spark):
    df = spark.sql("SELECT map('paris', 'city', 'lyon', 'city', 'france', 'country') AS m")
    row = df.select(invert_map(F.col("m")).alias("i")).select(
        "i", label_value(F.col("i"), "city"), label_value(F.col("i"), "road")
    ).first()
    assert row[0] == {"city": "lyon", "country": "france"} and row[1] == "lyon" and row[2] == ""


def test_digest_is_wide(spark):
    assert len(apply(spark, digest, ["x"])[0]) == 16


def test_expressions_stay_in_the_jvm(spark, capsys):
    df = spark.createDataFrame([("a",)], "c STRING")
    for function in (clean, normalize, split_commas, strip_digits, canonical_country, words, plain_text):
        df.select(function(F.col("c")).alias("x")).explain()
        assert "Python" not in capsys.readouterr().out


def test_list_decoding_refuses_what_follows_a_list(spark):
    cells = ["['a'],['b']", "['a'] x", "['a', \"b's\"]", "[]", " [ 'a' ,'b' ] ", "['a',]", "[s]", "['a\\'b']", "['None']", "[None]"]
    assert apply(spark, decode_list, cells) == [
        None, None, ["a", "b's"], [], ["a", "b"], ["a"], None, ["a'b"], ["None"], [None]
    ]


def test_references_as_a_browser_reads_them(spark):
    cells = ["O&apos;Neil", "Gda&nacute;sk", "&Lstrok;&oacute;d", "a&#150;b", "a<br>b", "&amp;lt;", "&#x92;", "&unknown;", "&#99999999999;"]
    assert apply(spark, plain_text, cells) == [
        "O'Neil", "Gdańsk", "Łód", "a–b", "a b", "&lt;", "’", "&unknown;", "&#99999999999;"
    ]
