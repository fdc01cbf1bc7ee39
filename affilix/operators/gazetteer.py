"""City and country of a free-text address, by a join with known place names.

Stands in for a statistical address parser: names the gazetteer does not hold are not found, and rare strings may be
read differently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affilix.functions.address import COUNTRY_ALIASES, canonical_country
from affilix.functions.text import clean, digest, strip_digits, words
from affilix.operators.skew import grid_join


def build_gazetteer(institutes: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """``name, kind``: the registry's cities and countries and the known country aliases, cleaned."""
    table = COUNTRY_ALIASES if aliases is None else aliases
    places = institutes.select(F.explode("addresses").alias("a"))
    cities = places.select(F.col("a.city").alias("name"), F.lit("city").alias("kind"))
    countries = places.select(F.col("a.country").alias("name"), F.lit("country").alias("kind"))
    known = sorted(set(table) | set(table.values()))
    listed = F.array(*[F.lit(n) for n in known]).cast("array<string>")
    names = institutes.sparkSession.range(1).select(F.explode(listed).alias("name"), F.lit("country").alias("kind"))
    return (
        cities.unionByName(countries).unionByName(names)
        .select(clean(F.col("name")).alias("name"), "kind")
        .filter("name <> ''").distinct()
    )


def place_mentions(strings: DataFrame, gazetteer: DataFrame, text: str = "affiliate") -> DataFrame:
    """Gazetteer names found in the strings: ``aff_id, kind, name, n_words, pos``, names of any length."""
    names = gazetteer.select(F.array_join(words(F.col("name")), " ").alias("name"), "kind").distinct()
    longest = names.agg(F.coalesce(F.max(F.size(F.split("name", " "))), F.lit(1)).alias("n")).scalar()
    tokens = strings.select(digest(F.col(text)).alias("aff_id"), words(F.col(text)).alias("w")).filter(F.size("w") > 0)
    starts = tokens.withColumn("longest", longest).select(
        "aff_id", "w", "longest", F.explode(F.sequence(F.lit(0), F.size("w") - 1)).alias("pos")
    )
    sizes = F.sequence(F.lit(1), F.least(F.col("longest"), F.size("w") - F.col("pos")))
    grams = (
        starts.select("aff_id", "w", "pos", F.explode(sizes).alias("n_words"))
        .select("aff_id", "pos", "n_words",
                F.array_join(F.slice("w", F.col("pos") + 1, F.col("n_words")), " ").alias("name"))
    )
    return grid_join(grams, names, ["name"], spread_left=["aff_id", "pos"], spread_right=["kind"])


def parse_places(
    strings: DataFrame, gazetteer: DataFrame, text: str = "affiliate", aliases: dict[str, str] | None = None
) -> DataFrame:
    """``aff_id, city, country``: per kind the longest name, the last one where several are as long.

    Digits are deleted from the city, the country gets its usual name. A kind without a mention is NULL; strings without
    any mention are left out.
    """
    def pick(kind: str):
        seen = F.when(F.col("kind") == kind, F.struct("n_words", "pos", "name"))
        return F.max(seen).alias(kind)

    best = place_mentions(strings, gazetteer, text).groupBy("aff_id").agg(pick("city"), pick("country"))
    return best.select(
        "aff_id", strip_digits(F.col("city.name")).alias("city"),
        canonical_country(F.col("country.name"), aliases).alias("country"),
    )


def describe(strings: DataFrame, best: DataFrame, places: DataFrame, text: str = "affiliate") -> DataFrame:
    """``affiliate, extracted, country, city`` for every string; what was not found is the empty string."""
    keyed = strings.select(F.col(text).alias("affiliate"), digest(F.col(text)).alias("aff_id"))
    joined = keyed.join(best, "aff_id", "left").join(places, "aff_id", "left")
    filled = [F.coalesce(c, F.lit("")).alias(c) for c in ("extracted", "country", "city")]
    return joined.select("affiliate", *filled)
