"""Expressions on parsed addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of a country and the name results use for it.
COUNTRY_ALIASES = {
    "usa": "united states",
    "united states of america": "united states",
    "republic of china": "china",
    "uk": "united kingdom",
    "england": "united kingdom",
    "españa": "spain",
    "the netherlands": "netherlands",
    "republic of korea": "south korea",
    "taiwan roc": "taiwan",
    "hong kong": "china",
}


def canonical_country(name: Column, aliases: dict[str, str] | None = None) -> Column:
    """The usual name of a country; names without an alias stay as they are."""
    table = COUNTRY_ALIASES if aliases is None else aliases
    if not table:
        return name
    lookup = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(F.try_element_at(lookup, name), name)


def label_value(parsed: Column, label: str) -> Column:
    """Value of a label in a label-to-value map, or the empty string."""
    return F.coalesce(F.try_element_at(parsed, F.lit(label)), F.lit(""))


def invert_map(pairs: Column) -> Column:
    """Swap keys and values of a map; where a value repeats, its last key wins."""
    swapped = F.transform(F.map_entries(pairs), lambda e: F.struct(e["value"].alias("key"), e["key"].alias("value")))
    keys = F.array_distinct(F.transform(swapped, lambda e: e["key"]))
    last = F.transform(keys, lambda k: F.element_at(F.filter(swapped, lambda e: e["key"] == k), -1))
    return F.map_from_entries(last)
