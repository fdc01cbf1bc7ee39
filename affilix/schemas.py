"""Declared schemas. Nothing is inferred at read."""

from __future__ import annotations

METADATA_COLUMNS = ["cord_uid", "source_x", "sha", "doi", "license", "pmcid", "pubmed_id"]
METADATA = ", ".join(f"{name} STRING" for name in METADATA_COLUMNS)

COLLECTED_COLUMNS = ["cord_uid", "source_x", "sha", "doi", "affiliate", "license", "pmcid", "pubmed_id"]
COLLECTED = ", ".join(f"{n} {'ARRAY<STRING>' if n == 'affiliate' else 'STRING'}" for n in COLLECTED_COLUMNS)
# The same table as text: the list column holds a list literal.
COLLECTED_TEXT = ", ".join(f"{name} STRING" for name in COLLECTED_COLUMNS)

PAYLOADS = "cord_uid STRING, provider STRING, tag STRING, body STRING"

INSTITUTES = (
    "id STRING, name STRING, aliases ARRAY<STRING>, acronyms ARRAY<STRING>, "
    "addresses ARRAY<STRUCT<city: STRING, country: STRING, country_code: STRING>>"
)

ADDRESS_COLUMNS = ["geonames_city_id", "institute_name", "lat", "lng", "city", "state", "state_code", "country"]
_ADDRESS_TYPES = ["BIGINT", "STRING", "DOUBLE", "DOUBLE", "STRING", "STRING", "STRING", "STRING"]
_ADDRESS_FIELDS = ", ".join(f"{n} {t}" for n, t in zip(ADDRESS_COLUMNS, _ADDRESS_TYPES))
ADDRESSES = f"grid_id STRING, {_ADDRESS_FIELDS}"

# Strings resolved by an earlier run.
CACHE = f"affiliate STRING, grid_id STRING, {_ADDRESS_FIELDS}"

RESULT_COLUMNS = ["cord_uid", "affiliate", "grid_id", *ADDRESS_COLUMNS]

GAZETTEER = "name STRING, kind STRING"
SEGMENT_WEIGHTS = "token STRING, weight DOUBLE"

NOT_FOUND = "not found"
