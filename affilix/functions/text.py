"""String expressions: cleaning, trimming, splitting, tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes equal to Python's \W and \d, and all characters that str.isspace accepts.
NON_WORD = r"[^\p{L}\p{N}_]+"
DIGITS = r"\p{Nd}+"
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def clean(text: Column) -> Column:
    """Runs of non-word characters become one space; lower case; trimmed."""
    return F.trim(F.lower(F.regexp_replace(text, NON_WORD, " ")))


def normalize(text: Column) -> Column:
    """Drop line feeds (nothing is put in their place), then trim every kind of white space."""
    return F.btrim(F.replace(text, F.lit("\n"), F.lit("")), F.lit(SPACES))


def split_commas(text: Column) -> Column:
    """Comma-separated parts, stripped of spaces only; empty parts are kept."""
    return F.transform(F.split(text, ",", -1), lambda part: F.trim(part))


def strip_digits(text: Column) -> Column:
    """Delete runs of decimal digits; nothing is trimmed afterwards."""
    return F.regexp_replace(text, DIGITS, "")


def join_commas(*parts: Column) -> Column:
    """``a,b,c``; a missing part counts as empty, so the number of commas is fixed."""
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        pieces += ([F.lit(",")] if i else []) + [F.coalesce(part, F.lit(""))]
    return F.concat(*pieces)


def words(text: Column) -> Column:
    """Tokens of the cleaned text, in order, repeats kept."""
    return F.array_remove(F.split(clean(text), " "), "")


def match_terms(text: Column) -> Column:
    """The tokens that similarity looks at: two characters or more."""
    return F.filter(F.split(clean(text), " "), lambda w: F.length(w) >= 2)


def digest(text: Column) -> Column:
    """16-byte identity of a string. 64-bit hashes are too short: they collide at billions of distinct strings."""
    return F.unhex(F.md5(text))


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))
