"""Expressions that read text out of HTML."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character references that the expression below resolves; numeric ones need no table.
_NAMED = {name[:-1]: text for name, text in html5.items() if name.endswith(";") and name != "amp;"}
# References to the code points 0x80 to 0x9F mean the characters that Windows-1252 has there.
_WINDOWS = {n: bytes([n]).decode("cp1252", "ignore") for n in range(0x80, 0xA0)}
# Tags after which a new line begins on a page.
_BREAKS = r"(?i)</?(?:br|p|div|li|ul|ol|tr|td|th|table|h[1-6]|address|section|article|dl|dt|dd|hr)\b[^>]*>"


def _code_point(number: Column) -> Column:
    """The character of a code point; NULL outside the range of characters."""
    windows = F.create_map(*[x for n, c in _WINDOWS.items() if c for x in (F.lit(n).cast("bigint"), F.lit(c))])
    valid = (number > 0) & (number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    padded = F.lpad(F.hex(F.when(valid, number)), 8, "0")
    return F.coalesce(F.try_element_at(windows, number), F.decode(F.unhex(padded), "UTF-32"))


def _reference(name: Column) -> Column:
    """Text that ``&name;`` stands for, or NULL when it stands for nothing known."""
    table = F.from_json(F.lit(json.dumps(_NAMED)), "map<string,string>")
    hexadecimal = F.conv(F.regexp_extract(name, "^#[xX]([0-9a-fA-F]{1,8})$", 1), 16, 10).try_cast("bigint")
    decimal = F.regexp_extract(name, "^#([0-9]{1,10})$", 1).try_cast("bigint")
    return F.coalesce(F.try_element_at(table, name), _code_point(F.coalesce(decimal, hexadecimal)))


def unescape(text: Column) -> Column:
    """Resolve character references, ``&amp;`` last so that nothing is resolved twice."""
    names = F.array_distinct(F.regexp_extract_all(text, F.lit("&(#?[0-9A-Za-z]+);"), F.lit(1)))
    resolved = F.aggregate(
        F.filter(names, lambda n: n != "amp"),
        text,
        lambda acc, n: F.coalesce(F.replace(acc, F.concat(F.lit("&"), n, F.lit(";")), _reference(n)), acc),
    )
    return F.replace(F.when(F.size(names) > 0, resolved).otherwise(text), F.lit("&amp;"), F.lit("&"))


def plain_text(fragment: Column) -> Column:
    """Visible text of a fragment: tags out, references resolved, white space runs to one space, trimmed."""
    broken = F.regexp_replace(F.regexp_replace(fragment, r"(?s)<!--.*?-->", ""), _BREAKS, "\n")
    bare = F.regexp_replace(broken, r"(?s)<[^>]*>", "")
    return F.trim(F.regexp_replace(unescape(bare), r"[\s\x{a0}]+", " "))


def extract_items(html: Column, block: str, item: str, part: str | None = None) -> Column:
    """Texts of every ``item`` inside every ``block``; with ``part``, of every ``part`` inside those.

    Each argument is a regular expression with one group around the inner markup.
    """
    def inner(fragments: Column, pattern: str) -> Column:
        return F.flatten(F.transform(fragments, lambda x: F.regexp_extract_all(x, F.lit(pattern), F.lit(1))))

    found = inner(F.regexp_extract_all(html, F.lit(block), F.lit(1)), item)
    if part is not None:
        found = inner(found, part)
    return F.coalesce(F.transform(found, plain_text), F.array().cast("array<string>"))
