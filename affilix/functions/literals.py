"""Lists stored as text, such as ``['A', "O'Neil"]``."""

from __future__ import annotations

import ast

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.ArrayType(T.StringType()))
def _literal(cells: pd.Series) -> pd.Series:
    def decode(cell):
        if cell is None:
            return None
        try:
            value = ast.literal_eval(cell)
        except (ValueError, SyntaxError, MemoryError, RecursionError):
            return None
        return [None if v is None else str(v) for v in value] if isinstance(value, list) else None

    return cells.map(decode)


_QUOTED = r"""'[^'\\\n]*+(?:\\.[^'\\\n]*+)*+'|"[^"\\\n]*+(?:\\.[^"\\\n]*+)*+\""""


def _one_list(cell: Column) -> Column:
    """Whether a cell is one list of quoted strings with nothing after it."""
    shape = F.translate(F.regexp_replace(cell, _QUOTED, "s"), " \n\r\t", "")
    return F.replace(shape, F.lit("s,"), F.lit("")).isin("[s]", "[]")


def decode_list(cell: Column) -> Column:
    """Array of the strings in a list literal; NULL for NULL and for what is no list.

    The JSON reader decodes nearly every cell in the JVM. It only sees cells with no escape other than those that mean
    the same in both notations, so that it never half-reads one, and only whole lists; the rest go to Python, as NULL for all other rows.
    """
    plain = ~cell.rlike(r"""\\[^\\'"nrtbf]""") & _one_list(cell)
    quick = F.from_json(F.when(plain, cell), "array<string>", {"allowSingleQuotes": "true"})
    slow = _literal(F.when(quick.isNull(), cell))
    return F.coalesce(quick, slow)


def encode_list(items: Column) -> Column:
    """The list as text that :func:`decode_list` reads back."""
    return F.to_json(items)
