"""Scalar column helpers (projection and casting)."""

from __future__ import annotations

import re
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, StringType


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sanitize_name(name: str) -> str:
    """A column name safe for SQL and RFormula: every character other than a letter,
    digit or underscore becomes ``_`` (``St. John`` -> ``St__John``)."""
    return re.sub(r"[^0-9A-Za-z_]", "_", name)


def cast_safe(c, to: str) -> Column:
    """ANSI-safe cast: a value that does not parse becomes null instead of failing."""
    return _col(c).try_cast(to)


def sum_columns(cols) -> Column:
    """Row-wise sum of several numeric columns (null if any input is null, like ``a + b``)."""
    cols = [_col(c) for c in cols]
    if not cols:
        raise ValueError("sum_columns needs at least one column")
    return reduce(add, cols)


def is_missing(c, dtype: DataType) -> Column:
    """Null, or NaN for floating and string columns (a string ``NaN`` counts as missing)."""
    col = _col(c)
    if isinstance(dtype, (DoubleType, FloatType)):
        return col.isNull() | F.isnan(col)
    if isinstance(dtype, StringType):
        # the only texts Spark's string-to-double cast turns into NaN (no parse attempt)
        return col.isNull() | F.coalesce(F.lower(F.trim(col)).isin("nan", "+nan"), F.lit(False))
    return col.isNull()


def list_size(c, sep: str = ",", mode: str = "reference") -> Column:
    """Length of a delimited list held in a string.

    ``mode="reference"``: number of elements minus one, as the original feature was
    computed (``''``, ``None`` and a single element give 0), null stays null.
    ``mode="count"``: the true number of elements; ``''``, ``None`` and null give 0.
    """
    col = _col(c)
    n = F.size(F.split(col, sep))
    if mode == "reference":
        return F.when(col.isNotNull(), n - 1)
    if mode == "count":
        return F.when(col.isNull() | col.isin("", "None"), F.lit(0)).otherwise(n)
    raise ValueError(f"unknown list_size mode {mode!r}")
