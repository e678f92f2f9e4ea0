"""Predicates on string-held booleans and token lists, safe under ANSI mode."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from featuremill.functions.columns import _col, cast_safe


def not_true(c, none_token: str = "None") -> Column:
    """False, missing, or the token ``None`` (a string-held boolean that is not set)."""
    col = _col(c)
    as_bool = cast_safe(col, "boolean")
    return F.coalesce((as_bool == F.lit(False)) | col.isNull() | (col == none_token), F.lit(False))


def flag_set(c) -> Column:
    """Integer flag equal to 1 (``2`` or a non-number does not count)."""
    return F.coalesce(cast_safe(_col(c), "int") == 1, F.lit(False))


def contains_token(c, token: str = "True") -> Column:
    """The text holds ``token`` somewhere (null -> False)."""
    return F.coalesce(_col(c).contains(token), F.lit(False))


def isin_any(cols, values) -> Column:
    """Any of ``cols`` is one of ``values`` (null -> False)."""
    values = list(dict.fromkeys(values))
    return F.coalesce(reduce(or_, [_col(c).isin(values) for c in cols]), F.lit(False))
