"""Date and time features: recency, span, rate and tenure."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType

from featuremill.functions.columns import _col

# Fixed value: seconds in an average month (365.2425 days / 12), as the tenure feature uses.
SECONDS_PER_MONTH = 2629743
# Fixed value: days in an average year for spans.
DAYS_PER_YEAR = 365.25


def to_date_safe(c, dtype=None) -> Column:
    """Date of a timestamp, date or timestamp text; unparsable text becomes null."""
    col = _col(c)
    if isinstance(dtype, DateType):
        return col
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return F.to_date(col)
    if dtype is None or isinstance(dtype, StringType):
        return F.try_to_date(col)
    raise TypeError(f"cannot take a date of {dtype}")


def recency_months(last, asof: str) -> Column:
    """Months from ``last`` to the fixed date ``asof`` (Spark ``months_between``: whole
    months plus a 31-day fraction, rounded to 8 digits)."""
    return F.months_between(F.lit(asof).cast("date"), _col(last))


def span_years(last, first) -> Column:
    """Years between two dates as ``datediff / 365.25``."""
    return F.datediff(_col(last), _col(first)) / F.lit(DAYS_PER_YEAR)


def rate_per_year(count, span, zero: str = "null") -> Column:
    """``count / span``. A zero span gives null (``zero="null"``) or the count itself
    (``zero="count"``, one event means one per year)."""
    rate = F.try_divide(_col(count).cast("double"), _col(span))
    if zero == "null":
        return rate
    if zero == "count":
        return F.coalesce(rate, _col(count).cast("double"))
    raise ValueError(f"unknown zero rule {zero!r}")


def tenure_months(since, asof: str, dtype=None) -> Column:
    """Months (of 2,629,743 s) from ``since`` (timestamp or its text) to ``asof``,
    rounded to 3 places. Text is read in the session time zone."""
    col = _col(since)
    ts = F.try_to_timestamp(col) if dtype is None or isinstance(dtype, StringType) \
        else col.cast("timestamp")
    secs = F.unix_timestamp(F.lit(asof).cast("timestamp")) - F.unix_timestamp(ts)
    return F.round(secs / F.lit(SECONDS_PER_MONTH), 3)
