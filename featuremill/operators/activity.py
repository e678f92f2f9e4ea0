"""Activity features per entity: count, recency, span and yearly rate (check-ins, tips).

One ``groupBy(key)`` with algebraic aggregates (min, max, count, sum): Spark computes
them partially on the map side, so a hot key costs one row per partition in the shuffle.
The derived measures are per-group scalars computed after the aggregate.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremill.functions.columns import cast_safe
from featuremill.functions.dates import (rate_per_year, recency_months, span_years,
                                         to_date_safe)


@dataclass(frozen=True)
class ActivityNames:
    count: str
    recency: str
    span: str
    rate: str


# Output names of the two activity roll-ups of the original feature table.
CHECKIN_NAMES = ActivityNames("checkin_count", "checkin_recency_months", "checkin_date_diff",
                              "avg_checkin_yr")
TIP_NAMES = ActivityNames("users_tip_ct", "tips_recency_months", "tips_date_diff",
                          "avg_tips_year")
# Fixed value: the as-of date of the activity features.
ACTIVITY_ASOF = "2020-03-01"


@dataclass(frozen=True)
class ActivitySpec:
    key: str
    ts: str
    names: ActivityNames
    count_of: str | None = None          # column whose non-null values are counted; None = rows
    sums: dict = field(default_factory=dict)   # {out: (column, cast_to or None)}
    zero: str = "null"                   # rate for a zero span: "null" or "count"
    asof: str = ACTIVITY_ASOF


def activity_span(df: DataFrame, key: str, ts: str, count_of: str | None = None,
                  count_name: str = "n", sums: dict | None = None) -> DataFrame:
    """First and last date, count (and optional sums) per ``key``."""
    day = to_date_safe(ts, df.schema[ts].dataType)
    aggs = [F.min(day).alias("_first"), F.max(day).alias("_last"),
            (F.count(count_of) if count_of else F.count(F.lit(1))).alias(count_name)]
    for out, (c, cast_to) in (sums or {}).items():
        val = cast_safe(c, cast_to) if cast_to else F.col(c)
        aggs.append(F.sum(val).alias(out))
    return df.groupBy(key).agg(*aggs)


def activity_features(df: DataFrame, spec: ActivitySpec) -> DataFrame:
    """``key, count, [sums], recency (months), span (years), rate (per year)``."""
    n = spec.names
    g = activity_span(df, spec.key, spec.ts, spec.count_of, n.count, spec.sums)
    span = span_years("_last", "_first")
    return g.select(
        spec.key, n.count, *spec.sums.keys(),
        recency_months("_last", spec.asof).alias(n.recency),
        span.alias(n.span),
        rate_per_year(F.col(n.count), span, spec.zero).alias(n.rate),
    )


def checkin_spec(key="business_id", ts="date", asof=ACTIVITY_ASOF) -> ActivitySpec:
    """Check-ins: a business seen on one day only has no yearly rate (null)."""
    return ActivitySpec(key, ts, CHECKIN_NAMES, count_of=key, zero="null", asof=asof)


def tip_spec(key="business_id", ts="date", user="user_id", compliments="compliment_count",
             asof=ACTIVITY_ASOF) -> ActivitySpec:
    """Tips: counts tipping users, sums compliments; one-day span -> rate = count."""
    return ActivitySpec(key, ts, TIP_NAMES, count_of=user,
                        sums={"total_compliment_ct": (compliments, "int")},
                        zero="count", asof=asof)
