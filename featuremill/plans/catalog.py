"""Registered queries: each key pairs a Spark plan over the driver's tables with the
DuckDB SQL that computes the same result independently (``None`` = no SQL form; checked
on rows only, and by tests).

Comparison protocol: averages of floating values are rounded to 9 places on both sides
(summation order differs between engines); sums of integers are cast to BIGINT in SQL
(DuckDB widens them to HUGEINT).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremill.plans import standins as S


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: Callable[[], str] | None


REGISTRY: dict[str, Query] = {}


def register(name: str, sql=None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"query {name!r} registered twice")
        REGISTRY[name] = Query(name, fn, sql)
        return fn
    return deco


def role(spark, sf, name):
    return S.role(spark, sf, name)


def T(name: str) -> str:
    """DuckDB subquery text of a stand-in role."""
    return S.role_sql(name)


def round_cols(df: DataFrame, cols, places: int = 9) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), places) for c in cols})


# -- SQL fragments ----------------------------------------------------------------------

def sql_months_between(asof: str, last: str) -> str:
    a = f"DATE '{asof}'"
    return (f"round(12 * (year({a}) - year({last})) + (month({a}) - month({last})) + "
            f"CASE WHEN day({a}) = day({last}) OR ({a} = last_day({a}) AND "
            f"{last} = last_day({last})) THEN 0 ELSE (day({a}) - day({last})) / 31.0::DOUBLE "
            f"END, 8)")


def sql_to_date(c: str) -> str:
    return f"CAST(TRY_CAST({c} AS TIMESTAMP) AS DATE)"


def sql_activity(src: str, count_of: str, names, zero: str, sums: str = "",
                 sum_cols: str = "", asof: str = "2020-03-01") -> str:
    """Activity features of ``src`` (business_id, date, ...) in DuckDB."""
    span = "datediff('day', f, l) / 365.25::DOUBLE"
    rate = f"n / nullif({span}, 0)"
    if zero == "count":
        rate = f"coalesce({rate}, CAST(n AS DOUBLE))"
    return f"""(SELECT business_id, n AS {names.count}{sum_cols},
  {sql_months_between(asof, 'l')} AS {names.recency},
  {span} AS {names.span}, {rate} AS {names.rate}
FROM (SELECT business_id, min(d) AS f, max(d) AS l, count({count_of}) AS n{sums}
      FROM (SELECT *, {sql_to_date('date')} AS d FROM {src}) GROUP BY business_id))"""


def all_queries() -> dict[str, Query]:
    """Every registered query (importing the modules registers them)."""
    from featuremill.plans import q_features  # noqa: F401
    for mod in ("q_relational", "q_ml"):
        try:
            __import__(f"featuremill.plans.{mod}")
        except ModuleNotFoundError as e:
            if e.name != f"featuremill.plans.{mod}":
                raise
    return dict(REGISTRY)
