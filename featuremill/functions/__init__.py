"""Column-level helpers: every function returns a ``Column`` built from
built-in Spark expressions (whole-stage codegen, no Python in the data path)."""

from featuremill.functions.columns import (cast_safe, is_missing, list_size, sanitize_name,
                                           sum_columns)
from featuremill.functions.dates import (rate_per_year, recency_months, span_years,
                                         tenure_months, to_date_safe)
from featuremill.functions.predicates import contains_token, flag_set, isin_any, not_true

__all__ = [
    "cast_safe", "is_missing", "list_size", "sanitize_name", "sum_columns",
    "rate_per_year", "recency_months", "span_years", "tenure_months", "to_date_safe",
    "contains_token", "flag_set", "isin_any", "not_true",
]
