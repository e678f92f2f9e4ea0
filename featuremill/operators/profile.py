"""Profiling: frequency tables, null profile and null-share column filter, duplicate
audits, distinct values and top-k.

Each profile is one job: many frequency tables become one unpivot + ``groupBy``; the null
profile of every column and the row count come from one global aggregate (partial per
partition, one row per partition reaches the final step).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featuremill.functions.columns import is_missing


def value_counts(df: DataFrame, cols, count_of: str | None = None,
                 ordered: bool = True) -> DataFrame:
    """``(column_name, value, count)`` for each listed column, in one shuffle.

    Values are compared as text so that columns of different types share one table.
    ``count_of`` counts its non-null values (as ``count(key)``); default counts rows.
    """
    cols = list(cols)
    if len(cols) == 1:
        c = cols[0]
        n = F.count(count_of) if count_of else F.count(F.lit(1))
        out = df.groupBy(F.lit(c).alias("column_name"),
                         F.col(c).cast("string").alias("value")).agg(n.alias("count"))
    else:
        keep = [count_of] if count_of and count_of not in cols else []
        long = df.select(*keep, F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
            for c in cols])).alias("_kv"))
        n = F.count(count_of) if count_of else F.count(F.lit(1))
        out = long.groupBy(F.col("_kv.column_name").alias("column_name"),
                           F.col("_kv.value").alias("value")).agg(n.alias("count"))
    if ordered:
        out = out.orderBy("column_name", F.col("count").desc(), F.col("value").asc_nulls_first())
    return out


def ranked_values(df: DataFrame, cols, k: int = 10, count_of: str | None = None) -> DataFrame:
    """``value_counts`` with the ``rank`` of each value in its column, the ``k`` most frequent ones
    of every column (equal counts by value, a null value first). Each task keeps its own first
    ``k`` of a column before they are shuffled, so no column's values meet in one task."""
    place = Window.partitionBy("column_name").orderBy(F.col("count").desc(), F.col("value").asc_nulls_first())
    counts = value_counts(df, cols, count_of, ordered=False)
    return counts.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)


def _missing_counts(df: DataFrame) -> DataFrame:
    """One row: ``_n`` rows and ``_m{i}`` missing values of column ``i``."""
    return df.agg(F.count(F.lit(1)).alias("_n"), *[
        F.count_if(is_missing(F.col(f"`{f.name}`"), f.dataType)).alias(f"_m{i}")
        for i, f in enumerate(df.schema.fields)])


def null_profile(df: DataFrame) -> DataFrame:
    """``(column_name, n_missing, n_rows, missing_share)`` for every column, one scan.

    Missing = null, or NaN in floating and string columns. ``missing_share`` is null for
    an empty table.
    """
    rows = F.explode(F.array(*[
        F.struct(F.lit(f.name).alias("column_name"), F.col(f"_m{i}").alias("n_missing"))
        for i, f in enumerate(df.schema.fields)])).alias("_r")
    return _missing_counts(df).select(F.col("_n").alias("n_rows"), rows).select(
        "_r.column_name", "_r.n_missing", "n_rows",
        F.try_divide(F.col("n_missing").cast("double"), F.col("n_rows")).alias("missing_share"))


@dataclass(frozen=True)
class NullFilterSpec:
    """Fitted column choice: keep columns whose missing share is at most ``max_share``."""
    kept: tuple
    removed: tuple
    max_share: float

    def apply(self, df: DataFrame) -> DataFrame:
        absent = [c for c in self.kept if c not in df.columns]
        if absent:
            raise ValueError(f"columns of the fitted spec are missing: {absent}")
        return df.select(*[F.col(f"`{c}`") for c in self.kept])


def null_filter_table(df: DataFrame, max_share: float = 0.75) -> DataFrame:
    """``null_profile`` plus ``kept`` (1/0): share <= limit, or an empty table."""
    return null_profile(df).withColumn("kept", F.when(
        F.coalesce(F.col("missing_share") <= max_share, F.col("n_rows") == 0), 1).otherwise(0))


def fit_null_filter(df: DataFrame, max_share: float = 0.75) -> NullFilterSpec:
    """One action returning one row (as wide as the schema): the same rule as
    ``null_filter_table``, applied on the driver to the per-column counts."""
    row = _missing_counts(df).first()
    n = row["_n"]
    keep = [n == 0 or row[f"_m{i}"] / n <= max_share for i in range(len(df.columns))]
    kept = tuple(c for c, k in zip(df.columns, keep) if k)
    removed = tuple(c for c, k in zip(df.columns, keep) if not k)
    return NullFilterSpec(kept, removed, max_share)


def repeated_pairs(df: DataFrame, keys, more_than: int = 2) -> DataFrame:
    """Key combinations that occur more than ``more_than`` times, with their count."""
    return df.groupBy(*keys).count().where(F.col("count") > more_than)


def distinct_values(df: DataFrame, cols) -> DataFrame:
    return df.select(*cols).distinct()


def count_distinct(df: DataFrame, c: str) -> DataFrame:
    """Rows and distinct non-null values of ``c`` in one aggregate."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(c).alias("n_distinct"))


def dedup(df: DataFrame, keys) -> DataFrame:
    """One row per ``keys``; with other columns present the surviving row is arbitrary,
    so callers select the key columns (as the label table does)."""
    return df.dropDuplicates(list(keys))


def top_k(df: DataFrame, by: str, k: int, tie: str | None = None) -> DataFrame:
    """The ``k`` largest rows by ``by``; ``tie`` orders equal values (a top-k sort, not a
    global sort)."""
    order = [F.col(by).desc()] + ([F.col(tie).asc_nulls_first()] if tie else [])
    return df.orderBy(*order).limit(k)
