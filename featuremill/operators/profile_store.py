"""A null profile that grows with the files, without reading the old ones again.

Every arrival is profiled by one aggregate into one row per column: rows, missing values, smallest
and largest value, and a sketch of the distinct values. All of these merge, so the profile of
everything that has arrived is an aggregate over those few rows, and the choice of columns by
their missing share is taken anew after each arrival at no cost to speak of. An arrival that
is profiled again replaces its own rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from featuremill.functions.columns import is_missing
from featuremill.operators.profile import NullFilterSpec

#: log2 of the buckets of the distinct-value sketch (a relative error of about 1.6 %).
SKETCH_BITS = 12


def profile_rows(df: DataFrame) -> DataFrame:
    """One row per column of ``df``, in one aggregate: position, column_name, n_rows, n_missing, low and
    high (texts), low_number and high_number, and a sketch of the distinct values that are not missing."""
    aggs, rows = [F.count(F.lit(1)).alias("_n")], []
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        own = F.when(~is_missing(c, f.dataType), c)
        numeric = isinstance(f.dataType, NumericType)
        aggs += [F.count_if(is_missing(c, f.dataType)).alias(f"_m{i}"),
                 F.min(own.cast("string")).alias(f"_lt{i}"), F.max(own.cast("string")).alias(f"_ht{i}"),
                 F.min(own.cast("double") if numeric else F.lit(None).cast("double")).alias(f"_ln{i}"),
                 F.max(own.cast("double") if numeric else F.lit(None).cast("double")).alias(f"_hn{i}"),
                 F.hll_sketch_agg(own.cast("string"), F.lit(SKETCH_BITS)).alias(f"_s{i}")]
        rows.append(F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"), F.col("_n").alias("n_rows"),
                             F.col(f"_m{i}").alias("n_missing"), F.col(f"_lt{i}").alias("low"),
                             F.col(f"_ht{i}").alias("high"), F.col(f"_ln{i}").alias("low_number"),
                             F.col(f"_hn{i}").alias("high_number"), F.col(f"_s{i}").alias("distinct_sketch")))
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


@dataclass(frozen=True)
class ProfileStore:
    """The profile rows of all arrivals under ``base``, a folder that all executors see."""
    base: str

    def add(self, df: DataFrame, arrival: int) -> None:
        """Profiles one arrival; the same number again replaces it."""
        profile_rows(df).coalesce(1).write.mode("overwrite").parquet(f"{self.base}/arrival={arrival}")

    def profile(self, spark: SparkSession) -> DataFrame:
        """The null profile of all arrivals, as ``profile.null_profile`` gives it, and low, high,
        low_number, high_number, n_distinct (about). A column that an arrival lacks is missing in all
        of its rows."""
        rows = spark.read.parquet(self.base)
        total = rows.select("arrival", "n_rows").distinct().agg(F.sum("n_rows")).first()[0] or 0  # one number
        merged = rows.groupBy("column_name").agg(
            F.min("position").alias("position"), F.sum("n_rows").alias("_seen"), F.sum("n_missing").alias("_missing"),
            F.min("low").alias("low"), F.max("high").alias("high"), F.min("low_number").alias("low_number"),
            F.max("high_number").alias("high_number"),
            F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("n_distinct"))
        n = F.col("_missing") + F.col("n_rows") - F.col("_seen")
        return merged.withColumn("n_rows", F.lit(total).cast("long")).select(
            "column_name", n.alias("n_missing"), "n_rows",
            F.try_divide(n.cast("double"), F.col("n_rows")).alias("missing_share"),
            "low", "high", "low_number", "high_number", "n_distinct", "position")

    def null_filter(self, spark: SparkSession, max_share: float = 0.75) -> NullFilterSpec:
        """The choice of columns that all arrivals together ask for."""
        rows = self.profile(spark).orderBy("position", "column_name").collect()
        keep = {r.column_name: r.n_rows == 0 or r.n_missing / r.n_rows <= max_share for r in rows}
        return NullFilterSpec(tuple(c for c, k in keep.items() if k), tuple(c for c, k in keep.items() if not k), max_share)
