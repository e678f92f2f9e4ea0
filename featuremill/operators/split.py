"""Reproducible train/test split by a hash of the row key.

``randomSplit`` draws per partition, so the same seed gives another split when the input
is partitioned differently; a hash of the key does not depend on partitioning, and SQL
engines compute the same md5, so the split is checkable outside Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_bucket(key: str, salt: str = "", buckets: int = 100) -> Column:
    """``int(first 8 hex digits of md5(salt || key)) % buckets``."""
    text = F.concat(F.lit(salt), F.col(key).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % F.lit(buckets)


def hash_split(df: DataFrame, key: str, train_fraction: float = 0.8, salt: str = "200",
               buckets: int = 100):
    """``(train, test)``: train holds the buckets below ``train_fraction * buckets``."""
    cut = int(round(train_fraction * buckets))
    b = hash_bucket(key, salt, buckets)
    return df.where(b < cut), df.where(b >= cut)


def split_label(df: DataFrame, key: str, train_fraction: float = 0.8, salt: str = "200",
                buckets: int = 100, out: str = "split") -> DataFrame:
    """The split as a column (``train`` / ``test``) instead of two DataFrames."""
    cut = int(round(train_fraction * buckets))
    return df.withColumn(out, F.when(hash_bucket(key, salt, buckets) < cut, "train")
                         .otherwise("test"))
