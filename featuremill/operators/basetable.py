"""Base table assembly: entity x label (inner), then one left join per feature table.

All joins are on the entity key. Every feature table is an aggregate by that key, so it
arrives hash-partitioned on it; after the first join the chain keeps that partitioning and
only the small per-key feature tables move. AQE turns a join into a broadcast when the
runtime size of a side is under the broadcast threshold (a measured, not assumed, size).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremill.operators.encode import fill_defaults, label_target
from featuremill.operators.profile import dedup


def label_table(label: DataFrame, key: str, label_col: str) -> DataFrame:
    """One row per (key, label); a key with two different labels has two rows."""
    return dedup(label.select(key, label_col), [key, label_col])


def assemble(entity: DataFrame, label: DataFrame, features, key: str) -> DataFrame:
    """``entity`` inner ``label``, then left joins of each feature table on ``key``."""
    out = entity.join(label, [key], "inner")
    for f in features:
        clash = (set(f.columns) & set(out.columns)) - {key}
        if clash:
            raise ValueError(f"feature table repeats columns {sorted(clash)}")
        out = out.join(f, [key], "left")
    return out


def base_table(entity: DataFrame, label: DataFrame, features, key: str = "business_id",
               label_col: str = "delivery_or_takeout", true_tokens=("TRUE",),
               target: str = "target", conflict: str = "keep") -> DataFrame:
    """The model table: one row per entity and label, nulls filled (numbers 0, text "0"),
    ``target`` 1 when the label text is one of ``true_tokens``. An entity with both labels
    has two rows (``conflict="keep"``) or one with target 1 (``"any_true"``)."""
    if conflict not in ("keep", "any_true"):
        raise ValueError(f"unknown conflict rule {conflict!r}")
    lab = label_table(label, key, label_col)
    if conflict == "any_true":
        lab = lab.groupBy(key).agg(
            F.max(F.col(label_col).isin(list(true_tokens)).cast("int")).alias("_any"))
        lab = lab.select(key, F.when(F.col("_any") == 1, F.lit(true_tokens[0]))
                         .otherwise(F.lit("FALSE")).alias(label_col))
    out = fill_defaults(assemble(entity, lab, features, key))
    return label_target(out, label_col, target, true_tokens)
