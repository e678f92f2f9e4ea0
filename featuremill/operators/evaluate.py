"""Exact binary-classification metrics at scale: AUC, ROC points, accuracy, confusion.

AUC and ROC need, for every distinct score, the number of positives and negatives scored
at least as high. A window ordered over the whole table would pull every score into one
task, so the running sums are computed in range buckets instead:

1. ``groupBy(score)`` -> (pos, neg) per distinct score. A score shared by a third of the
   rows is one row from here on.
2. Those rows are range-partitioned by (group, score descending) and written once to the
   shared scratch folder with their partition number as bucket. Spark picks the ranges from
   a bounded sample of each partition, so the driver's share does not depend on the data.
3. Running sums inside each bucket (a window partitioned by bucket, so buckets run in
   parallel), plus an offset per bucket = the totals of all higher buckets, computed on the
   bucket table. Without groups that table has at most ``buckets`` rows and is broadcast
   back (bounded by construction); with groups it has up to ``groups + buckets`` rows, which
   grows with the data, so that join is left to AQE (a broadcast only when the measured
   size is small, else a shuffle join).

The written table is read twice (totals, running sums); a lost executor costs a re-read.

Ties count one half, so the AUC equals the Mann-Whitney statistic, not a binned estimate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featuremill.session import scratch_path


def _score_counts(df: DataFrame, label: str, score: str, by) -> DataFrame:
    y = F.col(label).cast("double")
    return (df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
            .groupBy(*by, F.col(score).cast("double").alias("score"))
            .agg(F.sum(F.when(y > 0.5, 1).otherwise(0)).cast("long").alias("pos"),
                 F.sum(F.when(y <= 0.5, 1).otherwise(0)).cast("long").alias("neg")))


def cumulative_counts(df: DataFrame, label: str = "label", score: str = "score",
                      buckets: int | None = None, by=()) -> DataFrame:
    """Per group of ``by`` and distinct score (descending): ``pos, neg`` at the score and
    ``tp, fp`` = positives and negatives scored at least as high; plus the group totals
    ``n_pos, n_neg``."""
    by = list(by)
    spark = df.sparkSession
    g = _score_counts(df, label, score, by)
    if buckets is None:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "scores")
    (g.repartitionByRange(buckets, *by, F.col("score").desc())
     .withColumn("_bucket", F.spark_partition_id()).write.parquet(path))
    gb = spark.read.parquet(path)
    # a group lies in consecutive buckets: at most groups + buckets rows
    totals = gb.groupBy(*by, "_bucket").agg(F.sum("pos").alias("_bp"), F.sum("neg").alias("_bn"))
    grp = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    above = grp.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by, "_bucket",
        F.coalesce(F.sum("_bp").over(above), F.lit(0)).alias("_tp0"),
        F.coalesce(F.sum("_bn").over(above), F.lit(0)).alias("_fp0"),
        F.sum("_bp").over(grp).alias("n_pos"),
        F.sum("_bn").over(grp).alias("n_neg"))
    within = (Window.partitionBy(*by, "_bucket").orderBy(F.col("score").desc())
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    offsets = offsets if by else F.broadcast(offsets)
    return (gb.join(offsets, [*by, "_bucket"])
            .select(*by, "score", "pos", "neg",
                    (F.col("_tp0") + F.sum("pos").over(within)).alias("tp"),
                    (F.col("_fp0") + F.sum("neg").over(within)).alias("fp"),
                    "n_pos", "n_neg"))


def exact_auc(df: DataFrame, label: str = "label", score: str = "score",
              buckets: int | None = None, by=()) -> DataFrame:
    """One row per group: ``(auc, n_pos, n_neg)``; ``auc`` is null when a class is absent."""
    c = cumulative_counts(df, label, score, buckets, by)
    return c.groupBy(*by).agg(
        F.try_divide(F.sum(F.col("neg") * (F.col("tp") - 0.5 * F.col("pos"))),
                     F.first("n_pos").cast("double") * F.first("n_neg")).alias("auc"),
        F.first("n_pos").alias("n_pos"), F.first("n_neg").alias("n_neg"))


def roc_points(df: DataFrame, label: str = "label", score: str = "score",
               buckets: int | None = None) -> DataFrame:
    """``(threshold, fpr, tpr)``: the origin (threshold null), then one point per distinct
    score from the highest down; the last point is (1, 1)."""
    c = cumulative_counts(df, label, score, buckets)
    pts = c.select(F.col("score").alias("threshold"),
                   F.try_divide(F.col("fp").cast("double"), F.col("n_neg")).alias("fpr"),
                   F.try_divide(F.col("tp").cast("double"), F.col("n_pos")).alias("tpr"))
    origin = df.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"),
                                             F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return origin.unionByName(pts)


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction",
             by=()) -> DataFrame:
    """Share of rows with ``label == prediction`` (per group of ``by``), one aggregate."""
    hit = (F.col(label).cast("double") == F.col(prediction).cast("double")).cast("double")
    return df.groupBy(*by).agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row ``tp, fp, fn, tn, predicted_pos``."""
    y = F.col(label).cast("double") > 0.5
    p = F.col(prediction).cast("double") > 0.5
    return df.agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
                  F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"),
                  F.count_if(p).alias("predicted_pos"))
