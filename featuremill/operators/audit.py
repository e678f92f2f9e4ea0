"""Fitted models checked against their own parameters, inside Spark.

A score is worth as much as the way it can be followed: each function takes a fitted model and
scored rows, works the probability out again from what the model exports (coefficients, single
trees and their weights), and tells per row whether both agree.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Largest difference of two probabilities that count as equal.
TOLERANCE = 1e-9


def _agrees(scored: DataFrame, again: Column, key: str) -> DataFrame:
    p1 = vector_to_array("probability").getItem(1)
    return scored.select(key, (F.abs(p1 - again) < TOLERANCE).alias("agrees"),
                         (F.col("prediction") == F.when(p1 > 0.5, 1.0).otherwise(0.0)).alias("decided"))


def check_linear(model, df: DataFrame, key: str) -> DataFrame:
    """(key, agrees, decided) for a logistic regression: the probability is the sigmoid of the
    coefficients' sum, and the prediction its side of one half."""
    weights = F.array(*[F.lit(float(w)) for w in model.coefficients.toArray()])
    dot = F.aggregate(F.zip_with(vector_to_array("features"), weights, lambda x, w: x * w), F.lit(0.0), lambda a, x: a + x)
    return _agrees(model.transform(df), 1 / (1 + F.exp(-(dot + F.lit(float(model.intercept))))), key)


def check_forest(model, df: DataFrame, key: str) -> DataFrame:
    """For a random forest: the probability is the mean of its trees' leaf shares."""
    out, parts = model.transform(df), []
    for i, tree in enumerate(model.trees):
        own = tree.setProbabilityCol(f"_p{i}").setRawPredictionCol(f"_r{i}").setPredictionCol(f"_c{i}")
        out = own.transform(out)
        parts.append(vector_to_array(f"_p{i}").getItem(1))
    return _agrees(out, reduce(lambda a, b: a + b, parts) / len(parts), key)


def check_boosted(model, df: DataFrame, key: str) -> DataFrame:
    """For boosted trees: the probability is the sigmoid of twice the weighted sum of the trees."""
    out, parts = model.transform(df), []
    for i, (tree, weight) in enumerate(zip(model.trees, model.treeWeights)):
        out = tree.setPredictionCol(f"_t{i}").transform(out)
        parts.append(F.col(f"_t{i}") * float(weight))
    return _agrees(out, 1 / (1 + F.exp(-2 * reduce(lambda a, b: a + b, parts))), key)


def rank_sum_auc(scored: DataFrame, label: str = "label", score: str = "p1") -> DataFrame:
    """One row, ``auc``: from the average ranks of equal scores (a second way beside ``exact_auc``). The
    running counts are taken over one row a score, by ranges of the score."""
    per = scored.groupBy(F.col(score).alias("s")).agg(F.count(F.lit(1)).alias("n"),
                                                     F.count_if(F.col(label) > 0.5).alias("pos"))
    # a score's range by its bits' beginning: at most 4,096 ranges, summed in a small table
    bucket = F.floor(F.col("s") * 4096).cast("int")
    ranged = per.withColumn("b", bucket)
    before = ranged.groupBy("b").agg(F.sum("n").alias("bn")).withColumn(
        "below", F.coalesce(F.sum("bn").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inside = F.coalesce(F.sum("n").over(Window.partitionBy("b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)),
                        F.lit(0))
    ranks = (ranged.withColumn("inside", inside).join(F.broadcast(before.select("b", "below")), "b")
             .withColumn("rank", F.col("below") + F.col("inside") + (F.col("n") + 1) / 2))
    total = ranks.agg(F.sum(F.col("rank") * F.col("pos")).alias("r"), F.sum("pos").alias("p"), F.sum("n").alias("n"))
    return total.select(F.try_divide(F.col("r") - F.col("p") * (F.col("p") + 1) / 2,
                                     F.col("p") * (F.col("n") - F.col("p"))).alias("auc"))
