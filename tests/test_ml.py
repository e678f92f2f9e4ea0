"""Spark ML wiring: determinism, separable data, importance, selection, tuning."""

from pyspark.sql import functions as F

from featuremill.operators import models as M
from featuremill.operators.evaluate import exact_auc
from featuremill.plans.report import run_models


def _separable(spark, n=400):
    df = spark.range(n).select(
        F.col("id").alias("business_id"),
        (F.col("id") % 2).cast("int").alias("target"),
        ((F.col("id") % 2) * 3 + F.rand(5)).alias("x1"),
        F.rand(6).alias("noise"),
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("cat"))
    return df


def test_separable_auc_and_determinism(spark):
    df = _separable(spark)
    f = M.fit_features(df, "target")
    data = f.transform(df).select("business_id", "features", "label").cache()
    m1, m2 = M.fit_rf(data), M.fit_rf(data)
    p1 = M.scored(m1, data, "business_id")
    p2 = M.scored(m2, data, "business_id")
    assert exact_auc(p1, "label", "p1").first()["auc"] > 0.9
    a = sorted((r[0], r[3]) for r in p1.collect())
    b = sorted((r[0], r[3]) for r in p2.collect())
    assert a == b
    lr = M.fit_lr(data)
    assert exact_auc(M.scored(lr, data), "label", "p1").first()["auc"] > 0.9
    coef = {r[0]: r[1] for r in M.coefficients_df(lr, data).collect()}
    assert abs(coef["x1"]) > abs(coef["noise"])
    imp = M.feature_importance(m1, data)
    assert imp.first()["feature"] == "x1"
    table = [("x1", False), ("noise", False), ("cat", True)]
    assert M.important_columns(imp, table, 0.5) == ["x1"]
    assert abs(sum(r["score"] for r in imp.collect()) - 1) < 1e-9


def test_important_columns_match_exactly(spark):
    imp = spark.createDataFrame([("hasTv_null", 0.5), ("hasTv", 0.001), ("goodForKids_null", 0.2),
                                 ("goodForKids", 0.0), ("lang_en", 0.3), ("lang_group_x", 0.2)],
                                "feature string, score double")
    table = [("hasTv", False), ("hasTv_null", False), ("goodForKids", False),
             ("goodForKids_null", False), ("lang", True), ("lang_group", True), ("source", True)]
    assert M.important_columns(imp, table, 0.01) == ["hasTv_null", "goodForKids_null", "lang",
                                                     "lang_group"]


def test_refit_forest_has_default_size(spark):
    df = _separable(spark, 200)
    model = M.refit_rf(M.fit_features(df, "target").transform(df).select("features", "label"))
    assert model.getNumTrees == 20 and model.getOrDefault("maxDepth") == 5


def test_lr_probability_is_the_sigmoid_of_its_coefficients(spark):
    import math
    df = _separable(spark, 200)
    data = M.fit_features(df, "target").transform(df)
    lr = M.fit_lr(data)
    w, b = lr.coefficients.toArray(), lr.intercept
    for r in lr.transform(data).select("features", "probability").limit(50).collect():
        want = 1 / (1 + math.exp(-(float(r["features"].toArray() @ w) + b)))
        assert abs(r["probability"][1] - want) < 1e-9

def test_cross_validation_best_params(spark):
    df = _separable(spark, 200)
    data = M.fit_features(df, "target").transform(df).select("features", "label")
    grid = {"maxDepth": [1, 3], "numTrees": [3]}
    cv = M.tune(M.rf(), grid, data, folds=2, parallelism=2)
    best = M.best_params(cv, grid)
    assert best["maxDepth"] in (1, 3) and best["numTrees"] == 3
    assert M.cv_metrics(cv, grid).count() == 2
    assert M.grid_table(spark, M.LR_GRID).count() == 36
    assert M.grid_table(spark, M.RF_GRID).count() == 27
    assert M.grid_table(spark, M.GBT_GRID).count() == 18


def test_search_marks_its_best_setting(spark):
    from conftest import SF001
    from featuremill.plans.q_ml import search
    rows = search(spark, SF001, M.rf(), {"maxDepth": [2, 5], "numTrees": [5]}, folds=2).collect()
    assert len(rows) == 2
    best = [r for r in rows if r["best"] == 1]
    assert len(best) == 1 and best[0]["auc"] == max(r["auc"] for r in rows)


def test_run_models_report(spark):
    rep = run_models(_separable(spark, 300))
    rows = rep.collect()
    names = {r["model"] for r in rows}
    assert {"lr", "rf", "rf_tuned", "gbt", "gbt_tuned", "rf_selected"} <= names
    assert all(r["auc"] > 0.8 for r in rows if r["split"] == "train")


def test_exact_metrics_agree_with_spark_evaluators(spark):
    from pyspark.ml.evaluation import (BinaryClassificationEvaluator,
                                       MulticlassClassificationEvaluator)
    from featuremill.operators.evaluate import accuracy
    df = _separable(spark, 300).withColumn("x1", F.col("x1") + F.rand(9) * 3)
    data = M.fit_features(df, "target").transform(df).select("features", "label")
    pred = M.fit_lr(data).transform(data)
    ours = M.positive_probability(pred)
    exact = exact_auc(ours, "label", "p1").first()["auc"]
    binned = BinaryClassificationEvaluator().evaluate(pred)
    assert abs(exact - binned) < 1e-3
    acc = accuracy(pred).first()["accuracy"]
    mc = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(pred)
    assert abs(acc - mc) < 1e-12
