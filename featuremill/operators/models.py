"""Spark ML on the base table: formula features, LR / RF / GBT fits, scoring, summaries,
coefficients, feature importance and selection, parameter grids and cross-validation.

Fitting is Spark's own distributed training; this module only wires it: the formula is
fitted once on the training rows and reused for test and new data, every estimator gets
an explicit seed, the training table is persisted around iterative fits, and the positive
class probability is read with ``vector_to_array`` (JVM) instead of a Python UDF.
"""

from __future__ import annotations

import itertools

from pyspark.ml import Model
from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import RFormula
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremill.operators.evaluate import accuracy, exact_auc

# The estimator settings and tuning grids of the original model study.
LR_DEFAULTS = dict(family="binomial", standardization=True)
RF_DEFAULTS = dict(numTrees=10, maxDepth=10, seed=123)
RF_TUNED = dict(maxDepth=10, maxBins=10, numTrees=20)
GBT_DEFAULTS = dict(maxIter=10)
GBT_TUNED = dict(maxIter=10, maxDepth=5, maxBins=10, stepSize=0.2)
LR_GRID = {"regParam": [0.01, 0.1, 0.5, 2.0], "elasticNetParam": [0.0, 0.5, 1.0],
           "maxIter": [1, 5, 10]}
RF_GRID = {"maxDepth": [2, 5, 10], "maxBins": [5, 10, 20], "numTrees": [5, 10, 20]}
GBT_GRID = {"maxDepth": [2, 5, 10], "maxBins": [5, 10, 20], "stepSize": [0.1, 0.2]}
#: The forest refitted on selected features: Spark's own default size.
RF_REFIT = dict(numTrees=20, maxDepth=5)
TRAIN_FRACTION = 0.8
SPLIT_SEED = 200
SELECT_IMPORTANCE = 0.01
DEFAULT_SEED = 123


def fit_features(train: DataFrame, target: str = "target", exclude=("business_id",),
                 features_col: str = "features", label_col: str = "label"):
    """``RFormula("target ~ . - key")`` fitted on the training rows only. String columns
    are indexed and one-hot encoded; categories unseen in training are kept, not failed."""
    formula = f"{target} ~ ." + "".join(f" - {c}" for c in exclude)
    return RFormula(formula=formula, featuresCol=features_col, labelCol=label_col,
                    handleInvalid="keep").fit(train)


def _fit(estimator, train: DataFrame, cache: bool = True) -> Model:
    if cache:
        train = train.persist()
    try:
        return estimator.fit(train)
    finally:
        if cache:
            train.unpersist()


def lr(**params) -> LogisticRegression:
    p = {**LR_DEFAULTS, **params}
    return LogisticRegression(featuresCol="features", labelCol="label", **p)


def rf(**params) -> RandomForestClassifier:
    p = {"seed": DEFAULT_SEED, **params}
    return RandomForestClassifier(featuresCol="features", labelCol="label", **p)


def gbt(**params) -> GBTClassifier:
    p = {"seed": DEFAULT_SEED, **params}
    return GBTClassifier(featuresCol="features", labelCol="label", **p)


def fit_lr(train: DataFrame, **params) -> Model:
    return _fit(lr(**params), train)


def refit_rf(train: DataFrame) -> Model:
    """The forest on selected features."""
    return _fit(rf(**RF_REFIT), train)


def fit_rf(train: DataFrame, **params) -> Model:
    return _fit(rf(**{**RF_DEFAULTS, **params}), train)


def fit_gbt(train: DataFrame, **params) -> Model:
    return _fit(gbt(**{**GBT_DEFAULTS, **params}), train)


def positive_probability(pred: DataFrame, probability: str = "probability",
                         out: str = "p1") -> DataFrame:
    """Adds the probability of class 1 as a double column (JVM-side, no Python UDF)."""
    return pred.withColumn(out, vector_to_array(F.col(probability)).getItem(1))


def scored(model: Model, df: DataFrame, key: str | None = None) -> DataFrame:
    """``key, label, prediction, p1`` for every row of ``df`` (already featurised)."""
    pred = positive_probability(model.transform(df))
    cols = ([key] if key else []) + ["label", "prediction", "p1"]
    return pred.select(*cols)


def training_summary(model: Model, train: DataFrame) -> DataFrame:
    """``(metric, value)`` rows -- exact AUC and accuracy on the training rows -- for every
    model type (boosted trees have no built-in training summary, so the training set is
    scored the same way for all)."""
    pred = scored(model, train)
    auc = exact_auc(pred, "label", "p1").select(F.lit("auc").alias("metric"),
                                                 F.col("auc").alias("value"))
    acc = accuracy(pred).select(F.lit("accuracy").alias("metric"),
                                F.col("accuracy").alias("value"))
    return auc.unionByName(acc)


def attribute_names(df: DataFrame, features_col: str = "features") -> list:
    """Feature names by vector index, from the ``ml_attr`` column metadata."""
    meta = df.schema[features_col].metadata.get("ml_attr", {})
    attrs = [a for group in meta.get("attrs", {}).values() for a in group]
    names = [None] * meta.get("num_attrs", len(attrs))
    for a in attrs:
        names[a["idx"]] = a["name"]
    return [n if n is not None else f"f{i}" for i, n in enumerate(names)]


def coefficients_df(model: Model, featurised: DataFrame,
                    features_col: str = "features") -> DataFrame:
    """``(feature, coefficient)`` of a logistic regression, intercept last."""
    names = attribute_names(featurised, features_col)
    rows = list(zip(names, [float(x) for x in model.coefficients.toArray()]))
    rows.append(("(intercept)", float(model.intercept)))
    return featurised.sparkSession.createDataFrame(rows, "feature string, coefficient double")


def feature_importance(model: Model, featurised: DataFrame,
                       features_col: str = "features") -> DataFrame:
    """``(idx, feature, score)`` of a tree ensemble, highest score first. One row per
    feature: bounded by the width of the feature vector."""
    names = attribute_names(featurised, features_col)
    imp = model.featureImportances.toArray()
    rows = [(i, names[i], float(imp[i])) for i in range(len(names))]
    return (featurised.sparkSession.createDataFrame(rows, "idx int, feature string, score double")
            .orderBy(F.col("score").desc(), "idx"))


def important_columns(importance: DataFrame, table: DataFrame | list,
                      threshold: float = SELECT_IMPORTANCE):
    """Source columns with at least one feature scoring above ``threshold``. A feature is the
    column of its very name, or the one-hot value of a text column (``lang_en`` of ``lang``):
    the longest text column that it starts with. ``table``: the source table, or a list of
    ``(column, is_text)``."""
    columns = table if isinstance(table, list) else [
        (f.name, f.dataType.simpleString() == "string") for f in table.schema.fields]
    names = {c for c, _ in columns}
    texts = sorted((c for c, is_text in columns if is_text), key=len, reverse=True)
    kept = set()
    for row in importance.where(F.col("score") > threshold).collect():
        feature = row["feature"]
        source = feature if feature in names else next(
            (c for c in texts if feature.startswith(f"{c}_")), None)
        kept.add(source)
    return [c for c, _ in columns if c in kept]


def param_grid(estimator, grid: dict):
    """``ParamGridBuilder`` over ``{param name: values}``."""
    b = ParamGridBuilder()
    for name, values in grid.items():
        b = b.addGrid(estimator.getParam(name), values)
    return b.build()


def grid_table(spark, grid: dict) -> DataFrame:
    """The grid as rows (one per setting), for reporting."""
    names = list(grid)
    rows = [tuple(float(v) for v in combo) for combo in itertools.product(*grid.values())]
    schema = ", ".join(f"{n} double" for n in names)
    return spark.createDataFrame(rows, schema)


def tune(estimator, grid: dict, train: DataFrame, folds: int = 10, seed: int = DEFAULT_SEED,
         parallelism: int = 4):
    """k-fold cross-validation on AUC. ``parallelism`` fits several settings at once."""
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=param_grid(estimator, grid),
                        evaluator=BinaryClassificationEvaluator(), numFolds=folds, seed=seed,
                        parallelism=parallelism)
    return _fit(cv, train)


def best_params(cv_model, grid: dict) -> dict:
    """Settings of the best model for the tuned parameters (public getters only)."""
    best = cv_model.bestModel
    return {name: best.getOrDefault(best.getParam(name)) for name in grid}


def cv_metrics(cv_model, grid: dict) -> DataFrame:
    """One row per grid setting with its mean cross-validated AUC."""
    rows = []
    for pm, metric in zip(cv_model.getEstimatorParamMaps(), cv_model.avgMetrics):
        vals = {p.name: float(v) for p, v in pm.items()}
        rows.append(tuple(vals[n] for n in grid) + (float(metric),))
    schema = ", ".join(f"{n} double" for n in grid) + ", auc double"
    return SparkSession.getActiveSession().createDataFrame(rows, schema)
