"""Registered queries: hash split, exact evaluation (SQL-checked), Spark ML (rows only)."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featuremill.operators import audit as A
from featuremill.operators import models as M
from featuremill.operators.evaluate import accuracy, confusion, exact_auc, roc_points
from featuremill.operators.hashed import HashedFeatures
from featuremill.operators.search import GridSearch
from featuremill.operators.split import hash_split, split_label
from featuremill.plans.catalog import T, register, role
from featuremill.plans.q_features import flagship
from featuremill.plans.report import run_models
from featuremill.session import scratch_path
from featuremill.sources.files import load_table, save_table

SALT = str(M.SPLIT_SEED)


def _hash_bucket_sql(key: str) -> str:
    return (f"('0x' || substr(md5(concat('{SALT}', CAST({key} AS VARCHAR))), 1, 8))::BIGINT"
            " % 100")


def _scores(spark, sf) -> DataFrame:
    """A deterministic score with ties (length class) and a thresholded prediction."""
    m = role(spark, sf, "model")
    return m.select("doc_id", F.col("target").alias("label"),
                    F.floor(F.col("n_chars") / 250).cast("double").alias("score"),
                    F.when(F.col("n_chars") >= 2000, 1).otherwise(0).alias("prediction"))


def _scores_sql() -> str:
    return f"""(SELECT doc_id, target AS label, CAST(floor(n_chars / 250) AS DOUBLE) AS score,
  CASE WHEN n_chars >= 2000 THEN 1 ELSE 0 END AS prediction FROM {T('model')})"""


def _cum_sql() -> str:
    return f"""g AS (SELECT score, sum(CASE WHEN label > 0.5 THEN 1 ELSE 0 END) AS pos,
    sum(CASE WHEN label <= 0.5 THEN 1 ELSE 0 END) AS neg FROM {_scores_sql()}
    WHERE score IS NOT NULL AND label IS NOT NULL GROUP BY score),
  c AS (SELECT *, sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND
    CURRENT ROW) AS tp, sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING
    AND CURRENT ROW) AS fp FROM g),
  t AS (SELECT sum(pos) AS n_pos, sum(neg) AS n_neg FROM g)"""


@register("ml_hash_split", sql=lambda: f"""
SELECT doc_id, target, CASE WHEN {_hash_bucket_sql('doc_id')} < 80 THEN 'train' ELSE 'test' END
  AS split FROM {T('model')}""")
def q_hash_split(spark, sf):
    m = role(spark, sf, "model").select("doc_id", "target")
    return split_label(m, "doc_id", M.TRAIN_FRACTION, SALT)


@register("eval_auc", sql=lambda: f"""
WITH {_cum_sql()}
SELECT sum(neg * (tp - 0.5 * pos)) / (CAST((SELECT n_pos FROM t) AS DOUBLE) * (SELECT n_neg FROM t))
    AS auc,
  CAST((SELECT n_pos FROM t) AS BIGINT) AS n_pos, CAST((SELECT n_neg FROM t) AS BIGINT) AS n_neg
FROM c""")
def q_auc(spark, sf):
    return exact_auc(_scores(spark, sf), "label", "score")


@register("eval_roc_points", sql=lambda: f"""
WITH {_cum_sql()}
SELECT CAST(NULL AS DOUBLE) AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
UNION ALL
SELECT score AS threshold, CAST(fp AS DOUBLE) / (SELECT n_neg FROM t) AS fpr,
  CAST(tp AS DOUBLE) / (SELECT n_pos FROM t) AS tpr FROM c""")
def q_roc(spark, sf):
    return roc_points(_scores(spark, sf), "label", "score")


@register("eval_accuracy", sql=lambda: f"""
SELECT avg(CASE WHEN CAST(label AS DOUBLE) = CAST(prediction AS DOUBLE) THEN 1.0 ELSE 0.0 END)
    ::DOUBLE AS accuracy, count(*) AS n FROM {_scores_sql()}""")
def q_accuracy(spark, sf):
    return accuracy(_scores(spark, sf), "label", "prediction")


@register("eval_confusion", sql=lambda: f"""
SELECT count(*) FILTER (WHERE label > 0.5 AND prediction > 0.5) AS tp,
  count(*) FILTER (WHERE label <= 0.5 AND prediction > 0.5) AS fp,
  count(*) FILTER (WHERE label > 0.5 AND prediction <= 0.5) AS fn,
  count(*) FILTER (WHERE label <= 0.5 AND prediction <= 0.5) AS tn,
  count(*) FILTER (WHERE prediction > 0.5) AS predicted_pos FROM {_scores_sql()}""")
def q_confusion(spark, sf):
    return confusion(_scores(spark, sf), "label", "prediction")


# -- Spark ML on the document model table (rows-only checks) ------------------------------

def _featurised(spark, sf):
    m = role(spark, sf, "model")
    train_raw, test_raw = hash_split(m, "doc_id", M.TRAIN_FRACTION, SALT)
    formula = M.fit_features(train_raw, "target", exclude=("doc_id",))
    keep = ["doc_id", "features", "label"]
    return formula.transform(train_raw).select(*keep), formula.transform(test_raw).select(*keep)


def _features_sql() -> str:
    """The formula's vector: the length, then each text value of the training rows, most
    frequent first (ties by name), as its own 0/1 position."""
    return f"""
WITH m AS (SELECT *, CASE WHEN {_hash_bucket_sql('doc_id')} < 80 THEN 'train' ELSE 'test' END AS split
           FROM {T('model')}),
v AS (SELECT 1 AS col, lang AS value, count(*) AS n FROM m WHERE split = 'train' GROUP BY lang
      UNION ALL SELECT 2, source, count(*) FROM m WHERE split = 'train' GROUP BY source),
places AS (SELECT col, value, row_number() OVER (ORDER BY col, n DESC, value) AS idx FROM v
       WHERE value IS NOT NULL)
SELECT doc_id, split, CAST(target AS DOUBLE) AS label, 0 AS idx, CAST(n_chars AS DOUBLE) AS value FROM m
UNION ALL
SELECT doc_id, split, CAST(target AS DOUBLE), CAST(places.idx AS INTEGER),
       CASE WHEN places.value = CASE col WHEN 1 THEN lang ELSE source END THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
FROM m CROSS JOIN places"""


@register("ml_features", sql=_features_sql)
def q_features(spark, sf):
    """One row per document and position of its feature vector."""
    train, test = _featurised(spark, sf)
    both = train.withColumn("split", F.lit("train")).unionByName(
        test.withColumn("split", F.lit("test")))
    return both.select("doc_id", "split", "label",
                       F.posexplode(vector_to_array("features")).alias("idx", "value"))


HASH_WIDTH = 64


def _hashed(spark, sf):
    m = role(spark, sf, "model")
    return m, HashedFeatures.of(m, "target", exclude=("doc_id",), width=HASH_WIDTH)


def _hashed_sql() -> str:
    text = ", ".join(f"'{c}' || coalesce('=' || {c}, '')" for c in ("lang", "source"))
    return f"""h AS (SELECT doc_id, name, ('0x' || substr(md5(name), 1, 8))::BIGINT % {HASH_WIDTH} AS slot,
    CASE WHEN ('0x' || substr(md5(name), 9, 1))::BIGINT % 2 = 0 THEN 1 ELSE -1 END AS sign
  FROM (SELECT doc_id, unnest([{text}]) AS name FROM {T('model')}))"""


@register("ml_hashed_features", sql=lambda: f"""
WITH {_hashed_sql()},
s AS (SELECT doc_id, slot, sum(sign) AS value FROM h GROUP BY doc_id, slot)
SELECT doc_id, CAST(target AS DOUBLE) AS label, 0 AS idx, CAST(n_chars AS DOUBLE) AS value FROM {T('model')}
UNION ALL
SELECT m.doc_id, CAST(target AS DOUBLE), CAST(1 + p.slot AS INTEGER), CAST(coalesce(s.value, 0) AS DOUBLE)
FROM {T('model')} m CROSS JOIN (SELECT unnest(range({HASH_WIDTH})) AS slot) p
LEFT JOIN s ON s.doc_id = m.doc_id AND s.slot = p.slot""")
def q_hashed_features(spark, sf):
    """One row per document and position of its hashed vector, of the same width on every table."""
    m, layout = _hashed(spark, sf)
    return layout.transform(m, "target", keep=("doc_id",)).select(
        "doc_id", "label", F.posexplode(vector_to_array("features")).alias("idx", "value"))


@register("ml_hashed_names", sql=lambda: f"""
WITH {_hashed_sql()},
n AS (SELECT slot, sign, name, count(*) AS n FROM h GROUP BY slot, sign, name)
SELECT CAST(slot AS INTEGER) AS slot, name, sign, n AS count, values FROM (
  SELECT *, row_number() OVER (PARTITION BY slot ORDER BY n DESC, name) AS k,
         count(*) OVER (PARTITION BY slot) AS values FROM n) WHERE k = 1""")
def q_hashed_names(spark, sf):
    """The clearest feature of every slot in use."""
    m, layout = _hashed(spark, sf)
    return layout.slot_names(m)


def _pred(model, data):
    return M.scored(model, data, key="doc_id")


@register("ml_lr_predictions")
def q_lr(spark, sf):
    train, test = _featurised(spark, sf)
    return _pred(M.fit_lr(train), test)


@register("ml_lr_coefficients")
def q_lr_coef(spark, sf):
    train, _ = _featurised(spark, sf)
    return M.coefficients_df(M.fit_lr(train), train)


@register("ml_rf_predictions")
def q_rf(spark, sf):
    train, test = _featurised(spark, sf)
    return _pred(M.fit_rf(train), test)


@register("ml_gbt_predictions")
def q_gbt(spark, sf):
    train, test = _featurised(spark, sf)
    return _pred(M.fit_gbt(train, **M.GBT_TUNED), test)


@register("ml_positive_probability", sql=lambda: f"""
SELECT doc_id, (n_chars % 97 + 1) / (n_chars % 97 + n_chars % 89 + 2)::DOUBLE AS p1 FROM {T('model')}""")
def q_p1(spark, sf):
    """Reads the second entry of a probability vector that the table's lengths give."""
    a, b = F.col("n_chars") % 97 + 1, F.col("n_chars") % 89 + 1
    pred = role(spark, sf, "model").withColumn(
        "probability", array_to_vector(F.array(b / (a + b), a / (a + b))))
    return M.positive_probability(pred).select("doc_id", "p1")


@register("ml_tuned_probability")
def q_tuned_p1(spark, sf):
    """The tuned forest's probability of class 1 on the test rows."""
    train, test = _featurised(spark, sf)
    model = M.fit_rf(train, **M.RF_TUNED)
    return M.positive_probability(model.transform(test)).select("doc_id", "p1")


def _test_rows_sql(columns: str) -> str:
    return f"SELECT doc_id, {columns} FROM {T('model')} WHERE {_hash_bucket_sql('doc_id')} >= 80"


@register("ml_lr_follows", sql=lambda: _test_rows_sql("TRUE AS agrees, TRUE AS decided"))
def q_lr_follows(spark, sf):
    """Every test row's probability worked out again from the exported coefficients."""
    train, test = _featurised(spark, sf)
    return A.check_linear(M.fit_lr(train), test, "doc_id")


@register("ml_rf_follows", sql=lambda: _test_rows_sql("TRUE AS agrees, TRUE AS decided"))
def q_rf_follows(spark, sf):
    """The same from the forest's single trees."""
    train, test = _featurised(spark, sf)
    return A.check_forest(M.fit_rf(train, **M.RF_TUNED), test, "doc_id")


@register("ml_gbt_follows", sql=lambda: _test_rows_sql("TRUE AS agrees, TRUE AS decided"))
def q_gbt_follows(spark, sf):
    """The same from the boosted trees and their weights."""
    train, test = _featurised(spark, sf)
    return A.check_boosted(M.fit_gbt(train, **M.GBT_TUNED), test, "doc_id")


@register("ml_summary_follows", sql=lambda: """
SELECT model, metric, TRUE AS agrees FROM (SELECT unnest(['lr', 'rf', 'gbt']) AS model) CROSS JOIN
  (SELECT unnest(['auc', 'accuracy']) AS metric)""")
def q_summary_follows(spark, sf):
    """The training summary against a second way to each metric: rank sums, and counted agreement."""
    train, _ = _featurised(spark, sf)
    parts = []
    for name, model in {"lr": M.fit_lr(train), "rf": M.fit_rf(train), "gbt": M.fit_gbt(train)}.items():
        pred = M.scored(model, train)
        again = A.rank_sum_auc(pred).select(F.lit("auc").alias("metric"), F.col("auc").alias("again")).union(
            pred.agg((F.count_if(F.col("label") == F.col("prediction")) / F.count(F.lit(1))).alias("again"))
            .select(F.lit("accuracy").alias("metric"), "again"))
        parts.append(M.training_summary(model, train).join(again, "metric").select(
            F.lit(name).alias("model"), "metric", (F.abs(F.col("value") - F.col("again")) < 1e-9).alias("agrees")))
    return reduce(DataFrame.unionByName, parts)


def _n_features_sql() -> str:
    train = f"(SELECT * FROM {T('model')} WHERE {_hash_bucket_sql('doc_id')} < 80)"
    return f"(SELECT 1 + count(DISTINCT lang) + count(DISTINCT source) FROM {train})"


@register("ml_importance_follows", sql=lambda: f"""
SELECT unnest(range(1, n + 1)) AS rank, TRUE AS ordered, TRUE AS positive, 1.0::DOUBLE AS total
FROM (SELECT {_n_features_sql()} AS n)""")
def q_importance_follows(spark, sf):
    """The sorted importances: one for every feature of the formula, none negative, falling, one in all."""
    train, _ = _featurised(spark, sf)
    imp = M.feature_importance(M.fit_rf(train), train)
    place = Window.orderBy(F.col("score").desc(), "idx")  # one row a feature
    return imp.select(
        F.row_number().over(place).cast("long").alias("rank"),
        F.coalesce(F.lag("score").over(place) >= F.col("score"), F.lit(True)).alias("ordered"),
        (F.col("score") >= 0).alias("positive"),
        F.round(F.sum("score").over(Window.partitionBy(F.lit(1))), 9).alias("total"))


@register("ml_selection_follows", sql=lambda: _test_rows_sql("TRUE AS agrees, TRUE AS decided"))
def q_selection_follows(spark, sf):
    """The refit on the selected columns follows from its trees, whose vector holds only those columns."""
    m = role(spark, sf, "model")
    train_raw, test_raw = hash_split(m, "doc_id", M.TRAIN_FRACTION, SALT)
    train, _ = _featurised(spark, sf)
    imp = M.feature_importance(M.fit_rf(train), train)
    keep = M.important_columns(imp, m.select("n_chars", "lang", "source"), M.SELECT_IMPORTANCE)
    cols = ["doc_id", "target", *keep]
    formula = M.fit_features(train_raw.select(*cols), "target", exclude=("doc_id",))
    own = formula.transform(test_raw.select(*cols))
    told = A.check_forest(M.refit_rf(formula.transform(train_raw.select(*cols))), own, "doc_id")
    only = all(any(n == c or n.startswith(f"{c}_") for c in keep) for n in M.attribute_names(own))
    return told.withColumn("agrees", F.col("agrees") & F.lit(only))


@register("ml_training_summary")
def q_summary(spark, sf):
    train, _ = _featurised(spark, sf)
    fits = {"lr": M.fit_lr(train), "rf": M.fit_rf(train), "gbt": M.fit_gbt(train)}
    return reduce(DataFrame.unionByName, [
        M.training_summary(m, train).select(F.lit(n).alias("model"), "metric", "value")
        for n, m in fits.items()])


@register("ml_feature_importance")
def q_importance(spark, sf):
    train, _ = _featurised(spark, sf)
    return M.feature_importance(M.fit_rf(train), train)


@register("ml_feature_selection")
def q_selection(spark, sf):
    """Columns with a feature over the importance limit, refit, scored on test."""
    m = role(spark, sf, "model")
    train_raw, test_raw = hash_split(m, "doc_id", M.TRAIN_FRACTION, SALT)
    formula = M.fit_features(train_raw, "target", exclude=("doc_id",))
    train = formula.transform(train_raw)
    imp = M.feature_importance(M.fit_rf(train), train)
    keep = M.important_columns(imp, m.select("n_chars", "lang", "source"), M.SELECT_IMPORTANCE)
    cols = ["doc_id", "target", *keep]
    f2 = M.fit_features(train_raw.select(*cols), "target", exclude=("doc_id",))
    model = M.refit_rf(f2.transform(train_raw.select(*cols)))
    return _pred(model, f2.transform(test_raw.select(*cols))).withColumn(
        "selected", F.lit(",".join(keep)))


@register("ml_cross_validation")
def q_cv(spark, sf):
    """A short form of ``ml_tune_lr``: 4 LR settings and 2 folds, where that key runs all 36
    settings with 10 folds."""
    train, _ = _featurised(spark, sf)
    grid = {"regParam": [0.01, 0.1], "elasticNetParam": [0.0, 0.5]}
    cv = M.tune(M.lr(), grid, train.select("features", "label"), folds=2, parallelism=2)
    best = M.best_params(cv, grid)
    return M.cv_metrics(cv, grid).withColumn(
        "best", ((F.col("regParam") == best["regParam"])
                 & (F.col("elasticNetParam") == best["elasticNetParam"])).cast("int"))


def search(spark, sf, estimator, grid: dict, folds: int = 10) -> DataFrame:
    """Every setting of ``grid`` with its mean AUC over the folds, and ``best`` = 1 for the
    setting that the search chose. The featurised training rows are written once: the fits
    start from Parquet and a lost executor costs a re-read."""
    train, _ = _featurised(spark, sf)
    path = save_table(train.select("features", "label"), scratch_path(spark, "tuning-train"))
    cv = M.tune(estimator, grid, load_table(spark, path), folds=folds, parallelism=8)
    best = M.best_params(cv, grid)
    chosen = reduce(lambda a, b: a & b, [F.col(n) == F.lit(float(v)) for n, v in best.items()])
    return M.cv_metrics(cv, grid).withColumn("best", chosen.cast("int"))


@register("ml_tune_lr")
def q_tune_lr(spark, sf):
    return search(spark, sf, M.lr(), M.LR_GRID)


@register("ml_tune_rf")
def q_tune_rf(spark, sf):
    return search(spark, sf, M.rf(), M.RF_GRID)


@register("ml_tune_gbt")
def q_tune_gbt(spark, sf):
    """The boosted-tree grid whole: 18 settings with 10 folds, resumable (``operators.search``), each
    fit on the weighted cells of its fold."""
    train, _ = _featurised(spark, sf)
    grid = GridSearch(M.gbt(**M.GBT_DEFAULTS), M.GBT_GRID, scratch_path(spark, "gbt-search"), weighted=True)
    return grid.table(spark, grid.run(train, "doc_id"))


@register("ml_report")
def q_report(spark, sf):
    """The model study on the flagship base table (no grid search in the query). The base
    table is written once to the shared scratch folder and read back, so a dozen model
    and metric jobs start from Parquet instead of replaying the whole feature plan."""
    bt = flagship(spark, sf)
    path = save_table(bt, scratch_path(spark, "basetable-model"))
    return run_models(load_table(spark, path))
