"""Train / tune / report (the model study): split, formula features, LR, RF and GBT with
the original settings, feature selection by importance, exact AUC and accuracy on train
and test. Optional cross-validation over the original grids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremill.operators import models as M
from featuremill.operators.evaluate import accuracy, exact_auc
from featuremill.operators.hashed import HashedFeatures, named_weights
from featuremill.operators.search import GridSearch
from featuremill.operators.split import hash_split
from featuremill.session import scratch_path


def report(scored: DataFrame) -> DataFrame:
    """``(model, split, auc, accuracy, n)`` for every (model, split) in one job."""
    by = ["model", "split"]
    return (exact_auc(scored, "label", "p1", by=by).join(accuracy(scored, by=by), by)
            .select(*by, "auc", "accuracy", "n"))


def _scored(model, data: DataFrame, name: str, split: str) -> DataFrame:
    return M.scored(model, data).select(F.lit(name).alias("model"), F.lit(split).alias("split"),
                                        "label", "prediction", "p1")


def _featurised(train: DataFrame, test: DataFrame, key: str, target: str, hash_width: int | None):
    """Train and test rows as (key, features, label)."""
    if hash_width:
        layout = HashedFeatures.of(train, target, (key,), hash_width)
        return layout.transform(train, target, (key,)), layout.transform(test, target, (key,))
    formula = M.fit_features(train, target, exclude=(key,))
    return (formula.transform(train).select(key, "features", "label"),
            formula.transform(test).select(key, "features", "label"))


def run_models(base: DataFrame, key: str = "business_id", target: str = "target",
               tune: bool = False, folds: int = 10, grids: dict | None = None,
               search_dir: str | None = None, hash_width: int | None = None) -> DataFrame:
    """``(model, split, auc, accuracy, n)`` for every fitted model. ``hash_width``: text columns are
    hashed into so many positions instead of indexed by the formula, so neither the driver nor
    the vector grows with their values. ``tune`` adds the best setting of
    each grid; with ``search_dir`` a stopped search goes on from what that folder holds."""
    train_raw, test_raw = hash_split(base, key, M.TRAIN_FRACTION, str(M.SPLIT_SEED))
    # each fit caches its input and releases it afterwards (``models._fit``); the base table
    # itself is read from the shared folder, so scoring recomputes only the features
    keyed, test = _featurised(train_raw, test_raw, key, target, hash_width)
    train, test = keyed.select("features", "label"), test.select("features", "label")
    fitted = {
        "lr": M.fit_lr(train),
        "rf": M.fit_rf(train),
        "rf_tuned": M.fit_rf(train, **M.RF_TUNED),
        "gbt": M.fit_gbt(train),
        "gbt_tuned": M.fit_gbt(train, **M.GBT_TUNED),
    }
    # feature selection: columns with a feature above the importance limit, RF refit
    imp = M.feature_importance(fitted["rf"], train)
    if hash_width:  # slots are judged under the name of their clearest value, ``column=value``
        layout = HashedFeatures.of(train_raw, target, (key,), hash_width)
        imp = (named_weights([r["score"] for r in imp.orderBy("idx").collect()], layout, layout.slot_names(train_raw))
               .select(F.regexp_replace("feature", "=", "_").alias("feature"), F.abs("weight").alias("score")))
    keep = M.important_columns(imp, base.drop(key, target), M.SELECT_IMPORTANCE)
    if keep:
        sel_cols = [key, target, *keep]
        tr2, te2 = (t.select("features", "label") for t in _featurised(
            train_raw.select(*sel_cols), test_raw.select(*sel_cols), key, target, hash_width))
        fitted_sel = M.refit_rf(tr2)
    if tune:
        grids = grids or {"lr": M.LR_GRID, "rf": M.RF_GRID, "gbt": M.GBT_GRID}
        makers = {"lr": M.lr, "rf": M.rf, "gbt": M.gbt}
        search_dir = search_dir or scratch_path(base.sparkSession, "model-search")
        for name, grid in grids.items():
            search = GridSearch(makers[name](), grid, f"{search_dir}/{name}", folds=folds)
            fitted[f"{name}_cv"] = search.best_model(keyed, key, search.run(keyed, key))
    parts = []
    for name, model in fitted.items():
        parts += [_scored(model, train, name, "train"), _scored(model, test, name, "test")]
    if keep:
        parts += [_scored(fitted_sel, tr2, "rf_selected", "train"),
                  _scored(fitted_sel, te2, "rf_selected", "test")]
    return report(reduce(DataFrame.unionByName, parts))
