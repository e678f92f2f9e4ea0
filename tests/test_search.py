"""Resumable grid search and hashed feature vectors."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import SF001
from featuremill.operators import models as M
from featuremill.operators.evaluate import exact_auc
from featuremill.operators.hashed import HashedFeatures, feature_text, named_weights
from featuremill.operators.search import GridSearch, settings
from featuremill.operators.split import hash_split
from featuremill.plans.catalog import role
from featuremill.plans.report import run_models
from test_ml import _separable

SF1 = "/root/testdata/sf0.1"


def _train(spark, n=240):
    df = _separable(spark, n).withColumn("x1", F.col("x1") + F.rand(9) * 4)
    return M.fit_features(df, "target").transform(df).select("business_id", "features", "label")


GRID = {"regParam": [0.01, 5.0], "maxIter": [1, 5]}


class Stopped(Exception):
    pass


def test_search_goes_on_where_it_stopped(spark, tmp_path):
    train = _train(spark)
    fits = []

    def counted(model, rows, stop_after=None):
        if stop_after is not None and len(fits) >= stop_after:
            raise Stopped
        fits.append(1)
        return exact_auc(M.positive_probability(model.transform(rows)), "label", "p1").first()["auc"]

    def search(base, stop_after=None):
        return GridSearch(M.lr(), GRID, str(tmp_path / base), folds=3, parallelism=1,
                          metric=lambda model, rows: counted(model, rows, stop_after))

    whole = search("whole").run(train, "business_id")
    assert len(fits) == 12 and set(whole) == {(i, k) for i in range(4) for k in range(3)}
    fits.clear()
    with pytest.raises(Stopped):
        search("cut", stop_after=5).run(train, "business_id")
    assert len(fits) == 5
    again = search("cut")
    assert len(again.done(spark)) == 5
    assert again.run(train, "business_id") == whole and len(fits) == 12  # only the seven missing fits ran
    assert again.run(train, "business_id") == whole and len(fits) == 12  # nothing is left to do
    rows = again.table(spark, whole).collect()
    assert [(r.regParam, r.maxIter) for r in rows] == [tuple(s.values()) for s in settings(GRID)]
    assert [r.best for r in rows].index(1) == max(range(4), key=lambda i: (rows[i].auc, -i))
    assert again.best_model(train, "business_id", whole).getRegParam() == again.best(whole)["regParam"]


def test_folds_do_not_depend_on_partitions(spark, tmp_path):
    train = _train(spark)
    a = GridSearch(M.lr(), GRID, str(tmp_path / "a")).prepare(train, "business_id")
    b = GridSearch(M.lr(), GRID, str(tmp_path / "b")).prepare(train.repartition(7), "business_id")
    same = lambda df: sorted((str(r.features), r.label, r.fold) for r in df.collect())
    assert same(a) == same(b) and a.select("fold").distinct().count() == 10


def test_fold_of_one_class_is_left_out(spark, tmp_path):
    train = _train(spark, 40).withColumn("label", F.when(F.col("business_id") == 1, 1.0).otherwise(0.0))
    search = GridSearch(M.lr(), {"maxIter": [1]}, str(tmp_path / "one"), folds=4)
    found = search.run(train, "business_id")
    assert set(found.values()) == {None} and search.best(found) == {"maxIter": 1}
    assert search.table(spark, found).first().auc is None


def test_tuned_models_in_the_report(spark, tmp_path):
    rep = run_models(_separable(spark, 200), tune=True, folds=2, grids={"lr": {"maxIter": [1, 5]}},
                     search_dir=str(tmp_path / "search"))
    assert {(r.model, r.split) for r in rep.collect()} >= {("lr_cv", "train"), ("lr_cv", "test")}


def test_boosted_tree_grid_is_whole():
    assert len(settings(M.GBT_GRID)) == 18 and len(settings(M.LR_GRID)) == 36


# -- hashed features -----------------------------------------------------------------------------

def test_hashed_width_is_the_same_on_every_table(spark):
    sizes = set()
    for sf in (SF001, SF1):
        m = role(spark, sf, "model")
        layout = HashedFeatures.of(m, "target", exclude=("doc_id",), width=32)
        assert layout.numbers == ("n_chars",) and layout.texts == ("lang", "source")
        sizes |= {len(r.v) for r in layout.transform(m, "target").select(vector_to_array("features").alias("v"))
                  .limit(50).collect()}
    assert sizes == {33}


def test_hashed_features_of_missing_values_and_collisions(spark):
    df = spark.createDataFrame([(1, None, "x", 2.0, 1), (2, "a", "a", None, 0)], "k long, s string, t string, n double, y int")
    layout = HashedFeatures.of(df, "y", ("k",), width=1)
    got = {r.k: r.v for r in layout.transform(df, "y", ("k",)).select("k", vector_to_array("features").alias("v")).collect()}
    signs = {r.name: r.sign for r in df.select(F.explode(F.array(feature_text("s"), feature_text("t"))).alias("name"))
             .selectExpr("name", "case when conv(substr(md5(name), 9, 1), 16, 10) % 2 = 0 then 1.0 else -1.0 end as sign")
             .collect()}
    assert set(signs) == {"s", "s=a", "t=x", "t=a"}  # a missing value is a feature of its own
    assert got == {1: [2.0, float(signs["s"] + signs["t=x"])], 2: [0.0, float(signs["s=a"] + signs["t=a"])]}
    assert HashedFeatures.of(df.drop("s", "t"), "y", ("k",), 3).transform(df, "y").count() == 2


def test_hashed_model_is_as_good_as_the_formula(spark):
    m = role(spark, SF1, "model")
    train, test = hash_split(m, "doc_id", M.TRAIN_FRACTION, "200")
    formula = M.fit_features(train, "target", exclude=("doc_id",))
    layout = HashedFeatures.of(m, "target", exclude=("doc_id",), width=256)
    auc = []
    for make in (formula.transform, lambda d: layout.transform(d, "target")):
        model = M.fit_lr(make(train).select("features", "label"), regParam=0.01)
        auc.append(exact_auc(M.scored(model, make(test)), "label", "p1").first()["auc"])
    assert abs(auc[0] - auc[1]) <= 0.01, auc


def test_weights_under_the_clearest_names(spark):
    m = role(spark, SF001, "model")
    layout = HashedFeatures.of(m, "target", exclude=("doc_id",), width=64)
    names = layout.slot_names(m)
    told = {r.idx: (r.feature, r.weight) for r in named_weights([float(i) for i in range(65)], layout, names).collect()}
    assert told[0] == ("n_chars", 0.0)
    assert len(told) == 1 + names.count()
    for r in names.collect():
        assert told[1 + r.slot] == (r.name, (1.0 + r.slot) * r.sign)


def test_report_on_hashed_features(spark):
    rows = run_models(_separable(spark, 300), hash_width=16).collect()
    assert all(r["auc"] > 0.8 for r in rows if r["split"] == "train") and len({r["model"] for r in rows}) == 6


# -- models that follow from their parameters ----------------------------------------------------

def test_rank_sum_equals_exact_auc(spark):
    import random
    from featuremill.operators.audit import rank_sum_auc
    r = random.Random(4)
    rows = [(r.randint(0, 1), r.choice([0.0, 0.25, 1.0, round(r.random(), 2), r.random()])) for _ in range(700)]
    df = spark.createDataFrame(rows, "label int, p1 double").repartition(5)
    assert abs(rank_sum_auc(df).first().auc - exact_auc(df, "label", "p1").first().auc) < 1e-12
    assert rank_sum_auc(df.where("label = 1")).first().auc is None


def test_audit_tells_a_wrong_model(spark):
    from featuremill.operators import audit
    data = _train(spark, 120)
    model = M.fit_lr(data.select("features", "label"), maxIter=3)
    good = audit.check_linear(model, data, "business_id")
    assert good.where("agrees AND decided").count() == 120
    off = audit._agrees(model.transform(data), vector_to_array("probability").getItem(1) + 1e-6, "business_id")
    assert off.where("agrees").count() == 0
