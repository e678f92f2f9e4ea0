"""Boosted trees fitted on weighted cells."""

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from featuremill.operators import models as M
from featuremill.operators.cells import bins_for, cells, numbers, split_points
from featuremill.operators.search import GridSearch

GRID = {"maxDepth": [3], "maxBins": [5, 8]}


def _train(spark, n, copies=1):
    """Rows that ``copies`` times over hold the same numbers, labels and texts (the key differs)."""
    i = F.col("i")
    df = spark.range(n).withColumnRenamed("id", "i").select(
        F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("k"), "i").select(
        (F.col("k") * n + i).alias("key"), (F.pmod(F.xxhash64(i), F.lit(997)) * 1.5).alias("x"),
        F.element_at(F.array(*map(F.lit, "abc")), (i % 3 + 1).cast("int")).alias("t"),
        F.when(F.pmod(F.xxhash64(i), F.lit(997)) + 150 * (i % 3) + F.pmod(F.hash(i), F.lit(300)) > 700, 1).otherwise(0)
        .alias("target"))
    return M.fit_features(df, "target", exclude=("key",)).transform(df).select("key", "features", "label")


def _search(base, folds=2, **kw):
    return GridSearch(M.gbt(maxIter=2), GRID, str(base), folds=folds, **kw)


def test_same_figures_on_cells_as_on_rows(spark, tmp_path):
    train = _train(spark, 1500)
    plain = _search(tmp_path / "rows", weighted=True).run(train, "key")  # up to ``few`` rows: the rows
    held = _search(tmp_path / "cells", weighted=True, few=0).run(train, "key")
    assert set(plain) == set(held) and len(held) == 4
    assert max(abs(plain[k] - held[k]) for k in plain) < 1e-9


def test_fits_do_not_grow_with_the_rows(spark, tmp_path):
    sizes = {}
    for copies in (1, 4):
        train, seen = _train(spark, 1500, copies), []
        _search(tmp_path / str(copies), weighted=True, few=0,
                metric=lambda model, rows, seen=seen: seen.append(tuple(
                    rows.agg(F.count("*"), F.sum("weight")).first())) or 0.5).run(train, "key")
        assert sum(w for _, w in seen) == 2 * 1500 * copies  # every row once a setting
        sizes[copies] = max(n for n, _ in seen)
    assert sizes[1] <= 48 and sizes[4] <= 48  # 8 bins, 3 texts, 2 labels


def test_split_points_are_those_of_the_fit_on_rows(spark):
    rows = _train(spark, 1500).select("features", "label")
    assert numbers(rows) == [0]
    points = split_points(rows, 0, 5, M.DEFAULT_SEED)
    assert len(points) == 4
    x = sorted(r.x for r in rows.select(vector_to_array("features")[0].alias("x")).collect())
    shares = [sum(v <= p for v in x) / len(x) for p in points]
    assert all(abs(s - (i + 1) / 5) < 0.02 for i, s in enumerate(shares))
    got = cells(rows, {0: points})
    bins = {v for r in got.collect() for v in [r.features[0]]}
    assert bins == {0.0, 1.0, 2.0, 3.0, 4.0} and got.agg(F.sum("weight")).first()[0] == 1500
    # far from zero, and a value on a threshold goes left
    far = spark.createDataFrame(
        [(0.0, 1e15 + 2 * i) for i in range(4)], "label double, x double")
    vec = VectorAssembler(inputCols=["x"], outputCol="features").transform(far).select("features", "label")
    points = split_points(vec, 0, 8, 1)
    assert points == [1e15 + 1, 1e15 + 3, 1e15 + 5]
    on = VectorAssembler(inputCols=["x"], outputCol="features").transform(
        spark.createDataFrame([(0.0, 1e15 + 1)], "label double, x double")).select("features", "label")
    assert cells(on, {0: points}).first().features[0] == 0.0
    assert bins_for(10, 20) == 20 and bins_for(40_001, 20) ** 2 >= 40_001


def test_only_for_fits_that_draw_no_rows(tmp_path):
    for estimator in (M.lr(), M.rf(), M.gbt(subsamplingRate=0.5), M.gbt(minInstancesPerNode=2)):
        with pytest.raises(ValueError):
            GridSearch(estimator, {"maxIter": [1]}, str(tmp_path), weighted=True)
