"""Cross-validated grid search that goes on where it stopped.

The featurised training rows are written once with a fold number, a hash of their key, so a
fold holds the same rows in every run and on every cluster. Every fit (one setting, one fold)
appends its metric as a table of its own; a search that is started again on the same folder
reads those and runs only what is missing, so a lost driver costs the fits that were under way.
Fits of one fold share a persisted input and run side by side, at most ``parallelism`` of them,
the deepest trees first. With ``weighted``, and more than ``few`` rows, the input of boosted trees
is the fold's cells (``operators.cells``): the same trees, up to the rounding of their sums (which
decides between equal splits), at a cost that hardly grows with the rows.

A fold whose rows, or whose complement, hold one class only has no AUC; it is left out of the
averages. The best setting has the highest average, the first in grid order among equals.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremill.operators.cells import bins_for, cells, numbers, split_points
from featuremill.operators.split import hash_bucket

#: Rows a fold table's file holds about (small tables then make few, quick tasks).
FILE_ROWS = 100_000


def settings(grid: dict) -> list[dict]:
    """Every combination of the grid's values, in order."""
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def read_if_written(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None where no finished write has left one."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


@dataclass
class GridSearch:
    """A search of ``grid`` for ``estimator`` under the folder ``base``. ``metric(model, rows)``:
    the figure of a fitted model (default: area under the ROC curve). ``weighted``: fits and figures are
    taken on weighted cells (rows then have a ``weight``) where ``train`` has more than ``few`` rows; for
    GBT estimators that draw no rows."""
    estimator: object
    grid: dict
    base: str
    folds: int = 10
    parallelism: int = 8
    seed: str = "fold"
    metric: object = None
    weighted: bool = False
    few: int = FILE_ROWS

    def __post_init__(self):
        if self.weighted and not (
                {"subsamplingRate", "minInstancesPerNode"}.isdisjoint(self.grid) and self.estimator.hasParam("stepSize")
                and self.estimator.getSubsamplingRate() == 1 and self.estimator.getMinInstancesPerNode() == 1
                and self.estimator.getFeatureSubsetStrategy() == "all"):
            raise ValueError("weighted cells are for boosted trees that draw and count no rows")

    def _max_bins(self, setting: dict) -> int:
        return setting.get("maxBins", self.estimator.getMaxBins())

    def prepare(self, train: DataFrame, key: str) -> DataFrame:
        """``train`` (features, label, key) as the fold table, written the first time only."""
        spark = train.sparkSession
        found = read_if_written(spark, f"{self.base}/folds")
        if found is None:
            rows = train.select("features", "label", hash_bucket(key, self.seed, self.folds).cast("int").alias("fold"))
            files = rows.count() // FILE_ROWS + 1
            rows.repartition(files).write.mode("overwrite").parquet(f"{self.base}/folds")
            found = spark.read.parquet(f"{self.base}/folds")
        return found

    def done(self, spark: SparkSession) -> dict[tuple[int, int], float | None]:
        """(setting, fold) -> metric of the fits that have finished."""
        found = read_if_written(spark, f"{self.base}/results")
        return {} if found is None else {(r.setting, r.fold): r.metric for r in found.collect()}

    def run(self, train: DataFrame, key: str) -> dict[tuple[int, int], float | None]:
        """Runs the fits that are missing; the metrics of all."""
        spark = train.sparkSession
        table = self.prepare(train, key)
        counts = {r.fold: (r.positive, r.n) for r in table.groupBy("fold").agg(
            F.count_if(F.col("label") > 0.5).alias("positive"), F.count(F.lit(1)).alias("n")).collect()}
        all_positive, all_rows = (sum(c[i] for c in counts.values()) for i in (0, 1))
        every, found = settings(self.grid), self.done(spark)
        weighted = self.weighted and all_rows > self.few
        auc = BinaryClassificationEvaluator(**{"weightCol": "weight"} if weighted else {})
        evaluate = self.metric or (lambda model, rows: auc.evaluate(model.transform(rows)))
        for fold in range(self.folds):
            missing = sorted((i for i in range(len(every)) if (i, fold) not in found),
                             key=lambda i: -every[i].get("maxDepth", 0))
            if not missing:
                continue
            positive, n = counts.get(fold, (0, 0))
            if not (0 < positive < n and 0 < all_positive - positive < all_rows - n):
                found |= {(i, fold): None for i in missing}  # known again without a fit: not written
                continue
            inside = table.where(F.col("fold") != fold).select("features", "label").persist()
            outside = table.where(F.col("fold") == fold).select("features", "label").persist()

            held = {}

            def hold(max_bins: int, inside=inside, outside=outside) -> tuple[DataFrame, DataFrame, int]:
                points = {j: split_points(inside, j, max_bins, self.estimator.getSeed()) for j in numbers(inside)}
                own = cells(inside, points)
                return own, cells(outside, points), bins_for(own.count(), max_bins)

            def fit(i: int, fold=fold, inside=inside, outside=outside, held=held) -> float:
                params, estimator = {self.estimator.getParam(k): v for k, v in every[i].items()}, self.estimator
                if weighted:
                    inside, outside, params[estimator.maxBins] = held[self._max_bins(every[i])]
                    estimator = estimator.copy({estimator.weightCol: "weight"})
                figure = float(evaluate(estimator.copy(params).fit(inside), outside))
                (spark.range(1).select(F.lit(figure).alias("metric")).coalesce(1)
                 .write.mode("overwrite").parquet(f"{self.base}/results/setting={i}/fold={fold}"))
                return figure

            pool = ThreadPool(min(self.parallelism, len(missing)))
            try:
                if weighted:
                    bins = sorted({self._max_bins(every[i]) for i in missing})
                    held.update(zip(bins, pool.map(inheritable_thread_target(spark)(hold), bins, chunksize=1)))
                for i, figure in zip(missing, pool.map(inheritable_thread_target(spark)(fit), missing, chunksize=1)):
                    found[i, fold] = figure
            finally:
                pool.close()
                pool.join()
                for df in (inside, outside, *(d for own in held.values() for d in own[:2])):
                    df.unpersist()
        return found

    def averages(self, found: dict) -> list[float | None]:
        out = []
        for i in range(len(settings(self.grid))):
            own = [found[i, k] for k in range(self.folds) if found[i, k] is not None]
            out.append(sum(own) / len(own) if own else None)
        return out

    def best(self, found: dict) -> dict:
        """The best setting (the first of the grid where no fold has a metric)."""
        means = [-1.0 if m is None else m for m in self.averages(found)]
        return settings(self.grid)[means.index(max(means))]

    def table(self, spark: SparkSession, found: dict) -> DataFrame:
        """One row a setting: its values, auc (mean over the folds), folds (that have one), best."""
        best, rows = self.best(found), []
        for i, (own, mean) in enumerate(zip(settings(self.grid), self.averages(found))):
            n = sum(found[i, k] is not None for k in range(self.folds))
            rows.append((*(float(v) for v in own.values()), mean, n, int(own == best)))
        schema = ", ".join(f"{n} double" for n in self.grid) + ", auc double, folds int, best int"
        return spark.createDataFrame(rows, schema)

    def best_model(self, train: DataFrame, key: str, found: dict):
        """The best setting fitted on all rows."""
        params = {self.estimator.getParam(k): v for k, v in self.best(found).items()}
        rows = self.prepare(train, key).select("features", "label").persist()
        try:
            return self.estimator.copy(params).fit(rows)
        finally:
            rows.unpersist()
