"""Training rows of boosted trees, reduced to the cells that the trees can tell apart.

A tree reads a number only through its split points (at most ``maxBins`` bins), so rows with the
same label, the same bins and the same category values are one row to it, with a weight. The
split points are those that the fit on the rows themselves would use: a tree over the one number,
grown until every bin is a leaf, names them all (its labels are hashes of the number, so that any
two bins differ). The number of cells is bounded by bins and categories and not by the rows; where
rows hardly repeat, the cells are about the rows, and nothing is lost but the grouping.

Only for fits that draw no rows and do not count them: one tree a step on all rows
(``subsamplingRate`` 1, ``minInstancesPerNode`` 1).
"""

from __future__ import annotations

import math
import re

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Cells a task of a fit holds about.
TASK_CELLS = 100_000
#: The deepest tree that Spark grows.
DEEPEST = 30


def numbers(rows: DataFrame) -> list[int]:
    """Positions of the ``features`` that are no categories (by the column's metadata)."""
    meta = rows.schema["features"].metadata.get("ml_attr", {})
    attrs = meta.get("attrs", {})
    categories = {a["idx"] for kind in ("binary", "nominal") for a in attrs.get(kind, [])}
    size = meta.get("num_attrs") or len(rows.select(vector_to_array("features").alias("v")).first().v)
    return [i for i in range(size) if i not in categories]


def split_points(rows: DataFrame, position: int, max_bins: int, seed: int) -> list[float]:
    """The thresholds between the bins of one number, as a tree with this seed finds them on ``rows``."""
    x = vector_to_array("features").getItem(position)
    label = F.pmod(F.xxhash64(x), F.lit(1 << 20)) / F.lit(float(1 << 20))
    one = rows.select(array_to_vector(F.array(x)).alias("features"), label.alias("label"))
    tree = DecisionTreeRegressor(maxDepth=min(DEEPEST, max_bins), maxBins=max_bins, seed=seed).fit(one)
    return sorted({float(t) for t in re.findall(r"<= ([^\s)]+)\)", tree.toDebugString)})


def cells(rows: DataFrame, points: dict[int, list[float]]) -> DataFrame:
    """(features, label, weight) of ``rows`` (features, label): numbers as their bin, one row a cell, persisted."""
    meta = rows.schema["features"].metadata
    v = vector_to_array("features")
    size = meta.get("ml_attr", {}).get("num_attrs") or len(rows.select(v.alias("v")).first().v)

    def binned(i: int):
        if i not in points:
            return v.getItem(i)
        # a value on a threshold goes left
        return sum((F.when(v.getItem(i) > t, 1.0).otherwise(0.0) for t in points[i]), F.lit(0.0))

    grouped = (rows.select("label", F.array(*[binned(i) for i in range(size)]).alias("cell"))
               .groupBy("label", "cell").agg(F.count(F.lit(1)).cast("double").alias("weight"))
               .select(array_to_vector("cell").alias("features", metadata=meta), "label", "weight").persist())
    few = grouped.coalesce(grouped.count() // TASK_CELLS + 1).persist()
    few.count()
    grouped.unpersist()
    return few


def bins_for(n_cells: int, max_bins: int) -> int:
    """``maxBins`` for a fit on cells, whose numbers hold ``max_bins`` values at most: more bins change no
    tree, and with the root of the cells Spark looks for split points in all of them and not in a sample."""
    return max(max_bins, math.isqrt(max(0, n_cells - 1)) + 1)
