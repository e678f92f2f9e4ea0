"""Connected components of an undirected graph given as an edge table, by joins only.

Each round moves every node's label to the smallest label among its neighbours, hooks the
label's own node along, and then jumps from label to label's label (so paths shorten by
more than half in a round). A round's labels are written to the shared scratch folder: the
plan does not grow and a lost executor costs a re-read. Both inputs of the joins are plain
scans, so the adaptive planner can split a node that holds a large share of the edges; all
minima combine before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremill.llm.common import stored


def connected_components(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b; nodes of one orderable type):
    root is the smallest node of the component. An empty edge table gives an empty result."""
    both = stored(edges.select("a", "b").where("a <> b")
                  .union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")).where("a <> b"))
                  .distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node"))
                    .agg(F.least(F.col("a"), F.min("b")).alias("root")), "labels")
    for _ in range(rounds):
        near = (both.join(labels, both.b == labels.node)
                .groupBy(F.col("a").alias("u")).agg(F.min("root").alias("low")))
        hooked = labels.join(near, labels.node == near.u).select("node", "root", "low")
        moved = stored(
            hooked.select("node", F.least("root", "low").alias("root"))
            .union(hooked.where("low < root").select(F.col("root").alias("node"), F.col("low").alias("root")))
            .groupBy("node").agg(F.min("root").alias("root")), "labels")
        up = moved.select(F.col("node").alias("parent"), F.col("root").alias("above"))
        jumped = stored(moved.join(up, moved.root == up.parent)
                        .select("node", F.least("root", "above").alias("root")), "labels")
        old = labels.select(F.col("node").alias("was"), F.col("root").alias("old"))
        changed = jumped.join(old, (jumped.node == old.was) & (jumped.root != old.old)).limit(1).count()
        labels = jumped
        if not changed:
            return labels
    raise RuntimeError("connected components did not settle")
