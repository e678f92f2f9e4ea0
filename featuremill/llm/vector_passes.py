"""Embedding near-dedup (operator 13): sorted projection passes.

Each pass draws its own random hyperplanes, writes a vector's side of each as one bit of a
64-bit key and orders all vectors by that key: vectors at a small angle share a long beginning
and stand near each other. Each vector is compared by cosine, in double precision, with the
``window`` vectors that follow it; the verified pairs of all passes are united into
connected components. Equal vectors are one node from the start, so a vector that fills a
third of the table costs one row.

The number of passes follows from the number of different vectors, so that the search finds
alike at every size: two vectors at the threshold agree on one bit with probability
``1 - acos(threshold) / pi``, and meet in a pass if they agree on the ``log2(n / window)`` bits
that single out a window; the passes are as many as make a meeting ``recall`` likely.

A pass returns no list of pairs but, for each vector that has links, the first vector of its
group in the window graph: at most one row a vector. Partitions also return their first and
last ``window`` vectors, and the pairs across partitions are compared afterwards, so the
result does not depend on the partitioning. The number of direct links is then counted inside
the components, block against block, and again no pair is emitted.

Defined results: a vector that is null, empty, zero, or holds a null or non-finite component
links with nothing, and so do vectors of different lengths; a null id is no candidate for
the smallest id of a component, and such a row is kept only if its component has no id at
all; repeated rows and tied ids are copies (each counts as a link of the others); an empty
table gives an empty result; further columns are ignored. Memory per task: one Arrow batch and
``window`` vectors, or two blocks of ``BLOCK`` vectors.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremill.llm.common import stored
from featuremill.llm.components import connected_components

THRESHOLD = 0.9
WINDOW = 128
#: How likely a pair at the threshold is to meet in some pass.
RECALL = 0.95
BITS = 64
#: Vectors of a component that are compared in one piece when its links are counted.
BLOCK = 512
#: Rows whose neighbours are taken in one matrix product.
ROWS = 128


def passes_for(n: int, threshold: float = THRESHOLD, window: int = WINDOW, recall: float = RECALL) -> int:
    """Passes after which a pair at the threshold has met with probability ``recall``."""
    bits = min(BITS, max(0.0, math.log2(max(n, 1) / window)))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return 2 if meet >= recall else max(2, math.ceil(math.log(1 - recall) / math.log(1 - meet)))


def planes(number: int, size: int, seed: int = 13) -> np.ndarray:
    """The hyperplanes of one pass for vectors of one length."""
    return np.random.default_rng([seed, number, size]).standard_normal((size, BITS))


def keys_of(unit: np.ndarray, number: int) -> np.ndarray:
    """The concatenated bits of each row as a signed 64-bit number."""
    bits = unit @ planes(number, unit.shape[1]) > 0
    return np.packbits(bits, axis=1).view(">i8").astype(np.int64).ravel()


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; scaled by their largest component first, so squares neither
    overflow nor vanish."""
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def window_pairs(unit: np.ndarray, old: int, window: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j), i < j <= i + window, of ordered rows whose cosine reaches the threshold;
    the first ``old`` rows have been compared with each other before."""
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for at in range(0, len(unit), ROWS):
        end = min(len(unit), at + ROWS + window)
        if end <= old:
            continue
        i, j = np.nonzero(unit[at:at + ROWS] @ unit[at:end].T >= threshold)
        near = (j > i) & (j - i <= window) & (j + at >= old)
        left.append(i[near] + at)
        right.append(j[near] + at)
    return np.concatenate(left), np.concatenate(right)


def first_of_group(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of ``n`` rows the smallest row that the pairs connect it with."""
    first = np.arange(n)
    while True:
        low = np.minimum(first[left], first[right])
        new = first.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        np.minimum.at(new, first[left], low)
        np.minimum.at(new, first[right], low)
        new = new[new]
        if (new == first).all():
            return first
        first = new


def _matrix(column: pa.ListArray) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1)


def _linked(nodes: np.ndarray, unit: np.ndarray, old: int, window: int, threshold: float):
    """(node, first node of its group) for the rows that a link reaches."""
    first = first_of_group(len(nodes), *window_pairs(unit, old, window, threshold))
    other = np.flatnonzero(first != np.arange(len(nodes)))
    return nodes[other], nodes[first[other]]


SWEPT = "a long, b long, part int, place long, vec array<double>"


def _swept(a, b, part=None, place=None, vecs=None) -> pa.RecordBatch:
    n = len(a)
    none = [None] * n
    return pa.RecordBatch.from_arrays(
        [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(none if part is None else [part] * n, pa.int32()),
         pa.array(none if place is None else place, pa.int64()),
         pa.array(none if vecs is None else list(vecs), pa.list_(pa.float64()))],
        names=["a", "b", "part", "place", "vec"])


def _sweep(batches, window: int, threshold: float):
    """Links inside one partition's order, and the vectors at its two ends."""
    part = TaskContext.get().partitionId()
    nodes, unit, seen = None, None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        new, rows = batch.column("node").to_numpy(), _matrix(batch.column("vec"))
        head = max(0, min(window - seen, len(new)))
        if head:
            yield _swept(new[:head], new[:head], part, range(seen, seen + head), rows[:head])
        old = 0 if nodes is None else len(nodes)
        nodes, unit = (new, rows) if not old else (np.concatenate([nodes, new]), np.concatenate([unit, rows]))
        seen += len(new)
        yield _swept(*_linked(nodes, unit, old, window, threshold))
        nodes, unit = nodes[-window:], unit[-window:]
    tail = max(window, seen - window)  # the first ``window`` rows are returned already
    if seen > tail:
        yield _swept(nodes[tail - seen:], nodes[tail - seen:], part, range(tail, seen), unit[tail - seen:])


def _across(batches, window: int, threshold: float):
    """Links between the ends of neighbouring partitions of one pass. Rows come in the pass's
    order; rows left out inside a partition only make a window reach less far than it could,
    so places count, not rows."""
    pass_no, nodes, unit, part, places, base = None, None, None, None, None, 0
    for batch in batches:
        rows = _matrix(batch.column("vec")) if batch.num_rows else None
        own = [batch.column(c).to_numpy() for c in ("pass", "part", "place", "a")]
        for p in np.unique(own[0]):
            at = np.flatnonzero(own[0] == p)
            part_at, place_at = own[1][at], own[2][at]
            if p != pass_no:
                pass_no, nodes, base = p, None, 0
            # each row's place in the whole order: the rows of the parts before, and its own
            place = np.empty(len(at), np.int64)
            for k in range(len(at)):
                if nodes is not None or k:
                    before_part = part_at[k - 1] if k else part[-1]
                    before_place = place[k - 1] if k else places[-1]
                    if part_at[k] != before_part:
                        base = before_place + 1
                place[k] = base + place_at[k]
            new, vec = own[3][at], rows[at]
            old = 0 if nodes is None else len(nodes)
            if old:
                new, vec, place, part_at = (np.concatenate([nodes, new]), np.concatenate([unit, vec]),
                                            np.concatenate([places, place]), np.concatenate([part, part_at]))
            i, j = window_pairs(vec, old, window, threshold)
            ok = (place[j] - place[i] <= window) & (part_at[i] != part_at[j])
            first = first_of_group(len(new), i[ok], j[ok])
            other = np.flatnonzero(first != np.arange(len(new)))
            yield pa.RecordBatch.from_arrays([pa.array(new[other]), pa.array(new[first[other]])], names=["a", "b"])
            nodes, unit, places, part = new[-window:], vec[-window:], place[-window:], part_at[-window:]


def links_of_passes(nodes: DataFrame, n: int, threshold: float = THRESHOLD, window: int = WINDOW,
                    recall: float = RECALL, passes: int | None = None) -> DataFrame:
    """Edges (a, b) that connect the same nodes as the verified pairs of all passes over
    ``nodes`` (node long, vec array<double> of length one, all of one size)."""
    spark = nodes.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    edges, ends = [], []
    for number in range(passes or passes_for(n, threshold, window, recall)):
        def keyed(batches, number=number):
            for batch in batches:
                if batch.num_rows:
                    key = keys_of(_matrix(batch.column("vec")), number)
                    yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("vec"), pa.array(key)],
                                                     names=["node", "vec", "key"])

        ordered = (nodes.select("node", "vec").mapInArrow(keyed, "node long, vec array<double>, key long")
                   .repartitionByRange(parts, "key", "node").sortWithinPartitions("key", "node"))
        swept = stored(ordered.mapInArrow(lambda b: _sweep(b, window, threshold), SWEPT), f"pass-{number}")
        edges.append(swept.where("part is null").select("a", "b"))
        ends.append(swept.where("part is not null").withColumn("pass", F.lit(number)))
    union = edges[0]
    for e in edges[1:]:
        union = union.union(e)
    between = ends[0]
    for e in ends[1:]:
        between = between.union(e)
    between = (between.repartition("pass").sortWithinPartitions("pass", "part", "place")
               .select("pass", "part", "place", "a", "vec"))
    return union.union(between.mapInArrow(lambda b: _across(b, window, threshold), "a long, b long"))


def count_links(members: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """(node, others): how many rows of other nodes of its component a node links with.
    ``members``: root, node, vec (of length one), n (rows of the node). Components are cut into
    blocks; each task compares two blocks and returns one count a node."""
    sizes = (members.groupBy("root").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
             .select(F.col("root").alias("of"), F.ceil(F.col("size") / block).cast("int").alias("blocks")))
    own = (members.join(sizes, members.root == sizes.of)
           .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    pieces = own.select("root", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
                        (F.col("own") <= F.col("other")).alias("left"), "node", "n", "vec")
    key = ["root", "low", "high"]

    def count(batches):
        held = None
        for batch in batches:
            held = batch if held is None else pa.concat_batches([held, batch])
            if not held.num_rows:
                continue
            cols = np.stack([held.column(c).to_numpy().astype(np.int64) for c in key])
            edge = np.flatnonzero(np.concatenate([[True], (cols[:, 1:] != cols[:, :-1]).any(axis=0)]))
            for a, b in zip(edge[:-1], edge[1:]):
                yield of_group(held.slice(a, b - a))
            held = held.slice(edge[-1])
        if held is not None and held.num_rows:
            yield of_group(held)

    def of_group(rows: pa.RecordBatch) -> pa.RecordBatch:
        unit = _matrix(rows.column("vec"))
        n, node = rows.column("n").to_numpy(), rows.column("node")
        one = rows.column("low")[0].as_py() == rows.column("high")[0].as_py()
        at = rows.column("left").to_numpy(zero_copy_only=False)
        if one:
            near = unit @ unit.T >= threshold
            np.fill_diagonal(near, False)
            found = near @ n
        else:
            near = unit[at] @ unit[~at].T >= threshold
            found = np.empty(len(n), np.int64)
            found[at], found[~at] = near @ n[~at], n[at] @ near
        return pa.RecordBatch.from_arrays([node, pa.array(found, pa.int64())], names=["node", "others"])

    return (pieces.repartition(*key).sortWithinPartitions(*key)
            .mapInArrow(count, "node long, others long")
            .groupBy("node").agg(F.sum("others").alias("others")))


def near_vectors(df: DataFrame, threshold: float = THRESHOLD, window: int = WINDOW, recall: float = RECALL,
                 id_col: str = "vec_id", vec_col: str = "embedding", passes: int | None = None) -> DataFrame:
    """Per row of ``df``: vec_id, n_links (other rows it links with directly), component_id
    (smallest id reachable by links, itself included) and kept."""
    vec = F.col(vec_col).cast("array<double>")
    # a null component makes the test null, which counts as false; an empty or zero vector has no direction
    sound = F.coalesce(F.forall(vec, lambda x: ~F.isnan(x) & (F.abs(x) < float("inf")))
                       & F.exists(vec, lambda x: x != 0), F.lit(False))
    rows = stored(df.select(F.col(id_col).alias("vec_id"), F.when(sound, vec).alias("vec"))
                  .withColumn("h1", F.when(F.col("vec").isNotNull(), F.xxhash64("vec")))
                  .withColumn("h2", F.when(F.col("vec").isNotNull(), F.xxhash64(F.lit("second"), "vec"))), "vectors")
    classes = (rows.where("h1 is not null").groupBy("h1", "h2")
               .agg(F.first("vec").alias("vec"), F.min("vec_id").alias("lowest"), F.count(F.lit(1)).alias("n")))

    def scaled(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            size = batch.column("vec").value_lengths().to_numpy()
            flat, begin = np.asarray(batch.column("vec").flatten()), np.concatenate([[0], np.cumsum(size)])
            unit = [unit_rows(flat[a:b][None])[0] for a, b in zip(begin[:-1], begin[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("h1", "h2", "lowest", "n")]
                + [pa.array(unit, pa.list_(pa.float64())), pa.array(size, pa.int32())],
                names=["h1", "h2", "lowest", "n", "vec", "size"])

    id_type = rows.schema["vec_id"].dataType.simpleString()
    nodes = stored(classes.select("h1", "h2", "vec", "lowest", "n")
                   .mapInArrow(scaled, f"h1 long, h2 long, lowest {id_type}, n long, vec array<double>, size int")
                   .withColumn("node", F.monotonically_increasing_id()), "vector-nodes")
    edges = None
    for size, n in sorted((r["size"], r["n"]) for r in nodes.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()):
        found = links_of_passes(nodes.where(F.col("size") == size), n, threshold, window, recall, passes)
        edges = found if edges is None else edges.union(found)
    if edges is None:
        member = nodes.select("h1", "h2", F.lit(0).cast("long").alias("links"), F.col("lowest").alias("component_id"))
    else:
        roots = connected_components(edges)
        named = stored(nodes.join(roots.withColumnRenamed("node", "at"), F.col("node") == F.col("at"), "left")
                       .select("h1", "h2", "node", F.coalesce("root", "node").alias("root"), "lowest", "n", "vec"),
                       "vector-roots")
        others = count_links(named, threshold).withColumnRenamed("node", "at")
        lowest = named.groupBy(F.col("root").alias("of")).agg(F.min("lowest").alias("component_id"))
        member = (named.drop("vec").join(lowest, F.col("root") == F.col("of"))
                  .join(others, F.col("node") == F.col("at"), "left")
                  .select("h1", "h2", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("links"), "component_id"))
    member = stored(member.select(F.col("h1").alias("m1"), F.col("h2").alias("m2"), "links", "component_id"),
                    "vector-members")
    own = rows.select("vec_id", "h1", "h2").join(member, (F.col("h1") == F.col("m1")) & (F.col("h2") == F.col("m2")),
                                                 "left")
    component = F.when(F.col("links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return (own.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                       component.alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
