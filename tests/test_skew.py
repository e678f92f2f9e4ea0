"""Hot keys: one user holding a third of all reviews, a third of reviews without a user,
one score shared by a third of the rows. Results must stay whole and exact, and a hot
key's rows must reach several tasks instead of one."""

import random

from pyspark.sql import functions as F

from featuremill.operators import skew
from featuremill.operators.evaluate import cumulative_counts, exact_auc
from featuremill.operators.rollup import ROLLUP_COLUMNS, review_rollup
from featuremill.operators.skew import hot_keys, hot_of_counts, salted_left_join, sketched

from rollup_check import expected_rollup

HOT_USER = 1
N_REVIEWS = 6000
N_BUSINESSES = 2000

USER_SCHEMA = ("user_id long, average_stars double, fans long, review_count long, "
               "received_compliments long, given_votes long, loyalty double, elite_years int, "
               "friend_count int")


def _skewed_tables(spark):
    rows = []
    for i in range(N_REVIEWS):
        if i % 3 == 0:
            user = HOT_USER
        elif i % 3 == 1 and i % 2 == 0:
            user = None
        else:
            user = 2 + i % 400
        stars = None if i % 17 == 0 else float(i % 5 + 1)
        rows.append((f"r{i}", i % N_BUSINESSES, user, stars, i % 4, i % 3, i % 2))
    review = spark.createDataFrame(rows, "review_id string, business_id long, user_id long, "
                                         "stars double, useful long, funny long, cool long")
    users = spark.createDataFrame(
        [(u, float(u % 5), u % 7, 40 + u, u % 11, u % 13, 10.5 + u, u % 3, u % 9)
         for u in range(1, 402)], USER_SCHEMA)
    return review, users


def _as_dict(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _with_conf(spark, conf, fn):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return fn()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_user_rollup_is_salted_and_exact(spark):
    review, users = _skewed_tables(spark)

    def run():
        fast = review_rollup(review, users, spread=8)
        got = _as_dict(fast)
        return got, fast._jdf.queryExecution().executedPlan().toString()
    got, plan = _with_conf(spark, NO_BROADCAST, run)
    want = expected_rollup(review, users)
    # pairs meet users on (user, salt): the hot user's pairs are not one partition
    assert "hashpartitioning(user_id" in plan and "_salt" in plan
    assert got.keys() == want.keys() and len(got) == N_BUSINESSES
    for k in got:
        for c, a, b in zip(ROLLUP_COLUMNS, got[k], want[k]):
            assert (a is None and b is None) or abs(a - b) <= 1e-9 * max(1.0, abs(b)), (k, c)


def test_salted_join_spreads_hot_and_null_keys(spark):
    rows = [(1 if i % 3 == 0 else None if i % 3 == 1 else 2 + i % 300, i) for i in range(3000)]
    left = spark.createDataFrame(rows, "k long, b long")
    right = spark.createDataFrame([(k, f"v{k}") for k in range(1, 302)], "k long, v string")
    assert hot_keys(left, "k", max_hot=10).count() < 10
    # a key with a third of the rows is cut into a third of the tasks
    spread = {r["k"]: r["_spread"] for r in hot_keys(left, "k", max_hot=10, tasks=30).collect()}
    assert spread[HOT_USER] == 10

    def run():
        out = salted_left_join(left, right, "k", ["b"], spread=8)
        tasks = (out.withColumn("_task", F.spark_partition_id())
                 .groupBy(F.col("k") == HOT_USER).agg(F.count_distinct("_task").alias("n"),
                                                     F.count(F.lit(1)).alias("rows"))
                 .collect())
        return sorted(map(tuple, out.collect()), key=repr), tasks
    got, tasks = _with_conf(spark, {**NO_BROADCAST, "spark.sql.shuffle.partitions": "16"}, run)
    want = sorted(map(tuple, left.join(right, "k", "left").select("k", "b", "v").collect()),
                  key=repr)
    assert got == want
    by_kind = {r[0]: (r["n"], r["rows"]) for r in tasks}
    assert by_kind[True] == (by_kind[True][0], 1000) and by_kind[True][0] > 1  # hot key
    assert by_kind[None][0] > 1  # null keys


def test_sketch_finds_every_hot_key(spark):
    """Keys above the line are found among many rare ones, recounted exactly, with nulls and composite
    keys; the sketch's shuffle holds one row a task."""
    rnd = random.Random(11)
    rows = [(rnd.choice([1, 2, 3]) if i % 10 == 0 else None if i % 10 == 1 else 100 + i, i % 2) for i in range(20000)]
    df = spark.createDataFrame(rows, "k long, b int").repartition(6)
    n, found = sketched(df, "k", max_hot=100)
    assert n == 20000 and len(found) < 200
    exact = {r.k: r.n for r in df.where("k is not null").groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()}
    hot = {k for k, c in exact.items() if c * 100 > n}
    assert hot == {1, 2, 3}
    assert {r.k for r in hot_keys(df, "k", max_hot=100).collect()} == hot
    pairs = {(r.k, r.b) for r in hot_keys(df, ["k", "b"], max_hot=100).collect()}
    counts = {}
    for k, b in rows:
        counts[k, b] = counts.get((k, b), 0) + 1
    assert pairs == {p for p, c in counts.items() if c * 100 > n and p[0] is not None}
    assert hot_keys(df.limit(0), "k").count() == 0
    total = df.groupBy("k").agg(F.count(F.lit(1)).alias("_rows"))
    by_counts = {r.k: r._spread for r in hot_of_counts(total, "k", max_hot=100, tasks=50).collect() if r.k is not None}
    assert by_counts == {r.k: r._spread for r in hot_keys(df, "k", max_hot=100, tasks=50).collect()}


def test_sketches_merged_in_groups(spark, monkeypatch):
    """Keys that single groups of tasks see little of are found all the same."""
    monkeypatch.setattr(skew, "SKETCH_TASKS", 2)
    rows = [(7 if i % 40 == 0 else 1000 + i,) for i in range(8000)]
    df = spark.createDataFrame(rows, "k long").repartition(11)
    n, found = sketched(df, "k", max_hot=50)
    assert n == 8000 and {r.k for r in hot_keys(df, "k", max_hot=50).collect()} == {7} and len(found) < 100


def test_sketch_join_equals_plain_join(spark):
    rows = [(1 if i % 3 == 0 else None if i % 3 == 1 else i % 500, i) for i in range(3000)]
    left = spark.createDataFrame(rows, "k long, b long")
    right = spark.createDataFrame([(k, f"v{k}") for k in range(0, 600)] + [(None, "null")], "k long, v string")
    got = salted_left_join(left, right, "k", ["b"], spread=6, max_hot=20)
    want = left.join(right, "k", "left")
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def _pairwise_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def test_hot_score_auc_is_exact(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(900):
        y = rnd.randint(0, 1)
        s = 0.5 if i % 3 == 0 else round(rnd.random() + 0.3 * y, 3)
        rows.append((y, s))
    df = spark.createDataFrame(rows, "label int, score double")
    got = exact_auc(df, buckets=8).collect()[0]["auc"]
    assert abs(got - _pairwise_auc(rows)) < 1e-12
    # the hot score is one row with all its counts, not a third of the table in one bucket
    c = cumulative_counts(df, buckets=8).where(F.col("score") == 0.5).collect()
    assert len(c) == 1 and c[0]["pos"] + c[0]["neg"] == 300


def test_grouped_auc_joins_offsets_without_forced_broadcast(spark):
    """With groups the offset table grows with the data: no broadcast hint is placed."""
    df = spark.range(2000).selectExpr("id % 50 AS g", "CAST(id % 2 AS INT) AS label",
                                      "rand(3) AS score")
    p = exact_auc(df, buckets=4, by=["g"])._jdf.queryExecution().analyzed().toString()
    assert "broadcast" not in p.lower()
    q = exact_auc(df, buckets=4)._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in q.lower()


def test_salted_join_composite_keys_with_other_names(spark):
    """A hot (business, user) pair and null users; the right side names its keys apart."""
    rows = [(1, 1, i) if i % 3 == 0 else (i % 50, None if i % 7 == 0 else i % 9, i)
            for i in range(1500)]
    left = spark.createDataFrame(rows, "b long, u long, rid long")
    right = (left.groupBy("b", "u").agg(F.count(F.lit(1)).alias("n"))
             .withColumnRenamed("b", "b2").withColumnRenamed("u", "u2"))
    out = salted_left_join(left, right, ["b", "u"], ["rid"], spread=4, right_key=["b2", "u2"])
    assert set(out.columns) == {"b", "u", "rid", "b2", "u2", "n"}
    cond = (left["b"] == right["b2"]) & (left["u"] == right["u2"])
    want = left.join(right, cond, "left")
    cols = ["b", "u", "rid", "b2", "u2", "n"]
    got_rows = sorted(map(tuple, out.select(*cols).collect()), key=repr)
    want_rows = sorted(map(tuple, want.select(*cols).collect()), key=repr)
    assert got_rows == want_rows and len(got_rows) == 1500
