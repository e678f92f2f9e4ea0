"""State kept per arrival: review roll-up, null profile, labels; ranked frequency tables."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from featuremill.operators.profile import fit_null_filter, null_profile, ranked_values
from featuremill.operators.profile_store import ProfileStore, profile_rows
from featuremill.operators.rollup import ROLLUP_COLUMNS, review_rollup
from featuremill.streaming.labels import read_labelled, refresh_labels
from featuremill.streaming.rollup import RollupState
from test_skew import USER_SCHEMA

REVIEWS = "review_id string, business_id long, user_id long, stars double, useful long, funny long, cool long"


def _reviews(seed, n, first=0):
    r = random.Random(seed)
    return [(f"r{first + i}", r.choice([None, *range(12)]), r.choice([None, *range(9)]), r.choice([None, 1.0, 3.0, 5.0]),
             r.choice([None, 0, 4]), r.randint(0, 3), r.randint(0, 2)) for i in range(n)]


def _same(got, want):
    a, b = ({r[0]: tuple(r)[1:] for r in df.collect()} for df in (got, want))
    assert a.keys() == b.keys()
    for k in a:
        for c, x, y in zip(ROLLUP_COLUMNS, a[k], b[k]):
            assert (x is None and y is None) or abs(x - y) <= 1e-9 * max(1.0, abs(y)), (k, c, x, y)


def test_rollup_of_arrivals_equals_batch(spark, tmp_path):
    users = spark.createDataFrame([(u, float(u % 5), u % 7, 40 + u, u, u % 13, 1.5 + u, u % 3, u % 9) for u in range(8)],
                                  USER_SCHEMA)
    state, rows = RollupState(str(tmp_path / "state")), []
    for batch, n in enumerate((40, 25, 1, 30)):
        new = _reviews(batch, n, len(rows))
        rows += new
        state.fold(spark.createDataFrame(new, REVIEWS), users, batch)
        if batch == 1:  # the batch is run again after a failure
            state.fold(spark.createDataFrame(new, REVIEWS), users, batch)
        _same(state.read(spark), review_rollup(spark.createDataFrame(rows, REVIEWS), users))


def test_a_users_average_reaches_all_its_businesses(spark, tmp_path):
    """Only the businesses of the arrival and of its users are worked out anew."""
    users = spark.createDataFrame([(1, 1.0, 1, 40, 1, 1, 1.0, 1, 1), (2, 1.0, 1, 40, 1, 1, 1.0, 1, 1)], USER_SCHEMA)
    state = RollupState(str(tmp_path / "state"))
    state.fold(spark.createDataFrame([("a", 10, 1, 5.0, 0, 0, 0), ("b", 11, 1, 5.0, 0, 0, 0), ("c", 12, 2, 5.0, 0, 0, 0)],
                                     REVIEWS), users, 0)
    state.fold(spark.createDataFrame([("d", 13, 1, 5.0, 9, 0, 0)], REVIEWS), users, 1)
    got = {r.business_id: r.avg_useful_per_user for r in state.read(spark).collect()}
    assert got == {10: 3.0, 11: 3.0, 12: 0.0, 13: 3.0}
    second = spark.read.parquet(f"{state.base}/rollup/batch=1")
    assert {r.business_id for r in second.collect()} == {10, 11, 13}


def test_merged_profile_equals_the_whole(spark, tmp_path):
    r = random.Random(3)
    rows = [(i, r.choice([None, "a", "NaN", f"t{i}"]), r.choice([None, float("nan"), r.random()]), r.choice([None, True]))
            for i in range(400)]
    df = spark.createDataFrame(rows, "k long, s string, x double, b boolean")
    store = ProfileStore(str(tmp_path / "profile"))
    for arrival in range(3):
        store.add(df.where(F.col("k") % 3 == arrival), arrival)
    store.add(df.where("k % 3 = 2"), 2)  # profiled again
    got = {r.column_name: r for r in store.profile(spark).collect()}
    want = {r.column_name: tuple(r) for r in null_profile(df).collect()}
    assert {c: tuple(x)[:4] for c, x in got.items()} == want
    assert (got["k"].low_number, got["k"].high_number) == (0.0, 399.0) and got["b"].low == got["b"].high == "true"
    present = [x for _, _, x, _ in rows if x is not None and x == x]
    assert (got["x"].low_number, got["x"].high_number) == (min(present), max(present))
    n = len({s for _, s, _, _ in rows if s not in (None, "NaN")})
    assert abs(got["s"].n_distinct - n) <= 0.05 * n
    for share in (0.2, 0.3, 0.9):
        assert store.null_filter(spark, share) == fit_null_filter(df, share)
    assert spark.read.parquet(store.base).count() == 12  # a row per column and arrival is all that is read


def test_profile_of_an_arrival_without_a_column(spark, tmp_path):
    store = ProfileStore(str(tmp_path / "profile"))
    store.add(spark.range(6).selectExpr("id AS k", "CAST(NULL AS STRING) AS s"), 0)
    store.add(spark.range(4).selectExpr("id AS k"), 1)
    store.add(spark.range(0).selectExpr("id AS k"), 2)
    got = {r.column_name: (r.n_missing, r.n_rows) for r in store.profile(spark).collect()}
    assert got == {"k": (0, 10), "s": (10, 10)}
    assert profile_rows(spark.range(0)).count() == 1


def test_late_and_repeated_labels(spark, tmp_path):
    schema = "business_id long, delivery_or_takeout string, day string"
    arrivals = [[(1, "TRUE", "2020-05-01"), (2, "FALSE", "2020-05-01"), (1, "TRUE", "2020-05-02")],
                [(1, "TRUE", "2020-05-03"), (3, "TRUE", "2011-01-01"), (9, "TRUE", "2020-01-01")],  # late; no entity
                [(2, "TRUE", "2019-01-01"), (3, "TRUE", "2020-06-01"), (None, "TRUE", "2020-06-01")]]
    entity = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], "business_id long, city string")
    base = str(tmp_path)
    for i, rows in enumerate(arrivals):
        spark.createDataFrame(rows, schema).write.json(f"{base}/in/{i}")
        refresh_labels(spark, f"{base}/in/*", schema, entity, f"{base}/table", f"{base}/checkpoint", fmt="json")
    got = sorted(map(tuple, read_labelled(spark, f"{base}/table").collect()))
    assert got == [(1, "a", "TRUE"), (2, "b", "FALSE"), (2, "b", "TRUE"), (3, "c", "TRUE")]
    # the state has dropped the repeats before they were joined
    assert spark.read.parquet(f"{base}/table").count() == 4


@pytest.mark.parametrize("k", [1, 3, 100])
def test_ranked_values(spark, k):
    r = random.Random(1)
    rows = [(i, r.choice([None, "a", "b", "c", "d"]), r.choice(["x", "y"])) for i in range(200)]
    df = spark.createDataFrame(rows, "k long, s string, t string").repartition(5)
    ranked = ranked_values(df, ["s", "t"], k)
    assert "WindowGroupLimit" in ranked._jdf.queryExecution().optimizedPlan().toString()
    got = sorted(map(tuple, ranked.collect()), key=str)
    want = []
    for name, at in (("s", 1), ("t", 2)):
        counts = Counter(row[at] for row in rows)
        best = sorted(counts.items(), key=lambda x: (-x[1], x[0] is not None, x[0] or ""))[:k]
        want += [(name, v, n, i + 1) for i, (v, n) in enumerate(best)]
    assert got == sorted(want, key=str)
