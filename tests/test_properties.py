"""Properties: roll-up = window averages, exact AUC = pairwise AUC, split invariants,
one-hot and schedule class sums, base table grain."""

import random

import pytest
from pyspark.sql import functions as F

from featuremill.operators.evaluate import exact_auc, roc_points
from featuremill.operators.rollup import ROLLUP_COLUMNS, review_rollup, user_features
from featuremill.operators.split import hash_split
from featuremill.plans import standins as S
from featuremill.plans.entity import fit_entity_features
from featuremill.plans.q_features import flagship

from conftest import SF001, SF01
from rollup_check import expected_rollup


def _close(a, b, tol=1e-9):
    if a is None or b is None:
        return a is None and b is None
    return abs(a - b) <= tol * max(1.0, abs(a), abs(b))


def _check_rollup(review, users):
    f = {r[0]: r[1:] for r in review_rollup(review, users).collect()}
    s = expected_rollup(review, users)
    assert f.keys() == s.keys()
    for k in f:
        for i, c in enumerate(ROLLUP_COLUMNS):
            assert _close(f[k][i], s[k][i]), (k, c, f[k][i], s[k][i])


def test_rollup_equals_window_averages_on_standins(spark):
    review = S.role(spark, SF01, "review")
    users = user_features(S.role(spark, SF01, "user"), S.COMPLIMENTS)
    _check_rollup(review, users)


def test_rollup_equals_window_averages_on_fixture(spark):
    review = spark.createDataFrame([
        ("r1", 1, 10, 4.0, 1, 0, 2), ("r2", 1, 10, 2.0, 3, 1, 0), ("r3", 1, 11, None, 2, 0, 0),
        ("r4", 1, None, 5.0, 0, 2, 1), ("r5", 2, 12, 3.0, None, 0, 0), ("r6", 2, 10, 1.0, 4, 0, 0),
        ("r7", 3, 13, None, 1, 1, 1), (None, 3, 13, 2.0, 1, 1, 1)],
        "review_id string, business_id int, user_id int, stars double, useful long, "
        "funny long, cool long")
    users = spark.createDataFrame([
        (10, 50, 4.5, 3, 1.0, 2.0, 10.5, 1, 5), (11, 40, None, 1, 3.0, 1.0, 2.0, None, 0),
        (13, 31, 3.0, 0, 0.0, 0.0, 1.0, 0, 1)],
        "user_id int, review_count long, average_stars double, fans long, "
        "received_compliments double, given_votes double, loyalty double, elite_years int, "
        "friend_count int")
    # user 12 is unknown (filtered out as a light user), user None never joins
    _check_rollup(review, users)


def test_overall_rating_identity(spark):
    """Average of the per-business average = the per-pair weighted average when every
    review has a user and stars."""
    review = S.role(spark, SF001, "review").where("user_id IS NOT NULL AND stars IS NOT NULL")
    users = user_features(S.role(spark, SF001, "user"), S.COMPLIMENTS, min_reviews=None)
    out = review_rollup(review, users).collect()
    assert all(_close(r["avg_overall_rating"], r["avg_rating_per_user"]) for r in out)


def _pairwise_auc(labels, scores):
    pos = [s for y, s in zip(labels, scores) if y == 1]
    neg = [s for y, s in zip(labels, scores) if y == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


@pytest.mark.parametrize("buckets", [1, 3, 8, 50])
def test_exact_auc_equals_pairwise(spark, buckets):
    rnd = random.Random(7)
    labels = [rnd.randint(0, 1) for _ in range(200)]
    scores = [round(rnd.random() + 0.3 * y, 1) for y in labels]  # many ties
    df = spark.createDataFrame(list(zip(labels, scores)), "label int, score double")
    r = exact_auc(df, "label", "score", buckets=buckets).first()
    assert _close(r["auc"], _pairwise_auc(labels, scores), 1e-12)
    assert r["n_pos"] == sum(labels)


@pytest.mark.parametrize("case,expected", [("perfect", 1.0), ("reversed", 0.0),
                                           ("ties", 0.5), ("one_class", None)])
def test_auc_edge_cases(spark, case, expected):
    data = {"perfect": [(1, 0.9), (1, 0.8), (0, 0.2), (0, 0.1)],
            "reversed": [(0, 0.9), (0, 0.8), (1, 0.2), (1, 0.1)],
            "ties": [(0, 0.5), (1, 0.5), (0, 0.5), (1, 0.5)],
            "one_class": [(1, 0.9), (1, 0.2)]}[case]
    df = spark.createDataFrame(data, "label int, score double")
    assert exact_auc(df, buckets=2).first()["auc"] == expected


def test_roc_monotone(spark):
    rnd = random.Random(3)
    data = [(rnd.randint(0, 1), round(rnd.random(), 2)) for _ in range(300)]
    df = spark.createDataFrame(data, "label int, score double")
    pts = roc_points(df, buckets=4).collect()
    origin = [p for p in pts if p["threshold"] is None]
    assert len(origin) == 1 and origin[0]["fpr"] == 0.0 and origin[0]["tpr"] == 0.0
    curve = sorted((p for p in pts if p["threshold"] is not None), key=lambda p: -p["threshold"])
    assert curve[-1]["fpr"] == 1.0 and curve[-1]["tpr"] == 1.0
    for a, b in zip(curve, curve[1:]):
        assert a["fpr"] <= b["fpr"] and a["tpr"] <= b["tpr"]


def test_hash_split_invariants(spark):
    df = spark.read.parquet(f"{SF01}/orders.parquet").select("o_orderkey")
    train, test = hash_split(df, "o_orderkey")
    tr = {r[0] for r in train.collect()}
    te = {r[0] for r in test.collect()}
    assert not (tr & te) and len(tr) + len(te) == df.count()
    assert 0.75 < len(tr) / (len(tr) + len(te)) < 0.85
    tr2, _ = hash_split(df.repartition(7), "o_orderkey")
    assert {r[0] for r in tr2.collect()} == tr


def test_entity_group_sums(spark):
    raw = S.raw_business(spark, SF01)
    e = fit_entity_features(raw, cities=S.CITIES).transform(raw)
    groups = [["alcohol_none", "alcohol_full_bar", "alcohol_beer_and_wine"],
              ["attire_null", "attire_none", "attire_casual", "attire_dressy", "attire_formal"],
              ["wifi_none", "wifi_no", "wifi_free", "wifi_paid"],
              [c for c in e.columns if c.startswith("city_")]]
    for g in groups:
        assert e.where(sum(F.col(c) for c in g) > 1).count() == 0, g
    for d in ("Monday", "Sunday"):
        s = F.col(f"miss_sched_{d}") + F.col(f"24h_{d}") + F.col(f"other_sched_{d}")
        assert e.where(s != 1).count() == 0
    assert e.where(F.expr("city_others") + sum(F.col(c) for c in groups[3] if c != "city_others")
                   != 1).count() == 0


def test_base_table_grain(spark):
    bt = flagship(spark, SF01)
    assert bt.groupBy("business_id", "target").count().where("count > 1").count() == 0
    assert bt.select("business_id").distinct().count() < bt.count()  # conflicting labels kept
