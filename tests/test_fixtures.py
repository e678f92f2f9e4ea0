"""Hand-made token fixtures: every hazard value the raw tables may hold."""

import math

import pytest
from pyspark.sql import functions as F

from featuremill.functions.columns import list_size
from featuremill.functions.predicates import flag_set, not_true
from featuremill.operators import encode as E
from featuremill.operators import profile as P
from featuremill.operators.activity import activity_features, checkin_spec, tip_spec
from featuremill.operators.basetable import base_table
from featuremill.plans.entity import ALCOHOL, ATTIRE, PRICE, WIFI


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).orderBy(cols[0]).collect()]


def test_split_categories_trim_and_out_of_range(spark):
    df = spark.createDataFrame(
        [(1, "Food, Bars"), (2, "Food,Bars"), (3, "Pizza"), (4, "a,b,c,d,e,f,g"), (5, ""),
         (6, None)], "id int, categories string")
    t = E.split_to_columns(df, "categories", k=5, trim=True)
    assert rows(t, "id", "cat1", "cat2", "cat5") == [
        (1, "Food", "Bars", None), (2, "Food", "Bars", None), (3, "Pizza", None, None),
        (4, "a", "b", "e"), (5, "", None, None), (6, None, None, None)]
    raw = E.split_to_columns(df, "categories", k=2, trim=False)
    assert rows(raw, "id", "cat2")[0] == (1, " Bars")
    flag = E.category_flag(df, "categories", ["Bars"], "isLeisure")
    assert [r[1] for r in rows(flag, "id", "isLeisure")] == [1, 1, 0, 0, 0, 0]
    untrimmed = E.category_flag(df, "categories", ["Bars"], "isLeisure", trim=False)
    assert [r[1] for r in rows(untrimmed, "id", "isLeisure")] == [0, 1, 0, 0, 0, 0]


def test_bool_tokens(spark):
    df = spark.createDataFrame([(1, "True"), (2, "False"), (3, "None"), (4, ""), (5, "abc"),
                                (6, None)], "id int, v string")
    got = rows(df.select("id", not_true("v").alias("nt")), "id", "nt")
    assert [r[1] for r in got] == [False, True, True, False, False, True]
    t = E.true_flag(df, "v", "flag", null_out="flag_null")
    assert rows(t, "id", "flag", "flag_null") == [
        (1, 1, 0), (2, 0, 0), (3, 0, 0), (4, 0, 0), (5, 0, 0), (6, 0, 1)]


def test_is_open_flag(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 2), (4, None)], "id int, is_open int")
    assert [r[0] for r in df.where(flag_set("is_open")).select("id").collect()] == [2]
    s = spark.createDataFrame([(1, "1"), (2, "x")], "id int, is_open string")
    assert [r[0] for r in s.where(flag_set("is_open")).select("id").collect()] == [1]


@pytest.mark.parametrize("groups,values,expected", [
    (ALCOHOL, ["None", "u'none'", "'none'", None, "u'full_bar'", "'beer_and_wine'", "other"],
     [(1, 0, 0), (1, 0, 0), (1, 0, 0), (1, 0, 0), (0, 1, 0), (0, 0, 1), (0, 0, 0)]),
    (WIFI, ["None", None, "u'no'", "'free'", "u'paid'", "x"],
     [(1, 0, 0, 0), (1, 0, 0, 0), (0, 1, 0, 0), (0, 0, 1, 0), (0, 0, 0, 1), (0, 0, 0, 0)]),
    (ATTIRE, [None, "None", "u'casual'", "'dressy'", "u'formal'", "x"],
     [(1, 0, 0, 0, 0), (0, 1, 0, 0, 0), (0, 0, 1, 0, 0), (0, 0, 0, 1, 0), (0, 0, 0, 0, 1),
      (0, 0, 0, 0, 0)]),
    (PRICE, [None, "None", "1", "2", "3", "4", "5"],
     [(1, 0, 0, 0, 0), (1, 0, 0, 0, 0), (0, 1, 0, 0, 0), (0, 0, 1, 0, 0), (0, 0, 0, 1, 0),
      (0, 0, 0, 0, 1), (0, 0, 0, 0, 0)]),
])
def test_token_groups(spark, groups, values, expected):
    df = spark.createDataFrame(list(enumerate(values)), "id int, v string")
    out = E.one_hot_tokens(df, "v", groups)
    got = [r[1:] for r in rows(out, "id", *[g.out for g in groups])]
    assert got == expected
    assert all(sum(r) <= 1 for r in got)


def test_hours_sentinel(spark):
    df = spark.createDataFrame([(1, "0:0-0:0"), (2, "9:0-17:0"), (3, None)], "id int, h string")
    out = E.sentinel_class(df, {"h": "Mon"})
    got = rows(out, "id", "miss_sched_Mon", "24h_Mon", "other_sched_Mon")
    assert got == [(1, 0, 1, 0), (2, 0, 0, 1), (3, 1, 0, 0)]
    assert all(sum(r[1:]) == 1 for r in got)


def test_frequent_cities(spark):
    data = ([("A",)] * 44 + [("B",)] * 45 + [("C",)] * 46 + [("St. John",)] * 47
            + [("North York",)] * 48 + [(None,)] * 50)
    df = spark.createDataFrame([(i, c) for i, (c,) in enumerate(data)], "id int, city string")
    frequent = [r["city"] for r in E.frequent_values(df, "city", 45).collect()]
    spec = E.frequent_one_hot_spec("city", frequent, prefix="city_", others="city_others")
    assert spec.values == ("C", "North York", "St. John")
    assert spec.names() == ["city_C", "city_North_York", "city_St__John"]
    out = spec.apply(df)
    agg = out.agg(*[F.sum(c).alias(c) for c in ["city_others"] + spec.names()]).first()
    assert tuple(agg) == (44 + 45 + 50, 46, 48, 47)
    with pytest.raises(ValueError):
        E.frequent_one_hot_spec("city", ["St. John", "St  John"])


def test_activity_zero_span_rules(spark):
    df = spark.createDataFrame(
        [(1, "2019-05-01 10:00:00", 7, "2"), (2, "2019-01-31 00:00:00", 8, "x"),
         (2, "2020-01-31 00:00:00", 9, "3"), (3, "2018-02-28 00:00:00", None, None)],
        "business_id int, date string, user_id int, compliment_count string")
    c = {r[0]: r for r in activity_features(df, checkin_spec()).collect()}
    assert c[1]["checkin_count"] == 1 and c[1]["avg_checkin_yr"] is None
    assert c[2]["checkin_date_diff"] == 365 / 365.25
    assert c[2]["checkin_recency_months"] == 1.03225806  # 2020-03-01 vs 2020-01-31
    t = {r[0]: r for r in activity_features(df, tip_spec()).collect()}
    assert t[1]["avg_tips_year"] == 1.0 and t[1]["total_compliment_ct"] == 2
    assert t[2]["total_compliment_ct"] == 3  # "x" does not parse
    assert t[3]["users_tip_ct"] == 0 and t[3]["avg_tips_year"] == 0.0
    assert c[3]["checkin_recency_months"] == 24.12903226  # 25 months minus 27/31


def test_label_conflicts_and_case(spark):
    ent = spark.createDataFrame([(1,), (2,), (3,), (4,)], "business_id int")
    lab = spark.createDataFrame([(1, "TRUE"), (1, "TRUE"), (2, "TRUE"), (2, "FALSE"),
                                 (3, "true")], "business_id int, lbl string")
    bt = base_table(ent, lab, [], label_col="lbl")
    assert sorted(tuple(r) for r in bt.collect()) == [(1, 1), (2, 0), (2, 1), (3, 0)]
    anyt = base_table(ent, lab, [], label_col="lbl", conflict="any_true")
    assert sorted(tuple(r) for r in anyt.collect()) == [(1, 1), (2, 1), (3, 0)]


def test_list_sizes(spark):
    df = spark.createDataFrame([(1, ""), (2, "None"), (3, "2015"), (4, "2015,2016"), (5, None)],
                               "id int, v string")
    got = rows(df.select("id", list_size("v").alias("a"), list_size("v", mode="count").alias("b")),
               "id", "a", "b")
    assert got == [(1, 0, 0), (2, 0, 0), (3, 0, 1), (4, 1, 2), (5, None, 0)]


def test_null_profile_and_filter(spark):
    df = spark.createDataFrame(
        [(1, float("nan"), "NaN", None), (2, 1.0, "a", None), (3, None, "b", None),
         (4, 2.0, None, "x")], "id int, d double, s string, mostly_null string")
    prof = {r["column_name"]: r for r in P.null_profile(df).collect()}
    assert prof["d"]["n_missing"] == 2 and prof["s"]["n_missing"] == 2
    assert prof["mostly_null"]["missing_share"] == 0.75
    spec = P.fit_null_filter(df, 0.75)
    assert spec.kept == ("id", "d", "s", "mostly_null") and spec.removed == ()
    spec2 = P.fit_null_filter(df, 0.5)
    assert spec2.removed == ("mostly_null",)
    empty = df.limit(0)
    assert P.fit_null_filter(empty, 0.75).removed == ()
    assert math.isclose(prof["id"]["missing_share"], 0.0)


def test_fill_defaults_by_type(spark):
    df = spark.createDataFrame([(None, None, None, None, None)],
                               "i int, d double, s string, b boolean, dt date")
    r = E.fill_defaults(df).first()
    assert (r.i, r.d, r.s, r.b, r.dt) == (0, 0.0, "0", None, None)


def test_user_review_count_boundary(spark):
    from featuremill.operators.rollup import user_features
    df = spark.createDataFrame(
        [(1, 29, 1, 1, 1, "2010-01-01 00:00:00", "", None), (2, 30, 1, 1, 1, None, "2015", "a"),
         (3, 31, 1, 1, 1, "2015-06-01 12:00:00", "2015,2016", "a,b,c"),
         (4, None, 1, 1, 1, None, None, None)],
        "user_id int, review_count long, c1 long, c2 long, useful long, since string, "
        "elite string, friends string")
    out = user_features(df, ["c1", "c2"], vote_cols=["useful"], drop=())
    r = out.collect()
    assert [x.user_id for x in r] == [3]
    assert r[0].received_compliments == 2 and r[0].given_votes == 1
    assert r[0].elite_years == 1 and r[0].friend_count == 2
    assert r[0].loyalty == round((1593561600 - 1433160000) / 2629743, 3)


def test_encoders_fail_early(spark):
    from featuremill.plans.entity import fit_entity_features
    from featuremill.plans.standins import raw_business
    from conftest import SF001
    raw = raw_business(spark, SF001)
    model = fit_entity_features(raw)
    with pytest.raises(ValueError, match="attributes_WiFi"):
        model.transform(raw.drop("attributes.WiFi"))
    df = spark.createDataFrame([(1, "True", 0)], "id int, v string, flag int")
    with pytest.raises(ValueError, match="overwrite"):
        E.true_flag(df, "v", "flag")


def test_frequent_category_matches_wide(spark):
    from featuremill.session import scratch_path
    data = [("A",)] * 44 + [("B",)] * 46 + [("St. John",)] * 47 + [(None,)] * 50
    df = spark.createDataFrame([(i, c) for i, (c,) in enumerate(data)], "id int, city string")
    wide = E.frequent_one_hot_spec("city", ["B", "St. John"], "city_", "city_others")
    cat = E.fit_frequent_category(df, "city", 45, scratch_path(spark, "fc"))
    w = {r["id"]: r for r in wide.apply(df, drop=False).collect()}
    c = {r["id"]: r["city_group"] for r in cat.apply(df, drop=False).collect()}
    assert len(c) == len(w)
    for i, r in w.items():
        expect = "others" if r["city_others"] == 1 else r["city"]
        assert c[i] == expect


def test_entity_city_layouts(spark):
    from featuremill.plans.entity import fit_entity_features
    from featuremill.plans.standins import raw_business
    from conftest import SF001, SF01
    raw = raw_business(spark, SF01)
    cat = fit_entity_features(raw).transform(raw)
    per_group = {r[0]: r[1] for r in cat.groupBy("city_group").count().collect()}
    cities = sorted(set(per_group) - {"others"})
    wide = fit_entity_features(raw, cities=cities).transform(raw)
    assert len([c for c in wide.columns if c.startswith("city_")]) == len(cities) + 1
    assert cat.count() == wide.count()
    assert per_group["others"] == wide.where("city_others = 1").count()
    # the default layout has the same columns at every size
    small = raw_business(spark, SF001)
    assert fit_entity_features(small).transform(small).columns == cat.columns
