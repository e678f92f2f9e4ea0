"""Registered queries: activity, user, review roll-up, entity features, base table."""

from __future__ import annotations

from pyspark.sql import functions as F

from featuremill.operators.activity import (CHECKIN_NAMES, TIP_NAMES, activity_features,
                                            activity_span, checkin_spec, tip_spec)
from featuremill.operators.basetable import assemble, base_table, label_table
from featuremill.operators.encode import fill_defaults, label_target
from featuremill.operators.rollup import (ROLLUP_COLUMNS, review_rollup, user_features)
from featuremill.plans import standins as S
from featuremill.plans.catalog import T, register, role, round_cols, sql_activity, sql_to_date
from featuremill.plans.entity import (ALCOHOL, ALL_DAY, ATTIRE, CONTAINS_FLAGS, DAYS,
                                      FREQUENT_CITY_COUNT, LEISURE_CATEGORIES, PRICE,
                                      TRUE_FLAGS, WIFI, fit_entity_features)
from featuremill.session import scratch_path
from featuremill.sources.versions import VersionedTables

ROLLUP_AVGS = [c for c in ROLLUP_COLUMNS if c not in ("cool_reviews", "funny_reviews",
                                                      "useful_reviews")]


# -- activity ---------------------------------------------------------------------------

def checkin_features(spark, sf):
    return activity_features(role(spark, sf, "checkin"), checkin_spec())


def tip_features(spark, sf):
    return activity_features(role(spark, sf, "tip"), tip_spec())


def _checkin_sql():
    return sql_activity(T("checkin"), "business_id", CHECKIN_NAMES, "null")


def _tip_sql():
    return sql_activity(T("tip"), "user_id", TIP_NAMES, "count",
                        sums=", CAST(sum(TRY_CAST(compliment_count AS INTEGER)) AS BIGINT) AS s",
                        sum_cols=", s AS total_compliment_ct")


def _entity_keys(spark, sf):
    return role(spark, sf, "business").select("business_id")


def _fill_sql(cols_int, cols_dbl, src):
    parts = [f"coalesce({c}, 0) AS {c}" for c in cols_int]
    parts += [f"coalesce({c}, 0.0) AS {c}" for c in cols_dbl]
    return ", ".join(parts)


@register("features_activity_null_rate", sql=lambda: f"""
SELECT b.business_id, {_fill_sql(['checkin_count'], ['checkin_recency_months',
       'checkin_date_diff', 'avg_checkin_yr'], 'a')}
FROM {T('business')} b LEFT JOIN {_checkin_sql()} a ON b.business_id = a.business_id""")
def q_activity_null_rate(spark, sf):
    """Check-in count, recency, span and rate for every business (0 when absent)."""
    return fill_defaults(_entity_keys(spark, sf).join(checkin_features(spark, sf),
                                                      "business_id", "left"))


@register("features_activity_count_rate", sql=lambda: f"""
SELECT b.business_id, {_fill_sql(['users_tip_ct', 'total_compliment_ct'],
       ['tips_recency_months', 'tips_date_diff', 'avg_tips_year'], 'a')}
FROM {T('business')} b LEFT JOIN {_tip_sql()} a ON b.business_id = a.business_id""")
def q_activity_count_rate(spark, sf):
    return fill_defaults(_entity_keys(spark, sf).join(tip_features(spark, sf),
                                                      "business_id", "left"))


@register("agg_min_max_count", sql=lambda: f"""
SELECT business_id, min(d) AS first_date, max(d) AS last_date, count(business_id) AS n
FROM (SELECT business_id, {sql_to_date('date')} AS d FROM {T('checkin')}) GROUP BY business_id""")
def q_min_max_count(spark, sf):
    g = activity_span(role(spark, sf, "checkin"), "business_id", "date", "business_id", "n")
    return g.select("business_id", F.col("_first").alias("first_date"),
                    F.col("_last").alias("last_date"), "n")


@register("date_to_date", sql=lambda: f"""
SELECT business_id, date, {sql_to_date('date')} AS day FROM {T('checkin')}""")
def q_to_date(spark, sf):
    from featuremill.functions.dates import to_date_safe
    c = role(spark, sf, "checkin")
    return c.select("business_id", "date", to_date_safe("date", c.schema["date"].dataType)
                    .alias("day"))


@register("activity_recency", sql=lambda: f"""
SELECT business_id, checkin_recency_months FROM {_checkin_sql()}""")
def q_recency(spark, sf):
    return checkin_features(spark, sf).select("business_id", "checkin_recency_months")


@register("activity_span_years", sql=lambda: f"""
SELECT business_id, checkin_date_diff, tips_date_diff
FROM {_checkin_sql()} c FULL JOIN {_tip_sql()} t USING (business_id)""")
def q_span_years(spark, sf):
    c = checkin_features(spark, sf).select("business_id", "checkin_date_diff")
    t = tip_features(spark, sf).select("business_id", "tips_date_diff")
    return c.join(t, "business_id", "full")


@register("activity_rate", sql=lambda: f"""
SELECT c.business_id, c.avg_checkin_yr, t.avg_tips_year
FROM {_checkin_sql()} c LEFT JOIN {_tip_sql()} t ON c.business_id = t.business_id""")
def q_rate(spark, sf):
    """Both zero-span rules: check-ins keep null, tips fall back to the count."""
    c = checkin_features(spark, sf).select("business_id", "avg_checkin_yr")
    t = tip_features(spark, sf).select("business_id", "avg_tips_year")
    return c.join(t, "business_id", "left")


# -- users and reviews ------------------------------------------------------------------

def users(spark, sf, min_reviews=30):
    return user_features(role(spark, sf, "user"), S.COMPLIMENTS, min_reviews=min_reviews)


def _list_size_sql(c, mode="reference"):
    if mode == "reference":
        return f"CASE WHEN {c} IS NULL THEN NULL ELSE len(string_split({c}, ',')) - 1 END"
    return (f"CASE WHEN {c} IS NULL OR {c} IN ('', 'None') THEN 0 "
            f"ELSE len(string_split({c}, ',')) END")


def _tenure_sql(c):
    return (f"round((epoch(TIMESTAMP '2020-07-01 00:00:00') - epoch(TRY_CAST({c} AS TIMESTAMP)))"
            f" / 2629743.0, 3)")


def user_features_sql(min_reviews=30):
    comp = " + ".join(S.COMPLIMENTS)
    return f"""(SELECT user_id, review_count, average_stars, fans, since,
  {comp} AS received_compliments, useful + funny + cool AS given_votes,
  {_tenure_sql('since')} AS loyalty,
  {_list_size_sql('elite')} AS elite_years, {_list_size_sql('friends')} AS friend_count
FROM {T('user')} WHERE review_count > {min_reviews})"""


@register("features_user", sql=lambda: f"SELECT * FROM {user_features_sql()}")
def q_user_features(spark, sf):
    return users(spark, sf)


@register("date_tenure_months", sql=lambda: f"""
SELECT user_id, since, {_tenure_sql('since')} AS loyalty FROM {T('user')}""")
def q_tenure(spark, sf):
    from featuremill.functions.dates import tenure_months
    u = role(spark, sf, "user")
    return u.select("user_id", "since", tenure_months("since", "2020-07-01 00:00:00",
                                                      u.schema["since"].dataType).alias("loyalty"))


@register("array_list_size", sql=lambda: f"""
SELECT user_id, elite, friends, {_list_size_sql('elite')} AS elite_years,
  {_list_size_sql('friends')} AS friend_count,
  {_list_size_sql('elite', 'count')} AS elite_n, {_list_size_sql('friends', 'count')} AS friends_n
FROM {T('user')}""")
def q_list_size(spark, sf):
    from featuremill.functions.columns import list_size
    u = role(spark, sf, "user")
    return u.select("user_id", "elite", "friends",
                    list_size("elite").alias("elite_years"),
                    list_size("friends").alias("friend_count"),
                    list_size("elite", mode="count").alias("elite_n"),
                    list_size("friends", mode="count").alias("friends_n"))


def rollup(spark, sf):
    return review_rollup(role(spark, sf, "review"), users(spark, sf))


def rollup_sql():
    """Averages over review rows, each row carrying its pair's and its user's window average.
    (The average over a business's reviews of that business's own average or count is that
    average or count.)"""
    measures = {
        "avg_overall_rating": "stars", "avg_rating_per_user": "pair_stars",
        "average_stars_user": "average_stars", "avg_users_fans": "fans",
        "avg_reviews_per_user": "review_count", "avg_users_compliments": "received_compliments",
        "avg_users_given_votes": "given_votes", "avg_users_loyalty": "loyalty",
        "avg_user_elite_yrs": "elite_years", "avg_users_friends": "friend_count",
        "avg_useful_per_user": "user_useful"}
    sel = ", ".join(f"round(avg({src}), 9) AS {out}" for out, src in measures.items())
    votes = ", ".join(f"CAST(sum({v}) AS BIGINT) AS {v}_reviews" for v in ("cool", "funny", "useful"))
    return f"""(SELECT business_id, {votes}, CAST(count(review_id) AS DOUBLE) AS avg_rating_count, {sel}
FROM (SELECT r.*, uf.* EXCLUDE (user_id, since),
    CASE WHEN r.user_id IS NOT NULL THEN avg(r.stars) OVER (PARTITION BY r.business_id, r.user_id) END
      AS pair_stars,
    CASE WHEN uf.user_id IS NOT NULL THEN avg(r.useful) OVER (PARTITION BY r.user_id) END AS user_useful
  FROM {T('review')} r LEFT JOIN {user_features_sql()} uf ON r.user_id = uf.user_id)
GROUP BY business_id)"""


@register("agg_review_rollup", sql=lambda: f"SELECT * FROM {rollup_sql()}")
def q_rollup(spark, sf):
    return round_cols(rollup(spark, sf), ROLLUP_AVGS)


# -- entity features and base table -----------------------------------------------------

def entity(spark, sf):
    raw = S.raw_business(spark, sf)
    return fit_entity_features(raw).transform(raw)


def _q(v):
    return "'" + v.replace("'", "''") + "'"


def _in(tokens):
    return "(" + ", ".join(_q(t) for t in tokens) + ")"


def _flag(cond):
    return f"CASE WHEN {cond} THEN 1 ELSE 0 END"


def _groups_sql(c, groups):
    out = []
    for g in groups:
        cond = f"{c} IN {_in(g.tokens)}" if g.tokens else "FALSE"
        if g.null_in:
            cond = f"({cond} OR {c} IS NULL)"
        out.append(f"{_flag(cond)} AS {g.out}")
    return out


def leisure_sql(c="categories"):
    parts = [f"trim(string_split({c}, ',')[{i}])" for i in range(1, 6)]
    cats = _in(dict.fromkeys(LEISURE_CATEGORIES))
    return _flag(" OR ".join(f"{p} IN {cats}" for p in parts))


def candidates_sql():
    """Candidate rows (open, no delivery, no take-out), with the leisure flag."""
    def not_true(c):
        return f"(TRY_CAST({c} AS BOOLEAN) = false OR {c} IS NULL OR {c} = 'None')"
    return f"""(SELECT *, {leisure_sql()} AS isLeisure FROM {T('business')}
WHERE {not_true('attributes_RestaurantsDelivery')} AND {not_true('attributes_RestaurantsTakeOut')}
  AND TRY_CAST(is_open AS INTEGER) = 1)"""


def frequent_cities_sql(min_count=FREQUENT_CITY_COUNT):
    return (f"(SELECT city FROM {candidates_sql()} WHERE city IS NOT NULL GROUP BY city "
            f"HAVING count(business_id) > {min_count})")


def city_group_sql(city="city"):
    return f"CASE WHEN {city} IN {frequent_cities_sql()} THEN {city} ELSE 'others' END"


def entity_sql():
    cols = ["e.business_id", "e.isLeisure"]
    cols += _groups_sql("attributes_Alcohol", ALCOHOL)
    cols += _groups_sql("attributes_RestaurantsAttire", ATTIRE)
    cols += _groups_sql("attributes_RestaurantsPriceRange2", PRICE)
    cols += _groups_sql("attributes_WiFi", WIFI)
    for src, out in CONTAINS_FLAGS.items():
        cols.append(f"{_flag(f'contains({src}, {_q('True')})')} AS {out}")
    for src, (out, null_out) in TRUE_FLAGS.items():
        if null_out:
            cols.append(f"{_flag(f'{src} IS NULL')} AS {null_out}")
        cols.append(f"{_flag(f'{src} = {_q('True')}')} AS {out}")
    cols.append(f"{city_group_sql('e.city')} AS city_group")
    cols.append(f"{_flag('hours_Saturday IS NOT NULL OR hours_Sunday IS NOT NULL')}"
                " AS open_weekends")
    for d in DAYS:
        h = f"hours_{d}"
        cols += [f"{_flag(f'{h} IS NULL')} AS miss_sched_{d}",
                 f"{_flag(f'{h} = {_q(ALL_DAY)}')} AS \"24h_{d}\"",
                 f"{_flag(f'{h} IS NOT NULL AND {h} <> {_q(ALL_DAY)}')}"
                 f" AS other_sched_{d}"]
    return f"(SELECT {', '.join(cols)} FROM {candidates_sql()} e)"


@register("features_entity", sql=lambda: f"SELECT * FROM {entity_sql()}")
def q_entity(spark, sf):
    return entity(spark, sf)


def flagship(spark, sf):
    """The base table: entity features, labels, check-ins, tips, review roll-up."""
    feats = [checkin_features(spark, sf), tip_features(spark, sf), rollup(spark, sf)]
    bt = base_table(entity(spark, sf), role(spark, sf, "label"), feats)
    return round_cols(bt, ROLLUP_AVGS)


def flagship_sql():
    checkin = ["checkin_count"], ["checkin_recency_months", "checkin_date_diff", "avg_checkin_yr"]
    tips = (["users_tip_ct", "total_compliment_ct"],
            ["tips_recency_months", "tips_date_diff", "avg_tips_year"])
    rints = ["cool_reviews", "funny_reviews", "useful_reviews"]
    fill = ", ".join([_fill_sql(*checkin, ""), _fill_sql(*tips, ""),
                      _fill_sql(rints, ROLLUP_AVGS, "")])
    return f"""SELECT e.*, CASE WHEN l.delivery_or_takeout = 'TRUE' THEN 1 ELSE 0 END AS target,
  {fill}
FROM {entity_sql()} e
JOIN (SELECT DISTINCT business_id, delivery_or_takeout FROM {T('label')}) l
  ON e.business_id = l.business_id
LEFT JOIN {_checkin_sql()} c ON e.business_id = c.business_id
LEFT JOIN {_tip_sql()} t ON e.business_id = t.business_id
LEFT JOIN {rollup_sql()} r ON e.business_id = r.business_id"""


@register("basetable_flagship", sql=flagship_sql)
def q_flagship(spark, sf):
    return flagship(spark, sf)


@register("basetable_bucketed", sql=flagship_sql)
def q_flagship_bucketed(spark, sf):
    """The base table from a version of bucketed feature tables: the joins on the entity key read
    buckets and shuffle nothing (``sources.versions``)."""
    store = VersionedTables(scratch_path(spark, "feature-versions"))
    parts = {"entity": entity(spark, sf),
             "label": label_table(role(spark, sf, "label"), "business_id", "delivery_or_takeout"),
             "checkin": checkin_features(spark, sf), "tip": tip_features(spark, sf), "rollup": rollup(spark, sf)}
    store.refresh(parts, "business_id", int(spark.conf.get("spark.sql.shuffle.partitions")))
    return flagship_of_version(store.open(spark))


def flagship_of_version(table):
    """The base table over ``table(name)`` of one version."""
    out = assemble(table("entity"), table("label"), [table(n) for n in ("checkin", "tip", "rollup")], "business_id")
    return round_cols(label_target(fill_defaults(out), "delivery_or_takeout"), ROLLUP_AVGS)


# -- streaming --------------------------------------------------------------------------

@register("stream_activity_rollup", sql=lambda: f"SELECT * FROM {_checkin_sql()}")
def q_stream_activity(spark, sf):
    """Check-in features kept up to date by a stream over the orders files."""
    from featuremill.streaming.activity import read_activity_features, refresh_activity
    spec = checkin_spec()
    schema = spark.read.parquet(f"{sf}/orders.parquet").schema  # footer only
    source = f"{sf}/orders*.parquet"  # the stream source watches a directory or a glob
    base = scratch_path(spark, "checkin-stream")

    def prepare(s):
        return s.select(F.col("o_custkey").alias("business_id"),
                        F.col("o_orderdate").alias("date"))

    refresh_activity(spark, source, schema, spec, f"{base}/state", f"{base}/checkpoint", prepare)
    return read_activity_features(spark, f"{base}/state", spec)


@register("stream_review_rollup", sql=lambda: f"SELECT * FROM {rollup_sql()}")
def q_stream_rollup(spark, sf):
    """The review roll-up after three arrivals of reviews, each folded into the state."""
    from featuremill.streaming.rollup import RollupState, refresh_rollup
    review = role(spark, sf, "review").select("review_id", "business_id", "user_id", "stars", "useful", "funny", "cool")
    known, base = users(spark, sf), scratch_path(spark, "review-stream")
    state = RollupState(f"{base}/state")
    part = F.pmod(F.xxhash64("review_id"), F.lit(3))
    for arrival in range(3):
        review.where(part == arrival).write.parquet(f"{base}/arrivals/{arrival}")
        refresh_rollup(spark, f"{base}/arrivals/*", review.schema, known, state, f"{base}/checkpoint")
    return round_cols(state.read(spark), ROLLUP_AVGS)


@register("stream_labels", sql=lambda: f"""
SELECT b.business_id, b.city, l.delivery_or_takeout FROM {T('business')} b
JOIN (SELECT DISTINCT business_id, delivery_or_takeout FROM {T('label')}) l
  ON b.business_id = l.business_id""")
def q_stream_labels(spark, sf):
    """Labelled businesses after three arrivals of labels; the later ones repeat earlier labels."""
    from featuremill.streaming.labels import read_labelled, refresh_labels
    labels, base = role(spark, sf, "label").select("business_id", "delivery_or_takeout"), scratch_path(spark, "label-stream")
    b, part = role(spark, sf, "business").select("business_id", "city"), F.col("business_id") % 4
    for arrival, rows in enumerate((labels.where(part < 2), labels.where(part < 3), labels.where(part != 1))):
        rows.write.parquet(f"{base}/arrivals/{arrival}")
        refresh_labels(spark, f"{base}/arrivals/*", labels.schema, b, f"{base}/table", f"{base}/checkpoint")
    return read_labelled(spark, f"{base}/table")
