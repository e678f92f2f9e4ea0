"""Registered queries: sources, projections, filters, joins, aggregations, encoders."""

from __future__ import annotations

from pyspark.sql import functions as F

from featuremill.functions.columns import cast_safe, sanitize_name, sum_columns
from featuremill.functions.predicates import flag_set, not_true
from featuremill.operators import encode as E
from featuremill.operators import profile as P
from featuremill.operators.basetable import label_table
from featuremill.operators.profile_store import ProfileStore
from featuremill.operators.skew import hot_of_counts, salt_sides, salted_left_join, written
from featuremill.plans import standins as S
from featuremill.plans.catalog import T, register, role, round_cols
from featuremill.plans.entity import (ALCOHOL, ALL_DAY, ATTIRE, CONTAINS_FLAGS, DAYS, PRICE,
                                      TRUE_FLAGS, WIFI, candidate_rows, with_leisure_flag)
from featuremill.plans.q_features import (_flag, _groups_sql, _in, _q, candidates_sql,
                                          checkin_features, frequent_cities_sql, leisure_sql, q_flagship,
                                          flagship_sql, _checkin_sql)
from featuremill.session import scratch_path
from featuremill.sources.files import (load_table, read_csv, read_json, register_views,
                                       sanitize_columns, save_table)
from featuremill.sources.records import read_multiline_csv
from featuremill.sources.shred import infer_shape, read_variants, shred_lines

# -- sources ----------------------------------------------------------------------------

@register("scan_json_roundtrip", sql=lambda: "SELECT * FROM events")
def q_json(spark, sf):
    """Every events row written as newline JSON to the shared scratch folder and read back
    with a declared schema (no inference pass)."""
    ev = spark.read.parquet(f"{sf}/events.parquet")
    path = save_table(ev, scratch_path(spark, "events-json"), fmt="json")
    return read_json(spark, path, schema=ev.schema, sanitize=False)


@register("scan_csv_roundtrip", sql=lambda: "SELECT * FROM orders")
def q_csv(spark, sf):
    """Orders through CSV (header, multi-line) with a declared schema."""
    o = spark.read.parquet(f"{sf}/orders.parquet")
    path = save_table(o, scratch_path(spark, "orders-csv"), fmt="csv")
    return read_csv(spark, path, schema=o.schema)


@register("scan_csv_multiline", sql=lambda: "SELECT doc_id, text, lang, source, n_chars FROM documents")
def q_csv_multiline(spark, sf):
    """Documents, whose texts hold line feeds, commas and quotes, through CSV files that are read in
    parallel also inside a file (``sources.records``)."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    path = scratch_path(spark, "documents-csv")
    (docs.write.option("header", "true").option("escape", '"').option("ignoreLeadingWhiteSpace", "false")
     .option("ignoreTrailingWhiteSpace", "false").csv(path))
    return read_multiline_csv(spark, path, docs.schema)


#: Lines of the event log that fit no schema: ``value`` as text, and a line broken off.
_ODD_VALUE, _BROKEN = 50, 97


@register("scan_json_variant", sql=lambda: f"""
SELECT event_id, event_type, value, CAST(json_extract(props, '$.k') AS BIGINT) AS props_k,
  CASE WHEN event_id % 10 = 0 THEN 'late' END AS note, CAST(NULL AS VARCHAR) AS reason, CAST(NULL AS BIGINT) AS bad_chars
FROM events WHERE event_id % {_ODD_VALUE} <> 0 AND event_id % {_BROKEN} <> 0
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL,
  CASE WHEN event_id % {_BROKEN} = 0 THEN 'no JSON' ELSE 'value is not number' END,
  CASE WHEN event_id % {_BROKEN} = 0 THEN 12 + length(CAST(event_id AS VARCHAR)) END
FROM events WHERE event_id % {_ODD_VALUE} = 0 OR event_id % {_BROKEN} = 0""")
def q_json_variant(spark, sf):
    """The events as JSON lines of unknown shape, some of them odd: typed rows and the quarantine."""
    e = spark.read.parquet(f"{sf}/events.parquet")
    odd, broken = F.col("event_id") % _ODD_VALUE == 0, F.col("event_id") % _BROKEN == 0
    number = F.to_json(F.struct("event_id", "event_type", F.from_json("props", "k long").alias("props"), "value",
                                F.when(F.col("event_id") % 10 == 0, "late").alias("note")))
    line = (F.when(broken, F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string")))
            .when(odd, F.to_json(F.struct("event_id", F.lit("n/a").alias("value")))).otherwise(number))
    path = scratch_path(spark, "events-lines")
    e.select(line.alias("value")).write.text(path)
    variants = read_variants(spark, path)
    size = F.when(F.col("reason") == "no JSON", F.length("line").cast("long"))
    return shred_lines(variants, infer_shape(variants)).select(
        *[F.col(f"typed.{c}") for c in ("event_id", "event_type", "value", "props_k", "note")], "reason", size.alias("bad_chars"))


@register("basetable_roundtrip", sql=flagship_sql)
def q_basetable_roundtrip(spark, sf):
    """The base table saved as Parquet and loaded back (the notebook reads a saved base
    table that nothing writes; this is the missing writer)."""
    bt = q_flagship(spark, sf)
    path = save_table(bt, scratch_path(spark, "basetable"))
    back = load_table(spark, path)
    # Parquet-safe names were written; restore the original ones (``24h_Monday`` is legal)
    return back.toDF(*bt.columns)


def _per_business(review):
    """Each business's ratings, written once with its number of reviews, and the hot businesses
    that these numbers tell."""
    avg_b = written(review.groupBy("business_id").agg(
        F.avg("stars").alias("business_stars"), F.count("review_id").alias("business_reviews"),
        F.count(F.lit(1)).alias("_rows")), "per-business")
    hot = hot_of_counts(avg_b, "business_id")
    return avg_b.drop("_rows").withColumnRenamed("business_id", "rated_id"), hot


@register("sql_view_inner_join", sql=lambda: f"""
SELECT r.review_id, r.business_id, r.stars, a.business_stars, a.business_reviews
FROM {T('review')} r,
  (SELECT business_id AS rated_id, round(avg(stars), 9) AS business_stars,
          count(review_id) AS business_reviews FROM {T('review')} GROUP BY business_id) a
WHERE r.business_id = a.rated_id""")
def q_sql_view(spark, sf):
    """Temp views + a comma join with a WHERE equality (Catalyst makes it an equi-join)."""
    review = role(spark, sf, "review").select("review_id", "business_id", "stars")
    avg_b, hot = _per_business(review)
    # the views carry a salt (hot businesses spread over many tasks, see operators.skew)
    review, avg_b = salt_sides(review, avg_b, "business_id", ["review_id"],
                               right_key="rated_id", hot=hot)
    register_views({"fm_review": review, "fm_avg_business": avg_b})
    return spark.sql("""SELECT r.review_id, r.business_id, r.stars,
        round(a.business_stars, 9) AS business_stars, a.business_reviews
      FROM fm_review r, fm_avg_business a
      WHERE r.business_id = a.rated_id AND r._salt = a._salt_r""")


# -- projection -------------------------------------------------------------------------

@register("proj_sanitize_names", sql=lambda: f"SELECT * FROM {T('business')}")
def q_sanitize(spark, sf):
    return sanitize_columns(S.raw_business(spark, sf))


@register("proj_with_columns", sql=lambda: f"""
SELECT *, useful + funny + cool AS votes, stars * 2 AS stars_x2,
  CASE WHEN stars >= 25 THEN 1 ELSE 0 END AS high FROM {T('review')}""")
def q_with_columns(spark, sf):
    r = role(spark, sf, "review")
    return r.select("*", sum_columns(["useful", "funny", "cool"]).alias("votes")).withColumns({
        "stars_x2": F.col("stars") * 2,
        "high": F.when(F.col("stars") >= 25, 1).otherwise(0)})


@register("proj_drop", sql=lambda: f"""
SELECT * EXCLUDE (address, latitude, longitude, name, postal_code, state) FROM {T('business')}""")
def q_drop(spark, sf):
    cols = ("address", "latitude", "longitude", "name", "postal_code", "state")
    return role(spark, sf, "business").drop(*cols)


@register("proj_select_list", sql=lambda: f"""
SELECT business_id, city, is_open, categories FROM {T('business')}""")
def q_select(spark, sf):
    return role(spark, sf, "business").select(*["business_id", "city", "is_open", "categories"])


@register("proj_rename_join", sql=lambda: f"""
SELECT r.review_id, r.business_id, r.stars, a.business_stars, a.business_reviews
FROM {T('review')} r LEFT JOIN
  (SELECT business_id AS rated_id, round(avg(stars), 9) AS business_stars,
          count(review_id) AS business_reviews FROM {T('review')} GROUP BY business_id) a
  ON r.business_id = a.rated_id""")
def q_rename_join(spark, sf):
    review = role(spark, sf, "review").select("review_id", "business_id", "stars")
    avg_b, hot = _per_business(review)
    # a per-business figure joined back onto every review: a hot business is salted
    out = salted_left_join(review, avg_b, "business_id", ["review_id"],
                           right_key="rated_id", hot=hot)
    return round_cols(out.select("review_id", "business_id", "stars", "business_stars",
                                 "business_reviews"), ["business_stars"])


@register("proj_try_cast", sql=lambda: f"""
SELECT user_id AS tip_id, compliment_count, TRY_CAST(compliment_count AS INTEGER) AS compliments
FROM {T('tip')}""")
def q_try_cast(spark, sf):
    t = role(spark, sf, "tip")
    return t.select(F.col("user_id").alias("tip_id"), "compliment_count",
                    cast_safe("compliment_count", "int").alias("compliments"))


@register("proj_sum_columns", sql=lambda: f"""
SELECT user_id, {' + '.join(S.COMPLIMENTS)} AS received_compliments,
  useful + funny + cool AS given_votes FROM {T('user')}""")
def q_sum_columns(spark, sf):
    u = role(spark, sf, "user")
    return u.select("user_id", sum_columns(S.COMPLIMENTS).alias("received_compliments"),
                    sum_columns(["useful", "funny", "cool"]).alias("given_votes"))


# -- filters ----------------------------------------------------------------------------

def _not_true_sql(c):
    return f"(TRY_CAST({c} AS BOOLEAN) = false OR {c} IS NULL OR {c} = 'None')"


@register("filter_not_true_tokens", sql=lambda: f"""
SELECT business_id, attributes_RestaurantsDelivery, attributes_RestaurantsTakeOut
FROM {T('business')} WHERE {_not_true_sql('attributes_RestaurantsDelivery')}
  AND {_not_true_sql('attributes_RestaurantsTakeOut')}""")
def q_not_true(spark, sf):
    b = role(spark, sf, "business")
    return (b.where(not_true("attributes_RestaurantsDelivery")
                    & not_true("attributes_RestaurantsTakeOut"))
            .select("business_id", "attributes_RestaurantsDelivery",
                    "attributes_RestaurantsTakeOut"))


@register("filter_flag", sql=lambda: f"""
SELECT business_id, is_open FROM {T('business')} WHERE TRY_CAST(is_open AS INTEGER) = 1""")
def q_flag(spark, sf):
    return role(spark, sf, "business").where(flag_set("is_open")).select("business_id", "is_open")


@register("filter_sql_string", sql=lambda: f"""
SELECT user_id, review_count FROM {T('user')} WHERE review_count > 30""")
def q_sql_string(spark, sf):
    return role(spark, sf, "user").where("review_count > 30").select("user_id", "review_count")


@register("filter_having", sql=lambda: f"""
SELECT business_id, count(business_id) AS count FROM {T('checkin')}
GROUP BY business_id HAVING count(business_id) > 10""")
def q_having(spark, sf):
    c = role(spark, sf, "checkin")
    return (c.groupBy("business_id").agg(F.count("business_id").alias("count"))
            .where(F.col("count") > 10))


@register("filter_isin_list", sql=lambda: f"""
SELECT business_id, categories, {leisure_sql()} AS isLeisure FROM {T('business')}""")
def q_isin(spark, sf):
    b = role(spark, sf, "business")
    flagged = with_leisure_flag(b.select("business_id", "categories",
                                         F.col("categories").alias("_cats")), "_cats")
    return flagged.select("business_id", "categories", "isLeisure")


@register("filter_null_logic", sql=lambda: f"""
SELECT business_id, attributes_Alcohol, attributes_WiFi FROM {T('business')}
WHERE attributes_Alcohol IS NULL OR NOT attributes_WiFi IN ('None', 'u''no''')""")
def q_null_logic(spark, sf):
    b = role(spark, sf, "business")
    a, w = F.col("attributes_Alcohol"), F.col("attributes_WiFi")
    return b.where(a.isNull() | ~w.isin("None", "u'no'")).select(
        "business_id", "attributes_Alcohol", "attributes_WiFi")


# -- joins ------------------------------------------------------------------------------

def _labels(spark, sf):
    return label_table(role(spark, sf, "label"), "business_id", "delivery_or_takeout")


@register("join_inner_using", sql=lambda: f"""
SELECT b.business_id, b.city, l.delivery_or_takeout FROM {T('business')} b
JOIN (SELECT DISTINCT business_id, delivery_or_takeout FROM {T('label')}) l
  ON b.business_id = l.business_id""")
def q_inner(spark, sf):
    b = role(spark, sf, "business").select("business_id", "city")
    return b.join(_labels(spark, sf), ["business_id"], "inner")


@register("join_left_using", sql=lambda: f"""
SELECT b.business_id, b.city, c.checkin_count, c.avg_checkin_yr FROM {T('business')} b
LEFT JOIN {_checkin_sql()} c ON b.business_id = c.business_id""")
def q_left(spark, sf):
    b = role(spark, sf, "business").select("business_id", "city")
    c = checkin_features(spark, sf).select("business_id", "checkin_count", "avg_checkin_yr")
    return b.join(c, ["business_id"], "left")


@register("join_left_expr", sql=lambda: f"""
SELECT u.user_id, u.review_count, a.avg_useful FROM {T('user')} u
LEFT JOIN (SELECT user_id AS useful_user, round(avg(useful), 9) AS avg_useful
           FROM {T('review')} GROUP BY user_id) a ON u.user_id = a.useful_user""")
def q_left_expr(spark, sf):
    u = role(spark, sf, "user").select("user_id", "review_count")
    a = (role(spark, sf, "review").groupBy("user_id").agg(F.avg("useful").alias("avg_useful"))
         .withColumnRenamed("user_id", "useful_user"))
    out = u.join(a, u["user_id"] == a["useful_user"], "left").select("user_id", "review_count",
                                                                   "avg_useful")
    return round_cols(out, ["avg_useful"])


@register("join_left_composite", sql=lambda: f"""
SELECT r.review_id, r.business_id, r.user_id, a.pair_stars FROM {T('review')} r
LEFT JOIN (SELECT business_id AS pair_business, user_id AS pair_user,
                  round(avg(stars), 9) AS pair_stars
           FROM {T('review')} GROUP BY business_id, user_id) a
  ON r.business_id = a.pair_business AND r.user_id = a.pair_user""")
def q_left_composite(spark, sf):
    r = role(spark, sf, "review").select("review_id", "business_id", "user_id", "stars")
    a = (r.groupBy("business_id", "user_id").agg(F.avg("stars").alias("pair_stars"))
         .withColumnRenamed("business_id", "pair_business").withColumnRenamed("user_id", "pair_user"))
    # there are about as many pairs as reviews, so their counts are not written; a sketch finds hot pairs
    out = salted_left_join(r, a, ["business_id", "user_id"], ["review_id"],
                           right_key=["pair_business", "pair_user"])
    out = out.select("review_id", "business_id", "user_id", "pair_stars")
    return round_cols(out, ["pair_stars"])


# -- aggregations -----------------------------------------------------------------------

VC_COLS = ("attributes_Alcohol", "attributes_RestaurantsAttire",
           "attributes_RestaurantsPriceRange2", "attributes_WiFi", "city", "hours_Monday")
CATEGORY_POSITIONS = 5


@register("agg_value_counts", sql=lambda: " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({x} AS STRING) AS value, count(business_id) AS count "
    f"FROM {T('business')} GROUP BY ALL"
    for c, x in [*((c, c) for c in VC_COLS), *((f"cat{i}", f"trim(string_split(categories, ',')[{i}])")
                                               for i in range(1, CATEGORY_POSITIONS + 1))]))
def q_value_counts(spark, sf):
    """Frequency tables of plain columns and of the category positions, most frequent first."""
    b = role(spark, sf, "business")
    cats = E.split_columns("categories", ",", CATEGORY_POSITIONS, "cat")
    return P.value_counts(b.withColumns(cats), (*VC_COLS, *cats), count_of="business_id")


RANKED_COLS = (*VC_COLS, "hours_Saturday")
RANKS = 5


@register("agg_ranked_values", sql=lambda: "SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY column_name "
          "ORDER BY count DESC, value ASC NULLS FIRST) AS INTEGER) AS rank FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({c} AS STRING) AS value, count(business_id) AS count "
    f"FROM {T('business')} GROUP BY ALL" for c in RANKED_COLS) + f")) WHERE rank <= {RANKS}")
def q_ranked_values(spark, sf):
    """The most frequent values of each column with their rank."""
    return P.ranked_values(role(spark, sf, "business"), RANKED_COLS, RANKS, count_of="business_id")


def _business_flagged(spark, sf):
    return with_leisure_flag(role(spark, sf, "business"))


def _null_profile_sql():
    b = f"(SELECT * EXCLUDE (categories), {leisure_sql()} AS isLeisure FROM {T('business')})"
    # one text per column, in the stand-in's order after the leisure flag
    cols = [c for c in S.business_columns() if c != "categories"] + ["isLeisure"]
    parts = []
    for c in cols:
        if c in ("latitude", "longitude"):
            miss = f"{c} IS NULL OR isnan({c})"
        elif c in ("business_id", "is_open", "isLeisure"):
            miss = f"{c} IS NULL"
        else:
            miss = f"{c} IS NULL OR coalesce(isnan(TRY_CAST({c} AS DOUBLE)), false)"
        parts.append(f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {miss}) AS n_missing, "
                     f"count(*) AS n_rows, (count(*) FILTER (WHERE {miss}))::DOUBLE / "
                     f"nullif(count(*), 0) AS missing_share FROM {b}")
    return " UNION ALL ".join(parts)


@register("agg_null_profile", sql=_null_profile_sql)
def q_null_profile(spark, sf):
    return P.null_profile(_business_flagged(spark, sf))


@register("agg_null_profile_merged", sql=_null_profile_sql)
def q_null_profile_merged(spark, sf):
    """The null profile after two arrivals, merged from their profile rows."""
    b = _business_flagged(spark, sf)
    store = ProfileStore(scratch_path(spark, "null-profile"))
    store.add(b.where("business_id % 3 = 0"), 0)
    store.add(b.where("business_id % 3 <> 0"), 1)
    return store.profile(spark).select("column_name", "n_missing", "n_rows", "missing_share")


@register("agg_null_filter", sql=lambda: f"""
SELECT *, CASE WHEN coalesce(missing_share <= 0.75, n_rows = 0) THEN 1 ELSE 0 END AS kept
FROM ({_null_profile_sql()})""")
def q_null_filter(spark, sf):
    return P.null_filter_table(_business_flagged(spark, sf), 0.75)


@register("agg_sum", sql=lambda: f"""
SELECT business_id, CAST(sum(TRY_CAST(compliment_count AS INTEGER)) AS BIGINT) AS total_compliment_ct
FROM {T('tip')} GROUP BY business_id""")
def q_sum(spark, sf):
    t = role(spark, sf, "tip")
    return t.groupBy("business_id").agg(
        F.sum(cast_safe("compliment_count", "int")).alias("total_compliment_ct"))


@register("agg_avg", sql=lambda: f"""
SELECT business_id, round(avg(stars), 9) AS avg_stars, round(avg(useful), 9) AS avg_useful
FROM {T('review')} GROUP BY business_id""")
def q_avg(spark, sf):
    r = role(spark, sf, "review")
    out = r.groupBy("business_id").agg(F.avg("stars").alias("avg_stars"),
                                       F.avg("useful").alias("avg_useful"))
    return round_cols(out, ["avg_stars", "avg_useful"])


@register("agg_avg_composite", sql=lambda: f"""
SELECT business_id, user_id, round(avg(stars), 9) AS pair_stars
FROM {T('review')} GROUP BY business_id, user_id""")
def q_avg_composite(spark, sf):
    r = role(spark, sf, "review")
    out = r.groupBy("business_id", "user_id").agg(F.avg("stars").alias("pair_stars"))
    return round_cols(out, ["pair_stars"])


@register("agg_repeated_pairs", sql=lambda: f"""
SELECT business_id, user_id, count(*) AS count FROM {T('review')}
GROUP BY business_id, user_id HAVING count(*) > 2""")
def q_repeated(spark, sf):
    return P.repeated_pairs(role(spark, sf, "review"), ["business_id", "user_id"], 2)


@register("agg_row_count", sql=lambda: " UNION ALL ".join(
    f"SELECT '{r}' AS table_name, count(*) AS n_rows FROM {T(r)}"
    for r in ("business", "label", "checkin", "tip", "review", "user")))
def q_row_count(spark, sf):
    out = None
    for r in ("business", "label", "checkin", "tip", "review", "user"):
        one = role(spark, sf, r).agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(r).alias("table_name"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


@register("agg_distinct", sql=lambda: f"""
SELECT count(*) AS n_rows, count(DISTINCT business_id) AS n_distinct FROM {T('label')}""")
def q_distinct(spark, sf):
    return P.count_distinct(role(spark, sf, "label"), "business_id")


@register("agg_distinct_values", sql=lambda: f"""
SELECT DISTINCT attributes_WiFi, city FROM {T('business')}""")
def q_distinct_values(spark, sf):
    return P.distinct_values(role(spark, sf, "business"), ["attributes_WiFi", "city"])


@register("agg_drop_duplicates", sql=lambda: f"""
SELECT DISTINCT business_id, delivery_or_takeout FROM {T('label')}""")
def q_dedup(spark, sf):
    return _labels(spark, sf)


@register("agg_frequent_values", sql=lambda: f"""
SELECT city, count(business_id) AS count FROM {candidates_sql()} WHERE city IS NOT NULL
GROUP BY city HAVING count(business_id) > 45""")
def q_frequent(spark, sf):
    rows = candidate_rows(_business_flagged(spark, sf))
    return E.frequent_values(rows, "city", 45, count_of="business_id")


@register("sort_top_k", sql=lambda: f"""
SELECT city, count(*) AS count FROM {T('business')} GROUP BY city
ORDER BY count DESC, city ASC LIMIT 10""")
def q_top_k(spark, sf):
    counts = role(spark, sf, "business").groupBy("city").agg(F.count(F.lit(1)).alias("count"))
    return P.top_k(counts, "count", 10, tie="city")


# -- encoders ---------------------------------------------------------------------------

@register("encode_split_columns", sql=lambda: f"""
SELECT business_id, {', '.join(f"trim(string_split(categories, ',')[{i}]) AS cat{i}"
                               for i in range(1, 6))},
  {', '.join(f"string_split(categories, ',')[{i}] AS raw{i}" for i in range(1, 6))}
FROM {T('business')}""")
def q_split(spark, sf):
    b = role(spark, sf, "business").select("business_id", "categories")
    out = E.split_to_columns(b, "categories", ",", 5, "cat", trim=True, drop=False)
    return E.split_to_columns(out, "categories", ",", 5, "raw", trim=False)


@register("encode_one_hot_tokens", sql=lambda: f"""
SELECT business_id, {', '.join(_groups_sql('attributes_Alcohol', ALCOHOL)
                               + _groups_sql('attributes_RestaurantsAttire', ATTIRE)
                               + _groups_sql('attributes_RestaurantsPriceRange2', PRICE)
                               + _groups_sql('attributes_WiFi', WIFI))}
FROM {T('business')}""")
def q_one_hot(spark, sf):
    b = role(spark, sf, "business")
    out = b.select("business_id", "attributes_Alcohol", "attributes_RestaurantsAttire",
                   "attributes_RestaurantsPriceRange2", "attributes_WiFi")
    for c, groups in (("attributes_Alcohol", ALCOHOL), ("attributes_RestaurantsAttire", ATTIRE),
                      ("attributes_RestaurantsPriceRange2", PRICE), ("attributes_WiFi", WIFI)):
        out = E.one_hot_tokens(out, c, groups)
    return out


_PLAIN_FLAGS = {c: o for c, (o, n) in TRUE_FLAGS.items() if n is None}
_NULL_FLAGS = {c: (o, n) for c, (o, n) in TRUE_FLAGS.items() if n is not None}


@register("encode_true_flag", sql=lambda: f"""
SELECT business_id, {', '.join(f"{_flag(f'{c} = {_q('True')}')} AS {o}"
                               for c, o in _PLAIN_FLAGS.items())}
FROM {T('business')}""")
def q_true_flag(spark, sf):
    out = role(spark, sf, "business").select("business_id", *_PLAIN_FLAGS)
    for c, o in _PLAIN_FLAGS.items():
        out = E.true_flag(out, c, o)
    return out


@register("encode_null_indicator", sql=lambda: f"""
SELECT business_id, {', '.join(f"{_flag(f'{c} IS NULL')} AS {n}, "
                               f"{_flag(f'{c} = {_q('True')}')} AS {o}"
                               for c, (o, n) in _NULL_FLAGS.items())}
FROM {T('business')}""")
def q_null_indicator(spark, sf):
    out = role(spark, sf, "business").select("business_id", *_NULL_FLAGS)
    for c, (o, n) in _NULL_FLAGS.items():
        out = E.true_flag(out, c, o, null_out=n)
    return out


@register("encode_contains_flag", sql=lambda: f"""
SELECT business_id, {', '.join(f"{_flag(f'contains({c}, {_q('True')})')} AS {o}"
                               for c, o in CONTAINS_FLAGS.items())}
FROM {T('business')}""")
def q_contains(spark, sf):
    out = role(spark, sf, "business").select("business_id", *CONTAINS_FLAGS)
    for c, o in CONTAINS_FLAGS.items():
        out = E.contains_flag(out, c, o)
    return out


@register("encode_frequent_one_hot", sql=lambda: f"""
SELECT e.business_id,
  {_flag(f'e.city IS NULL OR e.city NOT IN {_in(S.CITIES)}')} AS city_others, {', '.join(
    f"{_flag(f'e.city = {_q(v)}')} AS city_{sanitize_name(v)}" for v in S.CITIES)}
FROM {candidates_sql()} e""")
def q_frequent_one_hot(spark, sf):
    rows = candidate_rows(_business_flagged(spark, sf)).select("business_id", "city")
    return E.frequent_one_hot_spec("city", S.CITIES, "city_", "city_others").apply(rows)


@register("encode_sentinel_class", sql=lambda: f"""
SELECT business_id, {', '.join(
    f"{_flag(f'hours_{d} IS NULL')} AS miss_sched_{d}, "
    f"{_flag(f'hours_{d} = {_q(ALL_DAY)}')} AS \"24h_{d}\", "
    f"{_flag(f'hours_{d} IS NOT NULL AND hours_{d} <> {_q(ALL_DAY)}')} AS other_sched_{d}"
    for d in DAYS)}
FROM {T('business')}""")
def q_sentinel(spark, sf):
    b = role(spark, sf, "business").select("business_id", *[f"hours_{d}" for d in DAYS])
    return E.sentinel_class(b, {f"hours_{d}": d for d in DAYS}, ALL_DAY)


@register("encode_any_present", sql=lambda: f"""
SELECT business_id, hours_Saturday, hours_Sunday,
  {_flag('hours_Saturday IS NOT NULL OR hours_Sunday IS NOT NULL')} AS open_weekends
FROM {T('business')}""")
def q_any_present(spark, sf):
    b = role(spark, sf, "business").select("business_id", "hours_Saturday", "hours_Sunday")
    return E.any_present(b, ["hours_Saturday", "hours_Sunday"], "open_weekends")


@register("encode_target", sql=lambda: f"""
SELECT business_id, delivery_or_takeout,
  CASE WHEN delivery_or_takeout = 'TRUE' THEN 1 ELSE 0 END AS target
FROM (SELECT DISTINCT business_id, delivery_or_takeout FROM {T('label')})""")
def q_target(spark, sf):
    return E.label_target(_labels(spark, sf), "delivery_or_takeout", "target", drop=False)


@register("encode_fillna_by_type", sql=lambda: f"""
SELECT b.business_id, coalesce(b.attributes_Alcohol, '0') AS attributes_Alcohol,
  coalesce(b.hours_Monday, '0') AS hours_Monday, coalesce(c.checkin_count, 0) AS checkin_count,
  coalesce(c.avg_checkin_yr, 0.0) AS avg_checkin_yr, c.last_day AS last_day
FROM {T('business')} b LEFT JOIN (SELECT *, DATE '2000-01-01' AS last_day FROM {_checkin_sql()}) c
  ON b.business_id = c.business_id""")
def q_fillna(spark, sf):
    """Numbers get 0, text gets "0", a date column keeps its nulls."""
    b = role(spark, sf, "business").select("business_id", "attributes_Alcohol", "hours_Monday")
    c = checkin_features(spark, sf).select("business_id", "checkin_count", "avg_checkin_yr",
                                           F.lit("2000-01-01").cast("date").alias("last_day"))
    return E.fill_defaults(b.join(c, "business_id", "left"))


@register("encode_frequent_category", sql=lambda: f"""
SELECT business_id, CASE WHEN city IN {frequent_cities_sql()} THEN city ELSE 'others' END
  AS city_group FROM {candidates_sql()}""")
def q_frequent_category(spark, sf):
    """The frequent-city encoding for large data: value table written to the shared
    folder, joined back, one category column."""
    rows = candidate_rows(_business_flagged(spark, sf)).select("business_id", "city")
    spec = E.fit_frequent_category(rows, "city", 45, scratch_path(spark, "frequent-city"),
                                   count_of="business_id")
    return spec.apply(rows)
