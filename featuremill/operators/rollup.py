"""User features and the business-level review roll-up.

``review_rollup`` is the two-level aggregate of the original per-review joins: reviews
are reduced to (business, user) pairs -- partial aggregation on the map side, so a hot
pair or a hot user costs one row per partition -- and every business measure is then a
ratio of pair-level sums. No join at review grain: the only join is pairs x users on the
user key. A user who reviewed a large share of all businesses has that many pairs, so the
join is salted (``operators.skew``): such a user's pairs are spread over many tasks by a
hash of the business, and pairs without a user (which match nothing) are spread too.

The per-user useful average is a second, narrow aggregate read straight from the reviews
(two columns, partial aggregation, one shuffle by user). It is written once, with each user's
number of reviews: these tell the hot users, so the reviews are read twice in all. Sharing
the pair aggregate instead would need it materialised -- about one pair per review, so as
large as the reviews themselves -- or a window per user, which puts a hot user in a single
task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremill.functions.columns import list_size, sum_columns
from featuremill.functions.dates import tenure_months
from featuremill.operators.skew import hot_of_counts, salted_left_join, written

# Fixed value: the as-of time of user tenure.
USER_ASOF = "2020-07-01 00:00:00"

# Output names of the review roll-up, in their original order; each maps to
# the user-level or pair-level measure it averages.
ROLLUP_SUMS = {"cool_reviews": "cool", "funny_reviews": "funny", "useful_reviews": "useful"}
ROLLUP_USER_MEASURES = {
    "average_stars_user": "average_stars",
    "avg_users_fans": "fans",
    "avg_reviews_per_user": "review_count",
    "avg_users_compliments": "received_compliments",
    "avg_users_given_votes": "given_votes",
    "avg_users_loyalty": "loyalty",
    "avg_user_elite_yrs": "elite_years",
    "avg_users_friends": "friend_count",
    "avg_useful_per_user": "avg_useful",
}
ROLLUP_COLUMNS = ("cool_reviews", "funny_reviews", "useful_reviews", "avg_overall_rating",
                  "avg_rating_count", "avg_rating_per_user", "average_stars_user",
                  "avg_users_fans", "avg_reviews_per_user", "avg_users_compliments",
                  "avg_users_given_votes", "avg_users_loyalty", "avg_user_elite_yrs",
                  "avg_users_friends", "avg_useful_per_user")


def user_features(user: DataFrame, compliment_cols, vote_cols=("useful", "funny", "cool"),
                  since: str = "since", elite: str = "elite", friends: str = "friends",
                  asof: str = USER_ASOF, min_reviews: int | None = 30,
                  review_count: str = "review_count", list_mode: str = "reference",
                  drop=("name",)) -> DataFrame:
    """Per user: received compliments, given votes, tenure (months), elite years and
    friend count; keeps users with more than ``min_reviews`` reviews."""
    compliment_cols, vote_cols = list(compliment_cols), list(vote_cols)
    out = user.withColumns({
        "received_compliments": sum_columns(compliment_cols),
        "given_votes": sum_columns(vote_cols),
        "loyalty": tenure_months(since, asof, user.schema[since].dataType),
        "elite_years": list_size(elite, ",", list_mode),
        "friend_count": list_size(friends, ",", list_mode),
    }).drop(*compliment_cols, *vote_cols, elite, friends, *drop)
    if min_reviews is not None:
        out = out.where(F.col(review_count) > min_reviews)
    return out


def _wavg(x, weight):
    """Average of a per-pair value over the review rows it stands for."""
    return F.try_divide(F.sum(x * weight), F.sum(F.when(x.isNotNull(), weight)))


#: The sums of a (business, user) pair; they add up over any parts of the reviews.
PAIR_SUMS = ("_n", "_n_id", "_stars_sum", "_stars_n", "_useful_sum", "_useful_n", "_funny_sum", "_cool_sum")


def pair_sums(review: DataFrame, business: str = "business_id", user: str = "user_id",
              review_id: str = "review_id", stars: str = "stars", useful: str = "useful", funny: str = "funny",
              cool: str = "cool") -> DataFrame:
    """Reviews reduced to one row per (business, user)."""
    return review.groupBy(business, user).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count(review_id).alias("_n_id"),
        F.sum(stars).alias("_stars_sum"),
        F.count(stars).alias("_stars_n"),
        F.sum(useful).alias("_useful_sum"),
        F.count(useful).alias("_useful_n"),
        F.sum(funny).alias("_funny_sum"),
        F.sum(cool).alias("_cool_sum"),
    )


def review_rollup(review: DataFrame, users: DataFrame, business: str = "business_id",
                  user: str = "user_id", review_id: str = "review_id", stars: str = "stars",
                  useful: str = "useful", funny: str = "funny", cool: str = "cool",
                  spread: int | None = None, max_hot: int = 1000) -> DataFrame:
    """15 measures per business from reviews and (filtered) user features.

    users: one row per user with the measures named in ``ROLLUP_USER_MEASURES`` (as
    produced by ``user_features``). Reviews whose user is absent or filtered out still
    count for the review sums and ratings, and leave the user averages (avg skips nulls).
    Users holding more than ``1 / max_hot`` of the reviews are cut into parts of about one
    task each (``spread`` tasks in all; default: the shuffle partitions).
    """
    pair = pair_sums(review, business, user, review_id, stars, useful, funny, cool)
    per_user = written(review.groupBy(user).agg(F.avg(useful).alias("avg_useful"),
                                                F.count(F.lit(1)).alias("_rows")), "per-user")
    measures = [m for m in ROLLUP_USER_MEASURES.values() if m != "avg_useful"]
    u = users.select(user, *measures).join(per_user.drop("_rows"), user, "left")
    hot = hot_of_counts(per_user, user, max_hot=max_hot, tasks=spread)
    return rollup_of_pairs(pair, u, business, user, spread, hot)


def rollup_of_pairs(pair: DataFrame, users: DataFrame, business: str = "business_id", user: str = "user_id",
                    spread: int | None = None, hot: DataFrame | None = None) -> DataFrame:
    """The 15 measures per business from ``pair_sums`` and one row per user with all of
    ``ROLLUP_USER_MEASURES``. ``hot``: the users to spread (default: a sketch finds them)."""
    rows = salted_left_join(pair, users, user, salt_from=[business], spread=spread, hot=hot)

    n = F.col("_n")
    # the pair's own average rating, for pairs with a user (null users never match)
    pair_avg = F.when(F.col(user).isNotNull(),
                      F.try_divide(F.col("_stars_sum"), F.col("_stars_n")))
    aggs = [F.sum(f"_{src}_sum").alias(out) for out, src in ROLLUP_SUMS.items()]
    aggs += [
        F.try_divide(F.sum("_stars_sum"), F.sum("_stars_n")).alias("avg_overall_rating"),
        F.sum("_n_id").cast("double").alias("avg_rating_count"),
        _wavg(pair_avg, n).alias("avg_rating_per_user"),
    ]
    aggs += [_wavg(F.col(src).cast("double"), n).alias(out)
             for out, src in ROLLUP_USER_MEASURES.items()]
    return rows.groupBy(business).agg(*aggs).select(business, *ROLLUP_COLUMNS)

