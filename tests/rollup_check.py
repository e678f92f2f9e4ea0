"""The review roll-up computed independently: window averages in DuckDB on the same rows."""

from featuremill.operators.rollup import ROLLUP_COLUMNS

SQL = """
WITH v AS (
  SELECT r.*, u.average_stars, u.fans, u.review_count, u.received_compliments, u.given_votes, u.loyalty,
    u.elite_years, u.friend_count,
    CASE WHEN r.user_id IS NOT NULL THEN avg(stars) OVER (PARTITION BY business_id, r.user_id) END AS pair_stars,
    CASE WHEN u.user_id IS NOT NULL THEN avg(useful) OVER (PARTITION BY r.user_id) END AS user_useful
  FROM review r LEFT JOIN users u ON r.user_id = u.user_id)
SELECT business_id, sum(cool), sum(funny), sum(useful), avg(stars), CAST(count(review_id) AS DOUBLE),
  avg(pair_stars), avg(average_stars), avg(fans), avg(review_count), avg(received_compliments),
  avg(given_votes), avg(loyalty), avg(elite_years), avg(friend_count), avg(user_useful)
FROM v GROUP BY business_id"""


def expected_rollup(review, users) -> dict:
    """business_id -> the values of ROLLUP_COLUMNS."""
    import duckdb
    con = duckdb.connect()
    con.register("review", review.toArrow())
    con.register("users", users.toArrow())
    out = {r[0]: r[1:] for r in con.execute(SQL).fetchall()}
    assert all(len(v) == len(ROLLUP_COLUMNS) for v in out.values())
    return out
