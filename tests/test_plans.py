"""Plan shape: one full review scan for the roll-up, no Python evaluation, no cross join,
no unpartitioned window over the score table, pushed-down filters and pruned columns."""

import json
import os
import subprocess
import sys
from collections import Counter

from featuremill.operators.evaluate import exact_auc
from featuremill.operators.rollup import review_rollup, user_features
from featuremill.plans import standins as S
from featuremill.plans.catalog import all_queries

from conftest import ROOT, SF01


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _review_scans(plan_text):
    """ReadSchema of every lineitem (review) scan in a plan string."""
    return [line.split("ReadSchema: ")[1] for line in plan_text.splitlines()
            if "lineitem.parquet" in line and "ReadSchema: " in line]


def test_rollup_joins_pairs_with_users_on_salt(spark):
    """One full review scan (the pair aggregate) is left in the plan: the per-user averages were
    written, with the counts that tell the hot users. Pairs meet users on (user, salt)."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        review = S.role(spark, SF01, "review")
        users = user_features(S.role(spark, SF01, "user"), S.COMPLIMENTS)
        fast = plan(review_rollup(review, users))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(_review_scans(fast)) == 1
    assert "SortMergeJoin [user_id" in fast and "_salt" in fast


READS = """
import sys
from pyspark.sql import SparkSession
from featuremill.plans.catalog import all_queries
from featuremill.session import get_session, scratch_dir
spark = get_session("local[2]", shuffle_partitions=4, driver_memory="2g", extra={
    "spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://" + sys.argv[1], "spark.eventLog.compress": "false",
    "spark.eventLog.rolling.enabled": "false"})
scratch_dir(spark)
for key in sys.argv[3:]:
    spark.sparkContext.setJobDescription(key)
    all_queries()[key].build(spark, sys.argv[2]).write.format("noop").mode("overwrite").save()
spark.stop()
"""


def records_read(folder, keys, sf=SF01) -> dict:
    """Records that the tasks of each query read from files, build jobs included, by the event log."""
    env = {**os.environ, "PYTHONPATH": ROOT}
    subprocess.run([sys.executable, "-c", READS, str(folder), sf, *keys], check=True, env=env, timeout=300,
                   capture_output=True)
    of_stage, read = {}, Counter()
    (log,) = folder.iterdir()
    for line in log.open():
        e = json.loads(line)
        if e["Event"] == "SparkListenerJobStart":
            for stage in e["Stage IDs"]:
                of_stage[stage] = e["Properties"].get("spark.job.description")
        elif e["Event"] == "SparkListenerTaskEnd":
            read[of_stage.get(e["Stage ID"])] += e["Task Metrics"]["Input Metrics"]["Records Read"]
    return read


def test_fact_table_is_read_twice(spark, tmp_path):
    """Two reads of the reviews (75,000 records each, lineitem and orders) and the small aggregate; the
    pair-level join has a third, narrow one for its sketch."""
    one = sum(spark.read.parquet(f"{SF01}/{t}.parquet").count() for t in ("lineitem", "orders"))
    read = records_read(tmp_path, ["agg_review_rollup", "sql_view_inner_join", "proj_rename_join", "join_left_composite"])
    for key in ("agg_review_rollup", "sql_view_inner_join", "proj_rename_join"):
        assert 2 * one <= read[key] < 2.2 * one, (key, read)
    assert read["join_left_composite"] <= 3.1 * one, read


def test_transform_starts_no_job(spark):
    from featuremill.plans.entity import fit_entity_features
    business = S.role(spark, SF01, "business")
    model = fit_entity_features(business)
    sc = spark.sparkContext
    sc.setJobGroup("lazy-transform", "")
    try:
        out = model.transform(business)
        assert list(sc.statusTracker().getJobIdsForGroup("lazy-transform")) == []
        assert out.limit(1).count() == 1
        assert len(sc.statusTracker().getJobIdsForGroup("lazy-transform")) > 0
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_no_python_or_cross_join_in_sql_checked_plans(spark):
    for key, q in all_queries().items():
        if q.sql is None or key.endswith("roundtrip"):
            continue
        p = plan(q.build(spark, SF01))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, key
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, key


def test_streaming_state_read_is_a_hash_aggregate(spark):
    from featuremill.operators.activity import checkin_spec
    from featuremill.streaming.activity import _latest
    spec = checkin_spec()
    rows = spark.range(10).selectExpr(f"id AS {spec.key}", "DATE'2020-01-01' AS _first",
                                      "DATE'2020-01-01' AS _last", f"id AS {spec.names.count}",
                                      "id AS _batch")
    assert "SortAggregate" not in plan(_latest(rows, spec))


def test_auc_running_sums_partitioned_by_bucket(spark):
    df = spark.range(1000).selectExpr("cast(id % 2 as int) as label", "rand(1) as score")
    p = exact_auc(df, buckets=4)._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(_bucket" in p


def test_pushdown_and_pruning(spark):
    q = all_queries()["filter_sql_string"].build(spark, SF01)
    p = plan(q)
    assert "ReadSchema: struct<s_suppkey:bigint,s_acctbal:double>" in p
    t = all_queries()["agg_min_max_count"].build(spark, SF01)
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan(t)
