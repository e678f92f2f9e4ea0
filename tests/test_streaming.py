"""Incremental roll-up: two arrivals folded by the stream = the batch operator on all."""

from featuremill.operators.activity import activity_features, tip_spec
from featuremill.session import scratch_path
from featuremill.streaming.activity import (compact_activity_state, read_activity_features,
                                            refresh_activity)


def test_incremental_equals_batch(spark):
    schema = "business_id int, date string, user_id int, compliment_count string"
    first = [(1, "2019-01-01 10:00:00", 5, "1"), (2, "2019-06-30 00:00:00", 6, "x"),
             (1, "2019-03-01 00:00:00", 7, "2")]
    second = [(1, "2020-01-31 08:00:00", 8, "3"), (3, "2018-02-28 00:00:00", None, None),
              (2, "2019-06-30 12:00:00", 9, "4")]
    base = scratch_path(spark, "stream-test")
    src, state, ckpt = f"{base}/src", f"{base}/state", f"{base}/ckpt"
    spec = tip_spec()
    spark.createDataFrame(first, schema).write.json(f"{src}/part1")
    refresh_activity(spark, f"{src}/*", schema, spec, state, ckpt, fmt="json")
    mid = {r[0]: r for r in read_activity_features(spark, state, spec).collect()}
    assert mid[1]["users_tip_ct"] == 2 and 3 not in mid
    compacted = compact_activity_state(spark, state, f"{base}/compact1", spec)
    spark.createDataFrame(second, schema).write.json(f"{src}/part2")
    refresh_activity(spark, f"{src}/*", schema, spec, state, ckpt, fmt="json")
    got = sorted(tuple(r) for r in read_activity_features(spark, state, spec).collect())
    want = sorted(tuple(r) for r in activity_features(
        spark.createDataFrame(first + second, schema), spec).collect())
    assert got == want
    # compacted history + later batches, and a second compaction, read the same
    via = read_activity_features(spark, state, spec, compacted=compacted).collect()
    assert sorted(tuple(r) for r in via) == want
    again = compact_activity_state(spark, state, f"{base}/compact2", spec, compacted)
    assert spark.read.parquet(again).count() == len(want)
    via2 = read_activity_features(spark, state, spec, compacted=again).collect()
    assert sorted(tuple(r) for r in via2) == want
