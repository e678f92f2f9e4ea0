"""Benchmark: headline queries on $BENCH_SF_DIR (default /root/testdata/sf0.1) with
local[$BENCH_CPUS]. Each query is fully computed into Spark's ``noop`` sink (no rows go
to the driver), once, after a warm-up pass on the sf0.001 tables (set BENCH_WARMUP=0 to
time cold). Prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "basetable_flagship",
    "features_entity",
    "agg_review_rollup",
    "features_activity_null_rate",
    "features_activity_count_rate",
    "features_user",
    "agg_null_profile",
    "agg_value_counts",
    "encode_frequent_one_hot",
    "eval_auc",
    "eval_roc_points",
    "ml_hash_split",
    "ml_lr_predictions",
    "ml_rf_predictions",
    "ml_gbt_predictions",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k]
    from featuremill.plans.catalog import all_queries
    from featuremill.session import get_session, scratch_dir
    spark = get_session(f"local[{cpus}]", app="featuremill-bench",
                        shuffle_partitions=int(cpus) * 2, driver_memory="16g")
    scratch_dir(spark)
    qs = all_queries()
    # Warm-up: one pass of every headline query on the smallest scale next to the bench data
    # (JIT and generated-code caches), so the timed runs measure steady-state work.
    warm = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.environ.get("BENCH_WARMUP", "1") == "1" and os.path.isdir(warm) and warm != sf_dir:
        for key in only or HEADLINE:
            qs[key].build(spark, warm).write.format("noop").mode("overwrite").save()
    times = {}
    for key in only or HEADLINE:
        t0 = time.perf_counter()
        qs[key].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[key] = round(time.perf_counter() - t0, 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
