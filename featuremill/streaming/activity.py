"""Incremental activity roll-up with Structured Streaming.

The activity aggregates (first day, last day, count, sums) are algebraic, so new check-ins
or tips can be folded into running per-key state instead of re-reading all history. The
stream keeps that state in the state store (checkpointed under the shared scratch folder,
so a lost executor or a restarted driver resumes where it stopped). Each micro-batch
emits only the keys it changed (``update`` mode); ``foreachBatch`` appends them, tagged
with the batch id, to a Parquet table. Readers take the newest row per key -- a replayed
batch writes identical rows, so the table stays correct under retries -- and derive
recency, span and rate exactly as the batch operator does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremill.functions.dates import rate_per_year, recency_months, span_years
from featuremill.operators.activity import ActivitySpec, activity_span


def activity_state(events: DataFrame, spec: ActivitySpec) -> DataFrame:
    """Running ``_first, _last, count, sums`` per key (works on a streaming DataFrame)."""
    return activity_span(events, spec.key, spec.ts, spec.count_of, spec.names.count, spec.sums)


def refresh_activity(spark: SparkSession, source: str, schema, spec: ActivitySpec,
                     state_table: str, checkpoint: str, prepare=None,
                     fmt: str = "parquet") -> None:
    """Fold every file that arrived under ``source`` since the last run into the state
    and append the changed keys to ``state_table`` (``availableNow``: process what is
    there, then stop)."""
    stream = spark.readStream.schema(schema).format(fmt).load(source)
    if prepare is not None:
        stream = prepare(stream)

    def append(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("_batch", F.lit(batch_id)).write.mode("append").parquet(state_table)

    q = (activity_state(stream, spec).writeStream.outputMode("update")
         .option("checkpointLocation", checkpoint).foreachBatch(append)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def _latest(rows: DataFrame, spec: ActivitySpec) -> DataFrame:
    """Newest state row per key (keeps ``_batch``)."""
    n = spec.names
    values = ["_first", "_last", n.count, *spec.sums.keys()]
    # one max_by per fixed-width column keeps this a hash aggregate (a struct would sort)
    return rows.groupBy(spec.key).agg(*[F.max_by(c, "_batch").alias(c) for c in values],
                                      F.max("_batch").alias("_batch"))


def compact_activity_state(spark: SparkSession, state_table: str, out: str,
                           spec: ActivitySpec, compacted: str | None = None) -> str:
    """Writes the newest row per key of ``state_table`` (and of an earlier compaction) to
    ``out`` (a fresh path in the shared folder) and returns it."""
    _latest(_state_rows(spark, state_table, compacted), spec).write.parquet(out)
    return out


def _state_rows(spark: SparkSession, state_table: str, compacted: str | None) -> DataFrame:
    rows = spark.read.parquet(state_table)
    if not compacted:
        return rows
    base = spark.read.parquet(compacted)
    upto = base.agg(F.max("_batch")).first()[0]  # one number
    newer = rows if upto is None else rows.where(F.col("_batch") > F.lit(upto))
    return base.unionByName(newer.select(*base.columns))


def read_activity_features(spark: SparkSession, state_table: str, spec: ActivitySpec,
                           compacted: str | None = None) -> DataFrame:
    """Newest state per key (from ``compacted`` plus the later batches, if given), then the
    same derived features as ``activity_features``."""
    n = spec.names
    latest = _latest(_state_rows(spark, state_table, compacted), spec)
    span = span_years("_last", "_first")
    return latest.select(
        spec.key, n.count, *spec.sums.keys(),
        recency_months("_last", spec.asof).alias(n.recency),
        span.alias(n.span),
        rate_per_year(F.col(n.count), span, spec.zero).alias(n.rate))
