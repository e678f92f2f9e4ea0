"""Labels as a stream: repeated ones are dropped by state, each new one meets its entity at once.

Labels of an entity arrive again and again, and some long after they were given. The stream
drops a (key, label) pair that it has seen within ``keep`` of arrival time: the watermark is on
the time of arrival, not on the label's own date, so a label that is late is taken up like any
other and the state forgets a pair only after it has not been seen for that long. A pair that
comes back after that is joined once more; the table's readers drop it (``read_labelled``), so
the result does not depend on ``keep``, which only bounds the state. Each batch joins the entity
table as it is now, and writes a folder named by its batch id as a whole, so a batch that is
replayed replaces its own rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Time of arrival, which the state's watermark follows.
ARRIVED = "_arrived"


def new_labels(stream: DataFrame, key: str, label_col: str, keep: str) -> DataFrame:
    """The (key, label) pairs of a streaming table that the state has not seen within ``keep``."""
    arrived = stream.select(key, label_col, F.current_timestamp().alias(ARRIVED))
    return arrived.withWatermark(ARRIVED, keep).dropDuplicatesWithinWatermark([key, label_col]).drop(ARRIVED)


def refresh_labels(spark: SparkSession, source: str, schema, entity: DataFrame, table: str, checkpoint: str,
                   key: str = "business_id", label_col: str = "delivery_or_takeout", keep: str = "7 days",
                   prepare=None, fmt: str = "parquet") -> None:
    """Joins the labels that arrived under ``source`` since the last run with ``entity`` and adds
    the rows to ``table`` (``availableNow``). ``prepare`` makes the label columns of the raw stream."""
    stream = spark.readStream.schema(schema).format(fmt).load(source)
    if prepare is not None:
        stream = prepare(stream)

    def put(batch: DataFrame, batch_id: int) -> None:
        # stream-static: the entity table of this batch; its columns come first
        (entity.join(batch, [key], "inner").write.mode("overwrite").parquet(f"{table}/batch={batch_id}"))

    q = (new_labels(stream, key, label_col, keep).writeStream.outputMode("append")
         .option("checkpointLocation", checkpoint).foreachBatch(put).trigger(availableNow=True).start())
    q.awaitTermination()


def read_labelled(spark: SparkSession, table: str, key: str = "business_id",
                  label_col: str = "delivery_or_takeout") -> DataFrame:
    """One row per (key, label), with the entity as its newest batch had it."""
    rows = spark.read.parquet(table)
    rest = [c for c in rows.columns if c not in (key, label_col, "batch")]
    newest = rows.groupBy(key, label_col).agg(*[F.max_by(c, "batch").alias(c) for c in rest])
    return newest.select(key, *rest, label_col)
