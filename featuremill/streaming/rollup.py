"""The review roll-up kept up to date as reviews arrive.

Two states grow by one small table per arrival: sums per (business, user) pair, and useful sums
per user. They add up, so an arrival appends its own sums and rewrites nothing. An arrival
changes the rows of the businesses it reviews and, because every business averages the useful
average of its users, those of all other businesses that its users have ever reviewed. Exactly
these are worked out anew from the pair state and appended with the arrival's number; readers
take the newest row of each business. Every table of an arrival is a folder named by the
batch id and written as a whole, so a batch that is replayed after a failure replaces its own
tables and nothing is counted twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremill.operators.rollup import (PAIR_SUMS, ROLLUP_COLUMNS, ROLLUP_USER_MEASURES, pair_sums,
                                          rollup_of_pairs)
from featuremill.operators.skew import written


@dataclass(frozen=True)
class RollupState:
    """The state's tables under ``base``, a folder that all executors see."""
    base: str
    business: str = "business_id"
    user: str = "user_id"

    def _put(self, df: DataFrame, table: str, batch: int) -> DataFrame:
        path = f"{self.base}/{table}/batch={batch}"
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def _all(self, spark: SparkSession, table: str, upto: int) -> DataFrame:
        return spark.read.parquet(f"{self.base}/{table}").where(F.col("batch") <= upto)

    def fold(self, reviews: DataFrame, users: DataFrame, batch: int) -> None:
        """Takes up the reviews of one arrival. ``users``: as for ``review_rollup``."""
        spark, business, user = reviews.sparkSession, self.business, self.user
        delta = self._put(pair_sums(reviews, business, user), "pairs", batch)
        told = self._put(delta.groupBy(user).agg(F.sum("_useful_sum").alias("_useful_sum"),
                                                 F.sum("_useful_n").alias("_useful_n")), "users", batch)
        pairs = self._all(spark, "pairs", batch)
        # businesses reviewed now, and all that a user whose average may have moved has reviewed
        moved = told.select(F.col(user).alias("_moved")).where("_moved is not null")
        also = pairs.join(moved, F.col(user) == F.col("_moved"), "left_semi").select(business)
        changed = written(delta.select(business).union(also).distinct().toDF("_changed"), "changed-businesses")
        own = (pairs.join(changed, F.col(business).eqNullSafe(F.col("_changed")), "left_semi")
               .groupBy(business, user).agg(*[F.sum(c).alias(c) for c in PAIR_SUMS]))
        averages = (self._all(spark, "users", batch).groupBy(F.col(user).alias("_of"))
                    .agg(F.try_divide(F.sum("_useful_sum"), F.sum("_useful_n")).alias("avg_useful")))
        measures = [m for m in ROLLUP_USER_MEASURES.values() if m != "avg_useful"]
        known = users.select(user, *measures).join(averages, F.col(user) == F.col("_of"), "left").drop("_of")
        self._put(rollup_of_pairs(own, known, business, user), "rollup", batch)

    def read(self, spark: SparkSession) -> DataFrame:
        """The newest row of every business."""
        rows = spark.read.parquet(f"{self.base}/rollup")
        return (rows.groupBy(self.business).agg(*[F.max_by(c, "batch").alias(c) for c in ROLLUP_COLUMNS])
                .select(self.business, *ROLLUP_COLUMNS))


def refresh_rollup(spark: SparkSession, source: str, schema, users: DataFrame, state: RollupState,
                   checkpoint: str, fmt: str = "parquet") -> None:
    """Folds the review files that arrived under ``source`` since the last run (``availableNow``)."""
    q = (spark.readStream.schema(schema).format(fmt).load(source).writeStream
         .option("checkpointLocation", checkpoint)
         .foreachBatch(lambda reviews, batch: state.fold(reviews, users, batch))
         .trigger(availableNow=True).start())
    q.awaitTermination()
