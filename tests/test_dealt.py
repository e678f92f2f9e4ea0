"""The wide business columns are made by many tasks, however few files the customers are in."""

from pyspark.sql import functions as F

from featuremill.plans import standins as S


def test_customers_are_dealt_out_before_the_wide_columns(spark, tmp_path):
    customer = spark.range(1, 801).select(
        F.col("id").alias("c_custkey"), F.concat(F.lit("C"), "id").alias("c_name"), (F.col("id") % 3).alias("c_nationkey"),
        (F.col("id") % 7 - 1.0).alias("c_acctbal"), F.when(F.col("id") % 2 == 0, "BUILDING").otherwise("HOUSEHOLD").alias("c_mktsegment"))
    # a key that comes twice, and one that is missing
    customer = customer.union(customer.where("c_custkey = 5")).union(
        customer.where("c_custkey = 6").withColumn("c_custkey", F.lit(None).cast("long")))
    customer.coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(3).select(F.col("id").alias("n_nationkey"), F.concat(F.lit("N"), "id").alias("n_name"),
                          F.lit(1).alias("n_regionkey")).write.parquet(f"{tmp_path}/nation.parquet")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        raw = S.raw_business(spark, str(tmp_path))
        sizes = [r.n for r in raw.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
        assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(sizes) <= 2 * min(sizes)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    plain = spark.sql(S.business_sql(S.SPARK, str(tmp_path))).toDF(*raw.columns)
    assert raw.count() == 802 and raw.exceptAll(plain).isEmpty() and plain.exceptAll(raw).isEmpty()
