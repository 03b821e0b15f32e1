"""One account holding a third of all rows: the bucketed window splits it, results unchanged."""

from pyspark.sql import functions as F

from ledgerline.operators.neighbors import add_neighbors


def _hot_ledger(spark, n=30000):
    return spark.range(0, n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("A"), (F.col("id") % 997).cast("string"))).alias("k"),
        F.col("id").alias("seq"),
        (F.col("id") % 7).cast("double").alias("v"),
    )


def test_hot_account_split_and_equal(spark):
    prev = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = _hot_ledger(spark)
        bucketed = add_neighbors(df, "k", "seq", lead={"nv": "v"}, lag={"pv": "v"}, span=1024)
        plain = add_neighbors(df, "k", "seq", lead={"nv": "v"}, lag={"pv": "v"}, span=None)
        assert bucketed.exceptAll(plain).count() == 0 and plain.exceptAll(bucketed).count() == 0

        def largest_share(out):
            # Aggregate the window's outputs so Catalyst keeps the window.
            sizes = (
                out.withColumn("p", F.spark_partition_id())
                .groupBy("p")
                .agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("nv", F.lit(0.0)) + F.coalesce("pv", F.lit(0.0))))
                .collect()
            )
            return max(r["n"] for r in sizes) / df.count()

        assert largest_share(plain) > 1 / 3  # the whole hot account in one task
        assert largest_share(bucketed) < 0.25  # spread over the shuffle partitions
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", prev)
