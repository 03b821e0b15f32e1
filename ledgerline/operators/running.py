"""Running totals per key, exact and split for hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.operators.skew import BUCKET, HOT, Split, with_buckets


def running_totals(df: DataFrame, key: str, order: str, value: "str | Sequence[str]", span: "int | Split") -> DataFrame:
    """Add ``_before`` (sum of earlier rows) and ``_through`` (including this row).

    Prefix sums of ``value`` (an integer or DECIMAL) per ``key`` in ``order``;
    of several values in one pass, as ``_before_<value>`` and ``_through_<value>``.
    Hot keys are cut into ``order`` buckets of ``span`` (others stay whole, see
    ``operators.skew``); each bucket of a hot key gets one extra leading row
    carrying the total of the key's earlier buckets (from a small per-bucket
    table), so the running sum needs no join and no task holds a whole key.
    """
    split = span if isinstance(span, Split) else Split(span)
    ends = {value: ""} if isinstance(value, str) else {v: f"_{v}" for v in value}
    b = with_buckets(df, key, order, split).withColumnRenamed(BUCKET, "_b")
    b = b.withColumn("_carry_row", F.lit(False))
    bucket_sums = b.where(F.col(HOT)).groupBy(key, "_b").agg(*[F.sum(v).alias(f"_bsum{end}") for v, end in ends.items()])
    earlier = Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = bucket_sums.select(
        key,
        "_b",
        *[F.sum(f"_bsum{end}").over(earlier).alias(v) for v, end in ends.items()],
        F.lit(-(1 << 63)).cast("long").alias(order),
        F.lit(True).alias("_carry_row"),
    ).where(F.coalesce(*ends).isNotNull())
    stacked = b.unionByName(carry, allowMissingColumns=True)
    within = Window.partitionBy(key, "_b").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    running = stacked.withColumns({f"_through{end}": F.sum(v).over(within) for v, end in ends.items()}).where(~F.col("_carry_row"))
    before = {f"_before{end}": F.col(f"_through{end}") - F.col(v) for v, end in ends.items()}
    return running.withColumns(before).drop("_b", "_carry_row", HOT)
