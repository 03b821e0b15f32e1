"""Whether a sorted result is in order, checked where it lies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _place(columns: Sequence[str]) -> Column:
    """The columns as one value that compares like ORDER BY, nulls last."""
    parts = [x for c in columns for x in (F.col(c).isNull().alias(f"_n_{c}"), F.col(c).alias(f"_v_{c}"))]
    return F.struct(*parts)


def order_breaks(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The places where a row of ``rows`` comes before its predecessor: ``partition``, ``place``, ``previous``.

    Rows are compared within their partition; of every partition the first and
    the last row meet their neighbours' in a table of one row per partition.
    """
    numbered = rows.select(
        F.spark_partition_id().alias("partition"), F.monotonically_increasing_id().alias("_at"), _place(columns).alias("place")
    )
    inside = numbered.withColumn("previous", F.lag("place").over(Window.partitionBy("partition").orderBy("_at")))
    edges = numbered.groupBy("partition").agg(F.min_by("place", "_at").alias("place"), F.max_by("place", "_at").alias("_last"))
    # One row per partition of the result.
    edges = edges.withColumn("previous", F.lag("_last").over(Window.orderBy("partition")))
    both = inside.select("partition", "place", "previous").unionAll(edges.select("partition", "place", "previous"))
    return both.where(F.col("previous") > F.col("place"))
