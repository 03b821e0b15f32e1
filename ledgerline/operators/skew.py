"""Which keys to split, and how: hot keys get ``seq`` buckets, all others stay whole.

A per-key window or list is fine for ordinary accounts; an account holding a
large share of the ledger must be split.  ``Split(span, hot_rows)`` says: a key
with more than ``hot_rows`` rows is hot and its rows are cut into buckets of
``span`` order units (``order div span``; with a unique order a bucket holds
at most ``span`` rows); every other key is one group of at most ``hot_rows``
rows.  So no group ever exceeds ``max(span, hot_rows)`` rows.

Hot keys are found by one count per key (partial aggregation, a narrow scan).
At most ``N / hot_rows`` keys can be hot, so the hot-key table has a proven
size bound and is broadcast explicitly (``DEFAULT_SPAN`` = 4M rows gives at
most 250,000 hot keys per 10^12 ledger rows, a few MB; thresholds under 2^20
rows leave the choice to Spark's size check); ordinary keys never touch the
bucket machinery.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.config import DEFAULT_SPAN

# Bucket id of keys that are not split (any constant works: one group per key).
WHOLE = -1
# The hot-key table is broadcast by hint only when its bound N / threshold is
# small: at a threshold of 2^20 rows that is under 10^6 keys per 10^12 rows.
# Below it (fine test splits) Spark's own size check picks the join.
BROADCAST_MIN_THRESHOLD = 1 << 20
BUCKET = "_sk_bucket"
HOT = "_sk_hot"


@dataclass(frozen=True)
class Split:
    span: int = DEFAULT_SPAN
    hot_rows: int | None = None  # defaults to span
    # The rows carry their buckets already (``_sk_hot``, ``_sk_bucket``) and keep them.
    carried: bool = False

    @property
    def threshold(self) -> int:
        return self.hot_rows if self.hot_rows is not None else self.span


def as_split(span: "int | Split | None") -> Split | None:
    if span is None or isinstance(span, Split):
        return span
    return Split(int(span))


def hot_keys(df: DataFrame, key: str, split: Split) -> DataFrame:
    """Keys with more than ``split.threshold`` rows: columns ``_sk_key``, ``_sk_hot``.

    At most ``rows(df) / threshold`` rows, whatever the data.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_sk_n"))
    return counts.where(F.col("_sk_n") > F.lit(split.threshold)).select(
        F.col(key).alias("_sk_key"), F.lit(True).alias(HOT)
    )


def hinted(hot: DataFrame, split: Split) -> DataFrame:
    """The hot-key table, to be broadcast where its bound is small."""
    return F.broadcast(hot) if split.threshold >= BROADCAST_MIN_THRESHOLD else hot


def with_buckets(df: DataFrame, key: str, order: str, split: Split, hot: DataFrame | None = None) -> DataFrame:
    """Add ``_sk_hot`` (key is hot) and ``_sk_bucket`` (``order div span`` if hot, else constant).

    ``hot`` (from ``hot_keys``) may be computed once from a cheaper source,
    e.g. the ledger scan, instead of recomputing ``df``'s plan for the count.
    """
    if hot is None:
        hot = hot_keys(df, key, split)
    hot = hinted(hot, split)
    joined = df.join(hot, F.col(key).eqNullSafe(F.col("_sk_key")), "left").drop("_sk_key")
    is_hot = F.coalesce(F.col(HOT), F.lit(False))
    return joined.withColumn(HOT, is_hot).withColumn(BUCKET, bucket_of(order, split, is_hot))


def bucket_of(order: str, split: Split, is_hot: Column) -> Column:
    return F.when(is_hot, F.expr(f"`{order}` div {int(split.span)}")).otherwise(F.lit(WHOLE).cast("long"))
