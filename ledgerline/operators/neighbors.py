"""Next/previous row of the same account, split so a hot account scales.

``LEAD``/``LAG`` over ``PARTITION BY account ORDER BY seq`` puts a whole account
into one window group, i.e. one task; an account holding a third of a 100 TB
ledger would run on one core.  Here the window is ``PARTITION BY account,
bucket``: ordinary accounts form one bucket, hot accounts (see ``skew``) are
cut into ``seq div span`` buckets, so a group stays bounded.  Rows at bucket
edges still need the neighbour in the adjacent non-empty bucket; for that,
each bucket of a hot account contributes its first and last row to a small
"edge" table (partial aggregation, one row per bucket), a window over the
*buckets* of an account finds the neighbouring edges, and these edge rows are
added to the adjacent bucket as ghost rows before the one big window.  Ghosts
sort before/after every real row of the bucket, so the plain ``lead``/``lag``
finds them, and they are dropped afterwards.

Cost: one shuffle of the ledger (the window's), a count per account (narrow
scan, partial aggregation), a broadcast of the bounded hot-account table, and
an edge table over hot accounts only.  No shuffle join of the big side.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.operators.skew import BUCKET, HOT, Split, as_split, with_buckets

_GHOST = "_nb_ghost"


def add_neighbors(
    df: DataFrame,
    key: str,
    order: str,
    lead: Mapping[str, str] | None = None,
    lag: Mapping[str, str] | None = None,
    span: "int | Split | None" = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Add ``lead`` columns (next row's value) and ``lag`` columns (previous row's).

    ``lead``/``lag`` map output name -> source column.  ``order`` must be unique
    within ``key``.  ``span=None`` uses one window per key (only for keys known
    to be small); an int or ``Split`` cuts hot keys into ``order`` buckets.
    A ``carried`` split takes the buckets that the rows have, and keeps them.
    ``hot`` (``skew.hot_keys``) may come from a cheaper source than ``df``.
    """
    lead = dict(lead or {})
    lag = dict(lag or {})
    split = as_split(span)
    if split is None:
        w = Window.partitionBy(key).orderBy(order)
        return df.withColumns(
            {**{o: F.lead(s).over(w) for o, s in lead.items()}, **{o: F.lag(s).over(w) for o, s in lag.items()}}
        )

    base = df if split.carried else with_buckets(df, key, order, split, hot)
    base = base.withColumn(_GHOST, F.lit(False))

    # Edge rows of each (hot key, bucket): one aggregate per value column, so
    # the buffers stay fixed-width for numeric/date/boolean values and Spark
    # uses a partial hash aggregation.  Keys that are not hot have one bucket
    # and need no edges.
    lead_src = sorted(set(lead.values()) | {order})
    lag_src = sorted(set(lag.values()) | {order})
    edge_aggs = []
    if lead:
        edge_aggs += [F.min_by(c, order).alias(f"_h_{c}") for c in lead_src if c != order]
        edge_aggs.append(F.min(order).alias(f"_h_{order}"))
    if lag:
        edge_aggs += [F.max_by(c, order).alias(f"_t_{c}") for c in lag_src if c != order]
        edge_aggs.append(F.max(order).alias(f"_t_{order}"))
    edges = base.where(F.col(HOT)).groupBy(key, BUCKET).agg(*edge_aggs)
    by_bucket = Window.partitionBy(key).orderBy(BUCKET)
    near = []
    if lead:
        near += [F.lead(f"_h_{c}").over(by_bucket).alias(f"_nh_{c}") for c in lead_src]
    if lag:
        near += [F.lag(f"_t_{c}").over(by_bucket).alias(f"_pt_{c}") for c in lag_src]
    edges = edges.select(key, BUCKET, *near)

    # Both ghost kinds come out of the one edge table (one scan, one aggregation).
    all_src = sorted(set(lead_src if lead else []) | set(lag_src if lag else []))
    types = {f.name: f.dataType for f in base.schema.fields}

    def ghost(prefix: str, srcs: list[str]):
        return F.struct(
            *[(F.col(f"{prefix}{c}") if c in srcs else F.lit(None).cast(types[c])).alias(c) for c in all_src]
        )

    kinds = []
    if lead:
        kinds.append(ghost("_nh_", lead_src))
    if lag:
        kinds.append(ghost("_pt_", lag_src))
    ghosts = (
        edges.select(key, BUCKET, F.explode(F.array(*kinds)).alias("_g"))
        .where(F.col(f"_g.{order}").isNotNull())
        .select(key, BUCKET, *[F.col(f"_g.{c}").alias(c) for c in all_src], F.lit(True).alias(_GHOST))
    )
    stacked = base.unionByName(ghosts, allowMissingColumns=True)

    w = Window.partitionBy(key, BUCKET).orderBy(order)
    out = stacked.withColumns(
        {**{o: F.lead(s).over(w) for o, s in lead.items()}, **{o: F.lag(s).over(w) for o, s in lag.items()}}
    )
    return out.where(~F.col(_GHOST)).drop(_GHOST, *([] if split.carried else [BUCKET, HOT]))
