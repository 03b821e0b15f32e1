"""Pairing and enrichment on one partitioning of the ledger.

The neighbour window of ``neighbors`` hashes rows on (account, bucket), and a
join on the account cannot reuse that: with large side tables every join would
shuffle the ledger's rows again.  Here the ledger is dealt into two branches:

* ordinary accounts are hashed on the account alone.  Their window, the
  customer join and (with ``spark.sql.requireAllClusterKeysForCoPartition``
  off, see ``session.recommended_conf``) the mapping join on account and number
  all run on that one shuffle; only the side tables are shuffled to it;
* hot accounts (see ``skew``; by their rows in the ledger and the mapping
  together, so that neither puts a large account into one task) are hashed on (account, bucket).
  Their customers are repeated per bucket, one row for each, and join there.
  Their mapped dates join on account and number, which spreads an account:
  the kept rows of hot accounts are shuffled a second time, no others are.

Null accounts pair among themselves and match no customer and no mapping.
Without a hot account AQE drops the second branch at run time; with one, the
ledger is scanned once per branch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.config import DEFAULT_SPAN
from ledgerline.operators.enrich import add_customer, add_mapped_date
from ledgerline.operators.pairing import KEY, ORDER
from ledgerline.operators.skew import BUCKET, HOT, Split, as_split, bucket_of, hinted, hot_keys


def pair_and_enrich(
    ledger: DataFrame,
    customers: DataFrame,
    mappings: DataFrame | None,
    pair: "Callable[[DataFrame, int | Split | None], DataFrame]",
    span: "int | Split | None" = DEFAULT_SPAN,
) -> DataFrame:
    """``pair(rows, split)``, a neighbour pass and a choice of rows, with customers and mapped dates added."""
    split = as_split(span)
    if split is None:
        return add_mapped_date(add_customer(pair(ledger, None), customers), mappings)
    accounts = ledger.select(KEY)
    if mappings is not None:
        accounts = accounts.unionAll(mappings.select(KEY))
    hot = hinted(hot_keys(accounts, KEY, split).select("_sk_key"), split)

    def of(df: DataFrame, how: str) -> DataFrame:
        return df.join(hot, F.col(KEY).eqNullSafe(F.col("_sk_key")), how)

    def dates(how: str) -> DataFrame | None:
        return None if mappings is None else of(mappings, how)

    ordinary = pair(of(ledger, "left_anti"), None)
    ordinary = add_mapped_date(add_customer(ordinary, customers), dates("left_anti"))

    rows = of(ledger, "left_semi").withColumns({HOT: F.lit(True), BUCKET: bucket_of(ORDER, split, F.lit(True))})
    buckets = rows.select(KEY, BUCKET).distinct()
    names = of(customers, "left_semi").join(buckets, KEY)
    split_up = add_customer(pair(rows, Split(split.span, split.hot_rows, carried=True)), names, BUCKET)
    split_up = add_mapped_date(split_up, dates("left_semi")).drop(HOT, BUCKET)
    return ordinary.unionByName(split_up)
