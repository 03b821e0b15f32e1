"""DR/CR pairing: a numbered positive debit is paired with the row right after
it in the same account when that row is a credit of exactly the same amount.

Two classifications of the same pairs:

* forward (per-transaction report): every row gets the *next* row's credit and
  is ``DR_with_paired_CR`` / ``DR_unpaired`` / ``CR_transaction`` / ``other``;
* backward (per-account report): every row gets the *previous* row's debit and
  number and is ``DR_with_txn`` / ``CR_paired`` / ``other``.

Both are one neighbour pass (``add_neighbors``) -- one shuffle of the ledger on
(account, bucket), hot accounts split -- and always run before any join, so
join fan-out cannot disturb adjacency.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.config import DEFAULT_SPAN
from ledgerline.functions import has_number
from ledgerline.operators.neighbors import add_neighbors

# Pair classes.
DR_WITH_PAIRED_CR = "DR_with_paired_CR"
DR_UNPAIRED = "DR_unpaired"
CR_TRANSACTION = "CR_transaction"
DR_WITH_TXN = "DR_with_txn"
CR_PAIRED = "CR_paired"
OTHER = "other"

KEY = "account_number"
ORDER = "seq"


def numbered_debit() -> Column:
    """Positive debit carrying a transaction number."""
    return (F.col("debit_amount") > F.lit(0)) & has_number("ledger_txn_no")


def forward_paired() -> Column:
    """This row is a numbered debit and the next row is its equal credit."""
    return numbered_debit() & (F.col("next_credit") == F.col("debit_amount"))


def backward_paired() -> Column:
    """This row is a credit equal to the numbered debit right before it."""
    return (
        (F.col("credit_amount") > F.lit(0))
        & (F.col("prev_debit") == F.col("credit_amount"))
        & F.coalesce(F.col("prev_numbered"), F.lit(False))
    )


def forward_class() -> Column:
    return (
        F.when(forward_paired(), F.lit(DR_WITH_PAIRED_CR))
        .when(numbered_debit(), F.lit(DR_UNPAIRED))
        .when(F.col("credit_amount") > F.lit(0), F.lit(CR_TRANSACTION))
        .otherwise(F.lit(OTHER))
    )


def backward_class() -> Column:
    return (
        F.when(numbered_debit(), F.lit(DR_WITH_TXN))
        .when(backward_paired(), F.lit(CR_PAIRED))
        .otherwise(F.lit(OTHER))
    )


def with_next_credit(ledger: DataFrame, span: int | None = DEFAULT_SPAN) -> DataFrame:
    """Add ``next_credit``: the next row's credit amount in the same account."""
    return add_neighbors(ledger, KEY, ORDER, lead={"next_credit": "credit_amount"}, span=span)


def _numbered(ledger: DataFrame) -> DataFrame:
    return ledger.withColumn("_numbered", has_number("ledger_txn_no"))


def with_prev_debit(ledger: DataFrame, span: int | None = DEFAULT_SPAN, keep_number: bool = False) -> DataFrame:
    """Add ``prev_debit`` and ``prev_numbered`` (and ``prev_txn_no`` if asked) of the previous row.

    Classification only needs to know whether the previous row had a number; a
    boolean keeps the edge aggregation fixed-width.
    """
    lag = {"prev_debit": "debit_amount", "prev_numbered": "_numbered"}
    if keep_number:
        lag["prev_txn_no"] = "ledger_txn_no"
    return add_neighbors(_numbered(ledger), KEY, ORDER, lag=lag, span=span).drop("_numbered")


def classify_forward(ledger: DataFrame, span: int | None = DEFAULT_SPAN) -> DataFrame:
    return with_next_credit(ledger, span).withColumn("pair_type", forward_class())


def classify_backward(ledger: DataFrame, span: int | None = DEFAULT_SPAN) -> DataFrame:
    return with_prev_debit(ledger, span).withColumn("pair_type", backward_class())


def classify_both(ledger: DataFrame, span: int | None = DEFAULT_SPAN) -> DataFrame:
    """Both classes from one neighbour pass, plus the next row's date.

    Adds ``next_credit``, ``next_date``, ``prev_debit``, ``prev_numbered``,
    ``forward_type`` and ``pair_type`` (backward).
    """
    d = add_neighbors(
        _numbered(ledger),
        KEY,
        ORDER,
        lead={"next_credit": "credit_amount", "next_date": "date"},
        lag={"prev_debit": "debit_amount", "prev_numbered": "_numbered"},
        span=span,
    ).drop("_numbered")
    return d.withColumns({"forward_type": forward_class(), "pair_type": backward_class()})


def paired_debits(ledger: DataFrame, span: int | None = DEFAULT_SPAN) -> DataFrame:
    """Numbered positive debits only (both DR classes), with ``next_credit`` and ``paired``.

    The class filter is written on base columns so Catalyst can push it to the
    scan side of later joins; it stays above the window, as it must.
    """
    d = with_next_credit(ledger, span)
    return d.where(numbered_debit()).withColumn("paired", F.coalesce(forward_paired(), F.lit(False)))
