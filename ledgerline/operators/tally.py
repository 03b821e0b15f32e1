"""Per-transaction tally: one row per numbered positive debit.

``tally_value = round(opening_balance + credit - debit, 2)`` where credit is
the paired credit's amount (0.0 when unpaired).  Plan: neighbour pass, filter
to numbered debits and two left joins on one shuffle of the ledger (see
``copartition``) -> a projection; no action, no Python in the data path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.config import DEFAULT_SPAN
from ledgerline.functions import date_text, number_or_null, round_money
from ledgerline.operators.copartition import pair_and_enrich
from ledgerline.operators.enrich import effective_date
from ledgerline.operators.pairing import numbered_debit, paired_debits
from ledgerline.operators.prune import matching_mappings

# The result columns, in the reference's order, plus the two we carry
# (closing balance, which its column flag names, and the arrival order).
RESULT_COLUMNS = (
    "account_number",
    "customer_name",
    "transaction_nos",
    "dates",
    "total_debit",
    "total_credit",
    "opening_balance",
    "debit_count",
    "credit_count",
    "tally_value",
    "customer_amount",
)
CARRIED_COLUMNS = ("closing_balance", "seq")


def tally_rows(rows: DataFrame, *more: str) -> DataFrame:
    """Final projection of rows that carry ``debit``/``credit``/``final_date``; columns ``more`` go along."""
    one = F.lit(1).cast("int")
    return rows.select(
        "account_number",
        "customer_name",
        number_or_null("ledger_txn_no").alias("transaction_nos"),
        date_text("final_date").alias("dates"),
        round_money("debit").alias("total_debit"),
        round_money("credit").alias("total_credit"),
        round_money("opening_balance").alias("opening_balance"),
        one.alias("debit_count"),
        one.alias("credit_count"),
        round_money(F.col("opening_balance") + F.col("credit") - F.col("debit")).alias("tally_value"),
        "customer_amount",
        round_money("closing_balance").alias("closing_balance"),
        "seq",
        *more,
    )


def tally_per_transaction(
    ledger: DataFrame,
    customers: DataFrame,
    mappings: DataFrame | None = None,
    span: int | None = DEFAULT_SPAN,
    prune_mapping: bool = False,
) -> DataFrame:
    """Prepared ledger/customers/mappings -> per-transaction tally rows.

    ``prune_mapping``: drop the mapping's rows that no debit asks for before
    they are shuffled (``prune``), for a mapping far larger than the debits.
    """
    if prune_mapping:
        mappings = matching_mappings(mappings, ledger.where(numbered_debit()))
    enriched = effective_date(pair_and_enrich(ledger, customers, mappings, paired_debits, span))
    amounts = enriched.withColumns(
        {
            "debit": F.col("debit_amount"),
            "credit": F.when(F.col("paired"), F.col("next_credit")).otherwise(F.lit(0.0)),
        }
    )
    return tally_rows(amounts)


def sort_by_ledger_order(result: DataFrame) -> DataFrame:
    """ORDER BY account_number (nulls last), arrival order."""
    return result.orderBy(F.asc_nulls_last("account_number"), F.asc("seq"))


def sort_for_report(result: DataFrame) -> DataFrame:
    """ORDER BY account_number, dates (nulls last), with arrival order breaking ties."""
    return result.orderBy(F.asc_nulls_last("account_number"), F.asc_nulls_last("dates"), F.asc("seq"))
