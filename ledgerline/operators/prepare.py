"""Rename, cast and clean the three inputs (DataFrame -> DataFrame, no actions)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions import as_date, lenient_double, round_money
from ledgerline.functions.dates import EXTRA_DATE_FORMATS

# Ledger transaction types, compared exactly (case and blanks count).
DEBIT_TYPE = "DR"
CREDIT_TYPE = "CR"


def _text(df: DataFrame, name: str):
    return F.col(name).cast("string")


def prepare_customers(df: DataFrame) -> DataFrame:
    """CustomerName/AccountNumber/Amount -> account_number, customer_name, customer_amount."""
    return df.select(
        _text(df, "AccountNumber").alias("account_number"),
        _text(df, "CustomerName").alias("customer_name"),
        lenient_double(F.col("Amount"), df.schema["Amount"].dataType).alias("customer_amount"),
    )


def prepare_mappings(df: DataFrame, layouts: tuple[str, ...] = EXTRA_DATE_FORMATS) -> DataFrame:
    """AccountNumber/Date/TransactionNumber -> account_number, txn_date (DATE), transaction_number."""
    return df.select(
        _text(df, "AccountNumber").alias("account_number"),
        as_date(F.col("Date"), df.schema["Date"].dataType, layouts).alias("txn_date"),
        _text(df, "TransactionNumber").alias("transaction_number"),
    )


def prepare_ledger(df: DataFrame, order_col: str = "seq", money: str = "double", carry: tuple[str, ...] = (),
                   layouts: tuple[str, ...] = EXTRA_DATE_FORMATS) -> DataFrame:
    """Ledger rows typed, money nulls as 0.0, and debit/credit split by type.

    ``order_col`` (arrival order, unique) is required: the reference numbers
    rows in file order, which a parallel reader does not keep by itself.  Use
    ``ledgerline.operators.sequence.sequence_from_files`` to derive one.

    ``money="double"`` keeps amounts as read (pairing compares doubles exactly,
    as the reference does); ``money="cents"`` reads them as DECIMAL(18,2)
    values, i.e. rounded to cents, so equal cent amounts always pair.  Columns
    named in ``carry`` go along as they are; ``layouts`` are the text dates'
    patterns besides ISO.
    """
    if order_col not in df.columns:
        raise ValueError(f"ledger needs an arrival-order column {order_col!r}")
    if money not in ("double", "cents"):
        raise ValueError(f"money must be 'double' or 'cents', not {money!r}")

    def amount(name: str):
        value = lenient_double(F.col(name), df.schema[name].dataType)
        if money == "cents":
            value = round_money(value)
        return F.coalesce(value, F.lit(0.0))

    typed = df.select(
        _text(df, "AccountNumber").alias("account_number"),
        as_date(F.col("Date"), df.schema["Date"].dataType, layouts).alias("date"),
        _text(df, "Type").alias("transaction_type"),
        amount("Amount").alias("amount"),
        _text(df, "TransactionNumber").alias("ledger_txn_no"),
        amount("OpeningBalance").alias("opening_balance"),
        amount("ClosingBalance").alias("closing_balance"),
        F.col(order_col).cast(T.LongType()).alias("seq"),
        *carry,
    )
    return split_debit_credit(typed)


def split_debit_credit(df: DataFrame) -> DataFrame:
    """debit_amount = amount for 'DR' else 0.0; credit_amount likewise for 'CR'."""
    kind = F.col("transaction_type")
    return df.withColumns(
        {
            "debit_amount": F.when(kind == F.lit(DEBIT_TYPE), F.col("amount")).otherwise(F.lit(0.0)),
            "credit_amount": F.when(kind == F.lit(CREDIT_TYPE), F.col("amount")).otherwise(F.lit(0.0)),
        }
    )


def observed(raw: DataFrame, layouts: tuple[str, ...] = EXTRA_DATE_FORMATS) -> tuple[DataFrame, Observation]:
    """``raw`` (an input table) and what is counted of it while an action reads it, without a pass of its own.

    After the action, ``Observation.get`` has ``rows``, ``unread_dates`` and,
    for each money column, ``unread_<column>``: values that are there, but
    become null when prepared with ``layouts``.  Every action on the result
    counts once more only where a new observation is made.
    """
    schema = raw.schema

    def unread(name: str, value) -> Column:
        text = F.col(name).cast("string")
        return F.count(F.when(text.isNotNull() & (F.trim(text) != "") & value.isNull(), 1)).alias(f"unread_{name}")

    found = [F.count(F.lit(1)).alias("rows")]
    if "Date" in raw.columns:
        found.append(unread("Date", as_date(F.col("Date"), schema["Date"].dataType, layouts)))
    for name in ("Amount", "OpeningBalance", "ClosingBalance"):
        if name in raw.columns:
            found.append(unread(name, lenient_double(F.col(name), schema[name].dataType)))
    seen = Observation()
    return raw.observe(seen, *found), seen


def row_count(df: DataFrame) -> DataFrame:
    """Rows of a source as a one-row DataFrame (a metric, not control flow)."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))
