"""Literal ledgers for unit tests, in the reference's input column names."""

from __future__ import annotations

from pyspark.sql import types as T

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("AccountNumber", T.StringType()),
        T.StructField("Date", T.StringType()),
        T.StructField("Type", T.StringType()),
        T.StructField("Amount", T.StringType()),
        T.StructField("TransactionNumber", T.StringType()),
        T.StructField("OpeningBalance", T.StringType()),
        T.StructField("ClosingBalance", T.StringType()),
        T.StructField("seq", T.LongType()),
    ]
)
CUSTOMER_SCHEMA = T.StructType(
    [
        T.StructField("CustomerName", T.StringType()),
        T.StructField("AccountNumber", T.StringType()),
        T.StructField("Amount", T.StringType()),
    ]
)
MAPPING_SCHEMA = T.StructType(
    [
        T.StructField("AccountNumber", T.StringType()),
        T.StructField("Date", T.StringType()),
        T.StructField("TransactionNumber", T.StringType()),
    ]
)


def ledger(spark, rows, account="A1", opening="0", closing="0"):
    """rows: (type, amount, number) or (account, type, amount, number); seq = position."""
    out = []
    for i, r in enumerate(rows):
        if len(r) == 3:
            acct, (ty, amt, no) = account, r
        else:
            acct, ty, amt, no = r
        out.append((acct, f"2024-01-{(i % 28) + 1:02d}", ty, amt, no, opening, closing, i + 1))
    return spark.createDataFrame(out, LEDGER_SCHEMA)


def customers(spark, rows=(("Alice", "A1", "10.5"),)):
    return spark.createDataFrame(list(rows), CUSTOMER_SCHEMA)


def mappings(spark, rows=()):
    return spark.createDataFrame(list(rows), MAPPING_SCHEMA)
