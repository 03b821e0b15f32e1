"""Scalar functions: money rounding, lenient casts, dates, narration numbers."""

import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions import as_date, extract_txn_number, lenient_double, round_money


@pytest.mark.parametrize(
    "x, want",
    [(1.005, 1.0), (2.675, 2.68), (-1.005, -1.0), (0.125, 0.13), (-0.125, -0.13), (1e7, 1e7), (None, None)],
)
def test_round_money_matches_sql_engine_rule(spark, x, want):
    df = spark.createDataFrame([(x,)], "x double")
    assert df.select(round_money("x").alias("r")).first().r == want


def test_lenient_double(spark):
    df = spark.createDataFrame([("1.5",), ("abc",), (None,), ("",), ("-2",)], "s string")
    assert [r.v for r in df.select(lenient_double("s").alias("v")).collect()] == [1.5, None, None, None, -2.0]


def test_as_date_from_text_and_timestamp(spark):
    df = spark.createDataFrame([("2024-01-05",), ("2024/01/06",), ("05/01/2024",), (None,)], "s string")
    got = [r.d for r in df.select(as_date(F.col("s"), T.StringType()).alias("d")).collect()]
    assert got == [datetime.date(2024, 1, 5), datetime.date(2024, 1, 6), None, None]


@pytest.mark.parametrize(
    "text, want",
    [
        ("Payment Txn No: TXN123 ok", "TXN123"),
        ("payment txn no:txn_9a", "txn_9a"),
        ("Txn No:   TXNab12 and Txn No: TXN2", "TXNab12"),
        ("no number here", None),
        ("nan", None),
        ("", None),
        (None, None),
        ("Txn No: TXNé1", "TXNé1"),
    ],
)
def test_extract_txn_number(spark, text, want):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(extract_txn_number("s").alias("n")).first().n == want


def test_lenient_double_rejects_java_suffixes(spark):
    df = spark.createDataFrame([("1.5d",), ("2f",), (" 3 ",), ("1e3",), ("NaN",), ("-inf",), (".5",), ("1,000",)], "s string")
    got = [r.v for r in df.select(lenient_double("s").alias("v")).collect()]
    assert got[:4] == [None, None, 3.0, 1000.0]
    assert got[4] != got[4] and got[5] == float("-inf") and got[6] == 0.5 and got[7] is None


def test_as_date_rejects_partial_dates(spark):
    df = spark.createDataFrame([("2024",), ("2024-01",), ("2024-1-5",)], "s string")
    got = [r.d for r in df.select(as_date(F.col("s"), T.StringType()).alias("d")).collect()]
    assert got == [None, None, datetime.date(2024, 1, 5)]
