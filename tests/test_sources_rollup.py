"""Sources keep account text; the report sink's text; rollup sums with NaN and exact decimals."""

import math
import os
import tempfile

from pyspark.sql import functions as F

from ledgerline.operators import rollup
from ledgerline.operators.prepare import prepare_customers
from ledgerline.operators.skew import Split
from ledgerline.sources.readers import read_customers, report_text


def test_csv_account_numbers_keep_leading_zeros(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="ledgerline-src-"), "acc.csv")
    with open(path, "w") as fh:
        fh.write("CustomerName,AccountNumber,Amount\nAnn,00123,1.50\nBob,0456,x\n")
    got = prepare_customers(read_customers(spark, path)).orderBy("customer_name").collect()
    assert [(r.account_number, r.customer_amount) for r in got] == [("00123", 1.5), ("0456", None)]


def test_report_text_format(spark):
    df = spark.createDataFrame([(1e7, float("nan"), "", 3)], "a double, b double, c string, d int")
    r = report_text(df).first()
    assert (r.a, r.b, r.c, r.d) == ("10000000.00", "NaN", None, "3")


def _rows(spark, values):
    data = [
        ("A1", "n", f"n{i}", "2024-01-01", 0.0, v, 1, 1, 5.0, 5.0, 1.0, i) for i, v in enumerate(values)
    ]
    schema = (
        "account_number string, customer_name string, transaction_nos string, dates string, total_debit double, "
        "total_credit double, debit_count int, credit_count int, opening_balance double, closing_balance double, "
        "customer_amount double, seq long"
    )
    return spark.createDataFrame(data, schema)


def test_rollup_sums_are_exact_and_nan_propagates(spark):
    exact = rollup.account_rollup(_rows(spark, [0.1] * 10 + [0.2] * 10)).first()
    assert exact.total_credit == 3.0 and exact.tally_value == 8.0
    assert exact.transaction_nos == "\n".join(f"n{i}" for i in range(20))
    nan = rollup.account_rollup(_rows(spark, [1.0, float("nan")])).first()
    assert math.isnan(nan.total_credit) and math.isnan(nan.tally_value)


def test_rollup_two_stage_lists_keep_order(spark):
    rows = _rows(spark, [float(i) for i in range(40)])
    whole = rollup.account_rollup(rows, span=None).first()
    split = rollup.account_rollup(rows, span=3).first()  # the account is hot: 3-seq buckets
    assert whole.transaction_nos == split.transaction_nos == "\n".join(f"n{i}" for i in range(40))
    assert whole.total_credit == split.total_credit == float(sum(range(40)))


def test_parts_of_several_lists_read_their_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def look(number):
        seen.add(1)
        return number

    rows = _rows(spark, [float(i) for i in range(40)])
    rows = rows.withColumns({
        "account_number": F.when(F.col("seq") % 5 > 0, "A1"),
        "transaction_nos": F.when(F.col("seq") % 7 > 0, F.col("transaction_nos")),
        "dates": F.when(F.col("seq") % 3 > 0, F.col("dates")),
    })
    lists = ("transaction_nos", "dates")
    for split in (Split(span=4, hot_rows=3), Split()):
        own = [r for c in lists for r in rollup.list_parts(rows, c, 16, split).collect()]
        assert max(r.part for r in own) > 2
        seen.value = 0
        looked = rows.repartition(3).withColumn("seq", F.udf(look, "long")("seq"))
        assert sorted(rollup.list_parts(looked, lists, 16, split).collect(), key=str) == sorted(own, key=str)
        assert seen.value == 38  # rows 0 and 21 are in no list
    whole = rollup.account_rollup(rows, span=None).collect()
    for w in whole:
        parts = sorted((r for r in own if r.account_number == w.account_number and r.list == "dates"), key=lambda r: r.part)
        assert "\n".join(r.text for r in parts) == w.dates
