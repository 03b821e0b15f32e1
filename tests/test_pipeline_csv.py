"""End-to-end job from CSV files to a CSV report, and the sink's text format."""

import os
import tempfile

from ledgerline.config import REPORT_OPTIONS, TallyOptions
from ledgerline.plans import jobs
from ledgerline.sources.readers import read_report_csv
from tests.helpers import customers, ledger, mappings


def _write_csv(df, path):
    df.coalesce(1).write.option("header", True).csv(path)


def test_pipeline_from_csv(spark):
    base = tempfile.mkdtemp(prefix="ledgerline-csv-")
    rows = [("DR", "10000000", "n1"), ("CR", "10000000", None), ("DR", "3", "n2"), ("CR", "3", "c9")]
    _write_csv(customers(spark, [("Bob, Jr.", "A1", "12.5")]), f"{base}/acc.csv")
    _write_csv(ledger(spark, rows, opening="1.005"), f"{base}/led.csv")
    _write_csv(mappings(spark, [("A1", "2031-01-02", "n2")]), f"{base}/map.csv")

    out = jobs.run_pipeline(
        spark, f"{base}/acc.csv", f"{base}/led.csv", f"{base}/out_txn", f"{base}/map.csv", REPORT_OPTIONS
    )
    got = read_report_csv(spark, out).orderBy("transaction_nos").collect()
    assert [r.transaction_nos for r in got] == ["n1", "n2"]
    assert got[0].total_debit == "10000000.00" and got[0].customer_name == "Bob, Jr."
    assert got[1].dates == "2031-01-02" and got[0].opening_balance == "1.00"

    opts = TallyOptions(include_dates=True, include_closing_balance=True, include_customer_amount=True)
    out2 = jobs.run_pipeline(spark, f"{base}/acc.csv", f"{base}/led.csv", f"{base}/out_acc", f"{base}/map.csv", opts, "account")
    acc = read_report_csv(spark, out2).collect()
    assert len(acc) == 1
    assert acc[0].transaction_nos == "n1\nn2"
    assert list(acc[0].asDict()) == [
        "account_number", "customer_name", "transaction_nos", "dates", "closing_balance",
        "customer_amount", "debit_count", "credit_count", "tally_value",
    ]
    assert os.path.isdir(out2)


def test_pipeline_orders_csv_ledger_without_seq_by_file_order(spark):
    base = tempfile.mkdtemp(prefix="ledgerline-csv2-")
    rows = [("DR", "5", "n1"), ("CR", "5", None), ("DR", "8", "n2"), ("CR", "9", None)]
    _write_csv(customers(spark, [("Ann", "A1", "1")]), f"{base}/acc.csv")
    _write_csv(ledger(spark, rows).orderBy("seq").drop("seq"), f"{base}/led.csv")
    out = jobs.run_pipeline(spark, f"{base}/acc.csv", f"{base}/led.csv", f"{base}/out", options=REPORT_OPTIONS)
    got = {r.transaction_nos: r.total_credit for r in read_report_csv(spark, out).collect()}
    assert got == {"n1": "5.00", "n2": "0.00"}


def test_command_line_arguments():
    from ledgerline.__main__ import parse_args

    a = parse_args(["--customers", "c", "--ledger", "l", "--output", "o", "--form", "account", "--dates", "--span", "64"])
    assert a.form == "account" and a.dates and not a.debit and a.span == 64 and a.mapping is None


def test_command_line_main_writes_report(spark):
    from ledgerline.__main__ import main

    base = tempfile.mkdtemp(prefix="ledgerline-cli-")
    _write_csv(customers(spark, [("Ann", "A1", "1")]), f"{base}/acc.csv")
    _write_csv(ledger(spark, [("DR", "4", "n1"), ("CR", "4", None)]), f"{base}/led.csv")
    main(["--customers", f"{base}/acc.csv", "--ledger", f"{base}/led.csv", "--output", f"{base}/out", "--credit"])
    rows = read_report_csv(spark, f"{base}/out").collect()
    assert [(r.transaction_nos, r.total_credit, r.tally_value) for r in rows] == [("n1", "4.00", "0.00")]


def test_recommended_conf_sizes_partitions():
    from ledgerline.session import recommended_conf

    assert recommended_conf(100 * (1 << 30))["spark.sql.shuffle.partitions"] == "800"
    assert recommended_conf(100 * (1 << 40))["spark.sql.shuffle.partitions"] == "65536"
    assert recommended_conf(1)["spark.sql.shuffle.partitions"] == "200"
