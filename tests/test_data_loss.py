"""Values and rows that must not get lost: extreme amounts, empty ledgers, file formats."""

import pytest

from ledgerline.operators import rollup, sequence
from ledgerline.sources import readers


@pytest.mark.parametrize(
    "amounts,want",
    [([1e37, 5.0], 1e37), ([0.1, 0.2], 0.3), ([9e35] * 3, 2.7e36), ([9.9e35] * 200, 1.98e38), ([float("inf"), 1.0], float("inf")), ([None, None], None)],
)
def test_rollup_keeps_amounts_beyond_the_decimal(spark, amounts, want):
    rows = spark.createDataFrame(
        [("a", "n", str(i), None, x, x, 1.0, 1, 1, 0.0, 2.0, 3.0, i) for i, x in enumerate(amounts)],
        "account_number string, customer_name string, transaction_nos string, dates string, total_debit double, total_credit double,"
        " opening_balance double, debit_count int, credit_count int, tally_value double, customer_amount double,"
        " closing_balance double, seq long",
    )
    for span in (None, 1):
        got = rollup.account_rollup(rows, span=span).select("total_debit").first()[0]
        assert got == want if want is None else got == pytest.approx(want)


def test_report_text_keeps_what_no_decimal_holds(spark):
    frame = spark.createDataFrame([(float("inf"),), (1e37,), (float("nan"),), (12.5,), (None,)], "x double")
    assert [r.x for r in readers.report_text(frame).collect()] == ["Infinity", "1.0E37", "NaN", "12.50", None]


def test_empty_batches_are_an_empty_table(spark, tmp_path):
    frame = spark.createDataFrame([], "a string, chunk int")
    frame.write.partitionBy("chunk").parquet(f"{tmp_path}/out")
    assert readers.read_batches(spark, [f"{tmp_path}/out"], frame.schema).collect() == []


def test_csv_inputs_are_split_and_found_by_their_ending(spark, tmp_path):
    rows = spark.range(40_000).selectExpr("string(id) AccountNumber", "'2024-01-01' Date", "string(id) TransactionNumber")
    rows.coalesce(1).write.option("header", True).csv(f"{tmp_path}/m.csv")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        read = readers.read_mappings(spark, f"{tmp_path}/m.csv")
        assert read.rdd.getNumPartitions() > 5 and read.count() == 40_000
        numbered = sequence.sequence_from_files(read).orderBy("seq").select("AccountNumber").collect()
        assert [int(r[0]) for r in numbered] == list(range(40_000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    rows.limit(5).coalesce(1).write.option("header", True).option("sep", "\t").option("compression", "gzip").csv(f"{tmp_path}/m.tsv")
    assert readers.read_mappings(spark, f"{tmp_path}/m.tsv").count() == 5
    rows.limit(5).write.option("header", True).csv(f"{tmp_path}/folder")
    assert readers.read_mappings(spark, f"{tmp_path}/folder", "csv").count() == 5
