"""CSV inputs with line breaks and quotes inside values, date layouts, and counts made while reading."""

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import prepare
from ledgerline.plans import jobs
from ledgerline.sources import readers
from tests.helpers import LEDGER_SCHEMA


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


NAMES = "CustomerName,AccountNumber,Amount\n"


def test_line_breaks_inside_quotes(spark, tmp_path):
    path = put(tmp_path / "c.csv", NAMES + '"Ann\nLee",007,1.5\n"say ""hi"", ok",8,2\n"a, b",9,3\n')
    rows = readers.read_customers(spark, path).collect()
    assert [(r.CustomerName, r.AccountNumber) for r in rows] == [("Ann\nLee", "007"), ('say "hi", ok', "8"), ("a, b", "9")]
    assert [(r.file.rpartition("/")[2], r.lines) for r in readers.broken_lines(spark, path).collect()] == [("c.csv", 2)]
    assert readers.read_customers(spark, path, multi_line=False).count() == 4  # by request only


def test_clean_files_stay_split_and_broken_ones_do_not(spark, tmp_path):
    clean = put(tmp_path / "clean.csv", NAMES + "".join(f'"Name ""{i}"" x",{i},{i}.5\n' for i in range(30_000)))
    broken = put(tmp_path / "broken.csv", NAMES + "".join(f'"Name\n{i}",{i},{i}.5\n' for i in range(3_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "60000")
    try:
        rows = readers.read_customers(spark, clean)
        assert rows.rdd.getNumPartitions() > 5 and rows.where("CustomerName like 'Name \"%\" x'").count() == 30_000
        rows = readers.read_customers(spark, broken)
        assert rows.rdd.getNumPartitions() == 1 and rows.where("CustomerName like 'Name\n%'").count() == 3_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_paths_without_telling_endings(spark, tmp_path):
    assert readers.read_customers(spark, put(tmp_path / "x.dat", NAMES + "A,1,2\n")).collect()[0].CustomerName == "A"
    put(tmp_path / "folder" / "part-0", NAMES + "A,1,2\n")
    assert readers.read_customers(spark, str(tmp_path / "folder")).count() == 1
    spark.createDataFrame([("A", "1", "2")], "CustomerName string, AccountNumber string, Amount string").write.parquet(str(tmp_path / "stored"))
    assert readers.read_customers(spark, str(tmp_path / "stored")).count() == 1
    with pytest.raises(ValueError, match="missing columns"):
        readers.read_ledger(spark, str(tmp_path / "x.dat"))


LEDGER = "AccountNumber,Date,Type,Amount,TransactionNumber,OpeningBalance,ClosingBalance\n"


def test_options_reach_the_job(spark, tmp_path):
    led = put(tmp_path / "led" / "part", LEDGER + '1,05.02.2024,DR,10,"n\n1",0,0\n1,2024/02/06,CR,10,,0,0\n1,7 Feb 2024,DR,x,n2,0,0\n')
    cust = put(tmp_path / "cust.dat", NAMES + "A,1,2\n")
    out = jobs.run_pipeline(spark, cust, str(tmp_path / "led"), str(tmp_path / "out"), options=jobs.TallyOptions(include_dates=True, include_credit=True),
                            layouts=("dd.MM.yyyy", "d MMM yyyy", "yyyy/MM/dd"))
    rows = readers.read_report_csv(spark, out).collect()
    assert [(r.transaction_nos, r.dates, r.total_credit) for r in rows] == [("n\n1", "2024-02-05", "10.00")] and led


def test_rows_and_unread_values_are_counted_while_reading(spark):
    dates = ["2024-01-02", "2024/01/03", "04.01.2024", "5 Jan 2024", "soon", "", None, "2024-13-01", " 2024-01-09 "]
    amounts = ["1", "1.5d", "x", None, "", "NaN", "2e3", "-4", "1,000"]
    raw = spark.createDataFrame([("A", d, "DR", a, f"n{i}", "0", "?", i) for i, (d, a) in enumerate(zip(dates, amounts, strict=True))], LEDGER_SCHEMA)
    for layouts, want in ((("yyyy/MM/dd",), 4), (("yyyy/MM/dd", "dd.MM.yyyy", "d MMM yyyy"), 2)):
        rows, seen = prepare.observed(raw.repartition(3), layouts)
        ready = prepare.prepare_ledger(rows, layouts=layouts).collect()  # the one pass
        assert seen.get == {"rows": 9, "unread_Date": want, "unread_Amount": 3, "unread_OpeningBalance": 0, "unread_ClosingBalance": 9}
        assert sum(r.date is None for r in ready) == want + 2


def test_observation_of_a_table_without_rows(spark):
    rows, seen = prepare.observed(spark.createDataFrame([], LEDGER_SCHEMA))
    assert rows.select(F.col("seq")).collect() == [] and seen.get["rows"] == 0 and seen.get["unread_Date"] == 0
