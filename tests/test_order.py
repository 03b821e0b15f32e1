"""Sorted results lie in order, in Spark and in the written report; lists in parts are the lists."""

import duckdb
import pytest

import __spark_entry__ as entry
from ledgerline.operators import rollup
from ledgerline.operators.order import order_breaks
from ledgerline.operators.skew import Split
from ledgerline.sources import readers
from tests.conftest import SF_SMALL

SORTED = {
    "tally_per_transaction_sorted": ["account_number", "seq"],
    "tally_report_sorted": ["account_number", "dates", "seq"],
    "account_rollup_sorted": ["account_number", "customer_name"],
}


@pytest.mark.parametrize("name", SORTED)
def test_sorted_results_have_the_order_of_the_oracle(spark, name):
    con = duckdb.connect()
    for t in ("customer", "orders"):
        con.execute(f"create view {t} as select * from '{SF_SMALL}/{t}.parquet'")
    keys = SORTED[name]
    want = con.execute(f"select {', '.join(keys)} from ({entry.oracle_sql()[name]})").fetchall()
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        result = entry.queries()[name](spark, SF_SMALL)
        assert order_breaks(result, keys).count() == 0
        assert [tuple(r) for r in result.select(*keys).collect()] == want
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_breaks_are_found_within_and_between_partitions(spark):
    rows = spark.createDataFrame([(x,) for x in (1, 2, 3, 4, None, 5, 6, 7, 0, 9)], "x int").coalesce(1)
    assert [(r.previous._v_x, r.place._v_x) for r in order_breaks(rows, ["x"]).collect()] == [(None, 5), (7, 0)]
    parts = spark.sparkContext.parallelize([1, 2, 3, 3, 2, 9], 3).map(lambda x: (x,)).toDF("x int")
    assert [(r.previous._v_x, r.place._v_x) for r in order_breaks(parts, ["x"]).collect()] == [(3, 2)]
    assert order_breaks(spark.createDataFrame([], "x int"), ["x"]).count() == 0


def test_report_of_many_parts_is_read_back_in_order(spark, tmp_path):
    rows = spark.range(0, 5000, 1, 8).selectExpr("concat(id * 7919 % 5000, '\\nline') name", "id * 7919 % 5000 n")
    result = rows.repartition(7).orderBy("n")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        readers.write_report_csv(result, str(tmp_path / "r"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    back = readers.read_report_csv(spark, str(tmp_path / "r"), "row")
    assert len(back.inputFiles()) > 4
    assert [(int(r.n), r.name) for r in back.orderBy("row").collect()] == [(i, f"{i}\nline") for i in range(5000)]


@pytest.mark.parametrize("span,chars", [(Split(4, 3), 10), (Split(1 << 22), 25), (Split(2, 1), 1)])
def test_parts_put_together_are_the_list(spark, span, chars):
    rows = [(a, n, f"n{i}" * (1 + i % 4) if i % 5 else None, i) for i in range(60) for a, n in ((("HOT", "x") if i % 3 else ("b", None)),)]
    frame = spark.createDataFrame([*rows, (None, "y", "z" * 90, 99)], "account_number string, customer_name string, transaction_nos string, seq long").repartition(3)
    parts = rollup.list_parts(frame, "transaction_nos", chars, span).collect()
    longest = max(len(t or "") for *_, t, _ in rows)
    assert all(len(r.text) <= chars + max(longest, 90) and r["list"] == "transaction_nos" for r in parts)
    got = {}
    for r in sorted(parts, key=lambda r: r.part):
        got.setdefault((r.account_number, r.customer_name), []).append(r.text)
    want = {}
    for a, n, t, _ in [*rows, (None, "y", "z" * 90, 99)]:
        if t is not None:
            want.setdefault((a, n), []).append(t)
    assert {k: "\n".join(v) for k, v in got.items()} == {k: "\n".join(v) for k, v in want.items()}
