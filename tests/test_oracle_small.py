"""Registered queries against their DuckDB oracle on the smallest test data."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

CHEAP = [
    "accounts_prepared",
    "ledger_prepared",
    "ledger_row_count",
    "pair_next_credit_bucketed",
    "pair_classes_backward",
    "tally_per_transaction",
    "report_projection",
    "account_activity",
    "account_rollup",
    "account_rollup_boundary",
    "account_rollup_fine_buckets",
    "ledger_slice",
    "extract_txn_number",
    "batches_combined",
]


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("customer", "orders"):
        con.execute(f"create view {t} as select * from read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    return con


def test_every_query_has_oracle_or_is_listed():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", CHEAP)
def test_query_matches_duckdb(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    res = duck.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows([tuple(r) for r in df.collect()], df.columns) == _rows(res.fetchall(), ocols)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 1287
