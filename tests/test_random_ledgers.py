"""Random interleaved ledgers against a per-account Python loop (the survey's generated-data oracle),
and invariance of results under input partitioning and shuffle partition count."""

import random

import pytest

from ledgerline.operators import activity, tally
from ledgerline.operators.prepare import prepare_customers, prepare_ledger
from tests.helpers import customers, ledger


def _random_rows(seed, n=300):
    rnd = random.Random(seed)
    accounts = ["HOT"] * 5 + ["A", "B", "C"]
    rows = []
    for i in range(n):
        acct = rnd.choice(accounts)
        ty = rnd.choice(["DR", "DR", "CR", "CR", "XX"])
        amt = rnd.choice(["10", "10", "20", "7.5", "0", "-3", "abc"])
        no = rnd.choice([None, "", f"N{i}", f"N{i}"])
        rows.append((acct, ty, amt, no))
    return rows


def _loop_oracle(rows):
    """Per-account adjacent pairing, written as a plain loop over each account's rows."""
    def num(a):
        try:
            return float(a)
        except (TypeError, ValueError):
            return 0.0

    by_acct = {}
    for seq, (acct, ty, amt, no) in enumerate(rows, start=1):
        by_acct.setdefault(acct, []).append((seq, ty, num(amt), no))
    per_txn, per_acc = {}, {}
    for items in by_acct.values():
        debit = [a if ty == "DR" else 0.0 for _, ty, a, _ in items]
        credit = [a if ty == "CR" else 0.0 for _, ty, a, _ in items]
        numbered = [no not in (None, "") for *_, no in items]
        paired = [
            numbered[i] and debit[i] > 0 and i + 1 < len(items) and credit[i + 1] == debit[i]
            for i in range(len(items))
        ]
        for i, (seq, _, _, no) in enumerate(items):
            if numbered[i] and debit[i] > 0:
                per_txn[seq] = (debit[i], credit[i + 1] if paired[i] else 0.0)
            cr_paired = i > 0 and paired[i - 1]
            if numbered[i] and not cr_paired:
                per_acc[seq] = (debit[i], credit[i + 1] if paired[i] else credit[i])
    return per_txn, per_acc


@pytest.mark.parametrize("seed", [11, 12, 13])
@pytest.mark.parametrize("span", [None, 2, 16, 1 << 22])
def test_random_ledger_against_loop(spark, seed, span):
    rows = _random_rows(seed)
    led = prepare_ledger(ledger(spark, rows))
    cus = prepare_customers(customers(spark, [("Hot Co", "HOT", "1"), ("A Co", "A", "2")]))
    want_txn, want_acc = _loop_oracle(rows)
    got_txn = {r.seq: (r.total_debit, r.total_credit) for r in tally.tally_per_transaction(led, cus, None, span).collect()}
    got_acc = {r.seq: (r.total_debit, r.total_credit) for r in activity.account_activity(led, cus, None, span).collect()}
    assert got_txn == want_txn
    assert got_acc == want_acc


def test_unchanged_by_partitioning(spark):
    rows = _random_rows(21, 400)
    raw = ledger(spark, rows)
    cus = prepare_customers(customers(spark, [("Hot Co", "HOT", "1")]))

    def result(df, parts):
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        try:
            return sorted(tuple(r) for r in tally.tally_per_transaction(prepare_ledger(df), cus, None, 8).collect())
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", old)

    base = result(raw, 8)
    assert result(raw.repartition(7), 3) == base
    assert result(raw.repartition(1), 13) == base
    assert result(raw.orderBy("seq", ascending=False), 5) == base
