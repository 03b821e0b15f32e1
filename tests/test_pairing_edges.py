"""Edge rows of FIXTURES.md section 5, through the public operators."""

import math

import pytest

from ledgerline.operators import activity, pairing, tally
from ledgerline.operators.prepare import prepare_customers, prepare_ledger, prepare_mappings
from tests.helpers import customers, ledger, mappings


def _run(spark, rows, span=None, cust=None, maps=None, **kw):
    led = prepare_ledger(ledger(spark, rows, **kw))
    cus = prepare_customers(cust if cust is not None else customers(spark))
    mp = prepare_mappings(maps if maps is not None else mappings(spark))
    per_txn = tally.tally_per_transaction(led, cus, mp, span=span).orderBy("seq").collect()
    per_acc = activity.account_activity(led, cus, mp, span=span).orderBy("seq").collect()
    return per_txn, per_acc


SPANS = [None, 1, 2, 1 << 22]


@pytest.mark.parametrize("span", SPANS)
def test_two_pairs_own_credit(spark, span):
    t, a = _run(spark, [("DR", "100", "n1"), ("CR", "100", None), ("DR", "200", "n2"), ("CR", "200", None)], span)
    assert [r.total_credit for r in t] == [100.0, 200.0]
    assert [r.total_credit for r in a] == [100.0, 200.0]
    assert [r.transaction_nos for r in a] == ["n1", "n2"]


@pytest.mark.parametrize("span", SPANS)
def test_unequal_credit_is_unpaired(spark, span):
    t, _ = _run(spark, [("DR", "100", "n1"), ("CR", "99.99", None)], span)
    assert len(t) == 1 and t[0].total_credit == 0.0 and t[0].credit_count == 1 and t[0].debit_count == 1


@pytest.mark.parametrize("span", SPANS)
def test_only_adjacent_debit_pairs(spark, span):
    t, _ = _run(spark, [("DR", "100", "n1"), ("DR", "100", "n2"), ("CR", "100", None)], span)
    assert [(r.transaction_nos, r.total_credit) for r in t] == [("n1", 0.0), ("n2", 100.0)]


@pytest.mark.parametrize("number", [None, ""])
def test_unnumbered_debit_has_no_pair(spark, number):
    t, a = _run(spark, [("DR", "100", number), ("CR", "100", "n9")])
    assert t == []
    assert [(r.transaction_nos, r.total_debit, r.total_credit) for r in a] == [("n9", 0.0, 100.0)]


@pytest.mark.parametrize("span", SPANS)
def test_other_account_in_between(spark, span):
    rows = [("A1", "DR", "100", "n1"), ("B2", "DR", "5", "m1"), ("A1", "CR", "100", None)]
    t, a = _run(spark, rows, span)
    a1 = [r for r in t if r.account_number == "A1"]
    assert [(r.transaction_nos, r.total_credit) for r in a1] == [("n1", 100.0)]
    assert sorted(r.transaction_nos for r in a) == ["m1", "n1"]


def test_non_positive_bad_and_lowercase_debits(spark):
    rows = [("DR", "0", "n1"), ("DR", "-5", "n2"), ("DR", "abc", "n3"), ("dr", "7", "n4"), ("XX", "3", "n5")]
    t, a = _run(spark, rows)
    assert t == []
    assert [(r.transaction_nos, r.total_debit, r.total_credit) for r in a] == [
        ("n1", 0.0, 0.0),
        ("n2", -5.0, 0.0),
        ("n3", 0.0, 0.0),
        ("n4", 0.0, 0.0),
        ("n5", 0.0, 0.0),
    ]


def test_nan_pairs_with_nan(spark):
    t, _ = _run(spark, [("DR", "NaN", "n1"), ("CR", "NaN", None)])
    assert len(t) == 1 and math.isnan(t[0].total_credit)


def test_null_account_pairs_without_customer(spark):
    t, _ = _run(spark, [(None, "DR", "10", "n1"), (None, "CR", "10", None)])
    assert len(t) == 1 and t[0].total_credit == 10.0 and t[0].customer_name is None


def test_duplicate_customer_gives_two_rows(spark):
    cus = customers(spark, [("Alice", "A1", "1"), ("Alice-2", "A1", "2")])
    t, _ = _run(spark, [("DR", "100", "n1"), ("CR", "100", None)], cust=cus)
    assert sorted(r.customer_name for r in t) == ["Alice", "Alice-2"]


def test_mapping_date_and_fallback(spark):
    maps = mappings(spark, [("A1", "2030-05-06", "n1"), ("A1", None, "n2")])
    t, _ = _run(spark, [("DR", "1", "n1"), ("DR", "2", "n2"), ("DR", "3", "n3")], maps=maps)
    assert [r.dates for r in t] == ["2030-05-06", "2024-01-02", "2024-01-03"]


def test_half_cent_rounding(spark):
    t, _ = _run(spark, [("DR", "0.0001", "n1")], opening="1.005")
    assert t[0].opening_balance == 1.0


def test_empty_ledger_full_schema(spark):
    t_df = tally.tally_per_transaction(
        prepare_ledger(ledger(spark, [])), prepare_customers(customers(spark)), None
    )
    assert t_df.count() == 0
    assert t_df.columns[:11] == list(tally.RESULT_COLUMNS)


def test_forward_and_backward_give_same_pairs(spark):
    rows = [("DR", "100", "n1"), ("CR", "100", None), ("DR", "5", None), ("CR", "5", None), ("DR", "7", "x")]
    led = prepare_ledger(ledger(spark, rows))
    fwd = pairing.classify_forward(led, span=2).where("pair_type = 'DR_with_paired_CR'").count()
    bwd = pairing.classify_backward(led, span=2).where("pair_type = 'CR_paired'").count()
    assert fwd == bwd == 1


@pytest.mark.parametrize("span", [1, 2, 1 << 22])
def test_shifted_mode_moves_credit_up(spark, span):
    rows = [("DR", "100", "n1"), ("CR", "100", None), ("DR", "200", "n2"), ("CR", "200", None)]
    led = prepare_ledger(ledger(spark, rows))
    out = activity.account_activity_shifted(led, prepare_customers(customers(spark)), None, span=span)
    assert [r.total_credit for r in out.orderBy("seq").collect()] == [200.0, 0.0]


def test_cents_money_pairs_sub_cent_noise(spark):
    rows = [("DR", "0.30000000000000004", "n1"), ("CR", "0.3", None)]
    led_double = prepare_ledger(ledger(spark, rows))
    led_cents = prepare_ledger(ledger(spark, rows), money="cents")
    cus = prepare_customers(customers(spark))
    assert tally.tally_per_transaction(led_double, cus).first().total_credit == 0.0
    assert tally.tally_per_transaction(led_cents, cus).first().total_credit == 0.3


def test_empty_ledger_per_account_forms(spark):
    from ledgerline.operators import rollup

    led = prepare_ledger(ledger(spark, []))
    cus = prepare_customers(customers(spark))
    acts = activity.account_activity(led, cus, None)
    rolled = rollup.account_rollup(acts)
    shifted = activity.account_activity_shifted(led, cus, None)
    assert acts.count() == 0 and rolled.count() == 0 and shifted.count() == 0
    assert rolled.columns[:3] == ["account_number", "customer_name", "transaction_nos"]
    assert "tally_value" in rolled.columns and "closing_balance" in shifted.columns
