"""One shuffle of the ledger where no side table is broadcast; hot accounts in a branch of their own."""

import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import has_number
from ledgerline.operators import skew
from ledgerline.operators.activity import account_activity, kept_rows
from ledgerline.operators.copartition import pair_and_enrich
from ledgerline.operators.enrich import add_customer, add_mapped_date
from ledgerline.operators.pairing import numbered_debit, paired_debits
from ledgerline.operators.prepare import prepare_customers, prepare_ledger, prepare_mappings
from ledgerline.operators.prune import key_filter, matching_mappings, may_match
from ledgerline.operators.skew import Split
from ledgerline.operators.tally import tally_per_transaction
from tests.helpers import customers, ledger, mappings


@pytest.fixture
def no_broadcast(spark):
    """Side tables too large to broadcast, and the setting that clusters have (``recommended_conf``)."""
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.requireAllClusterKeysForCoPartition": "false"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def inputs(spark, seed=1, n=600):
    """A third of the rows on one account, a third on none; customers twice, mapped numbers twice, a large account of the mapping."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        account = ("HOT", None, f"A{rng.randrange(30)}")[i % 3]
        rows.append((account, rng.choice(["DR", "CR"]), str(rng.randrange(1, 4)), rng.choice([None, "", *(f"N{k}" for k in range(12))])))
    who = [(f"c{k}", a, str(k)) for k, a in enumerate(["HOT", "HOT", None, "A1", "A1", *(f"A{k}" for k in range(2, 25)), "nobody"])]
    dated = [("HOT", f"2024-02-{k + 1:02d}", f"N{k % 9}") for k in range(14)] + [(None, "2024-03-01", "N1"), ("A3", "2024-03-02", None)]
    dated += [(f"A{k}", "2024-04-01", f"N{k % 12}") for k in range(40)] + [("A5", "2024-05-01", f"N{k}") for k in range(200)]
    return (
        prepare_ledger(ledger(spark, rows)),
        prepare_customers(customers(spark, who)),
        prepare_mappings(mappings(spark, dated)),
    )


def same(x, y):
    columns = sorted(x.columns)
    assert columns == sorted(y.columns)
    assert sorted(map(repr, x.select(columns).collect())) == sorted(map(repr, y.select(columns).collect()))


@pytest.mark.parametrize("pair", [paired_debits, kept_rows])
@pytest.mark.parametrize("split", [Split(40, 25), Split(1, 0), Split(7, 100), 1 << 22])
def test_branches_equal_one_plain_window_and_two_joins(spark, no_broadcast, pair, split):
    led, cust, mapped = inputs(spark)
    plain = add_mapped_date(add_customer(pair(led, None), cust), mapped)
    same(pair_and_enrich(led, cust, mapped, pair, split), plain)
    same(pair_and_enrich(led, cust, None, pair, split), add_mapped_date(add_customer(pair(led, None), cust), None))


@pytest.mark.parametrize("empty", ["ledger", "customers", "mappings"])
def test_empty_inputs(spark, empty):
    led, cust, mapped = (x.where("false") if name == empty else x for name, x in zip(("ledger", "customers", "mappings"), inputs(spark, 2, 90), strict=True))
    for form in (tally_per_transaction, account_activity):
        same(form(led, cust, mapped, Split(40, 25), prune_mapping=True), form(led, cust, mapped, None))


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def ledger_exchanges(plan):
    """Exchanges of rows that hold the arrival order, by the columns of the first node below, but for joins, that names any; not of aggregates."""
    lines = plan.splitlines()
    at = [i for i, x in enumerate(lines) if re.search(r"\bExchange hash", x)]
    below = {i: next(x for x in lines[i + 1 :] if re.search(r"\[.*#", x) and "Join" not in x) for i in at}
    return [lines[i] for i in at if re.search(r"[ ,\[]seq#", below[i]) and "Aggregate" not in below[i]]


@pytest.mark.parametrize("form", [tally_per_transaction, account_activity])
def test_the_ledger_is_shuffled_once(spark, no_broadcast, tmp_path, monkeypatch, form):
    for name, x in zip(("l", "c", "m"), inputs(spark), strict=True):
        x.write.parquet(str(tmp_path / name))
    led, cust, mapped = (spark.read.parquet(str(tmp_path / x)) for x in "lcm")
    plan = executed(form(led, cust, mapped))
    found = ledger_exchanges(plan)
    assert len(found) == 1 and re.search(r"hashpartitioning\(account_number#\d+, \d+\)", found[0])
    assert plan.count("SortMergeJoin") == 2 and "BroadcastHashJoin" not in plan
    # The table of hot accounts is broadcast where its bound is small, as with the default split.
    monkeypatch.setattr(skew, "BROADCAST_MIN_THRESHOLD", 100)
    # With hot accounts: their rows by account and bucket, and those kept once more by account and number.
    found = ledger_exchanges(executed(form(led, cust, mapped, Split(1 << 20, 100))))
    kinds = sorted(re.search(r"hashpartitioning\((.*?), \d+\)", re.sub(r"#\d+L?", "", x)).group(1) for x in found)
    assert kinds == ["account_number", "account_number, _sk_bucket", "account_number, ledger_txn_no"]


def test_mapping_is_pruned_before_its_shuffle(spark, no_broadcast, tmp_path):
    led, cust, mapped = inputs(spark)
    large = mapped.unionByName(
        spark.range(20_000).select(
            F.concat(F.lit("A"), F.col("id") % 40).alias("account_number"), F.lit(None).cast("date").alias("txn_date"),
            F.concat(F.lit("X"), "id").alias("transaction_number"),
        ).select(*mapped.columns)
    )
    large.write.parquet(str(tmp_path / "m"))
    large = spark.read.parquet(str(tmp_path / "m"))
    few = matching_mappings(large, led.where(numbered_debit()))
    wanted = {(r.account_number, r.ledger_txn_no) for r in led.where(numbered_debit()).collect()}
    kept = few.collect()
    every = [r for r in large.collect() if (r.account_number, r.transaction_number) in wanted and r.account_number]
    assert not {repr(r) for r in every} - {repr(r) for r in kept}
    assert len(kept) <= len(every) + 20 and few.columns == large.columns
    for form in (tally_per_transaction, account_activity):
        same(form(led, cust, large, prune_mapping=True), form(led, cust, large))
    plan = executed(tally_per_transaction(led, cust, large, prune_mapping=True))
    # The filter's join is below the exchange of the mapping.
    below = plan[plan.index("hashpartitioning(_m_account") :]
    assert "BroadcastHashJoin [_bf_block" in below and "getbit" in below


@pytest.mark.parametrize("blocks", [1, 8, 1 << 13])
def test_filter_keeps_every_key_and_few_others(spark, blocks):
    keys = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("x"), (F.col("id") % 7).alias("y"))
    repeated = keys.unionAll(keys).unionAll(spark.sql("select cast(null as string) x, 1L y"))
    made = key_filter(repeated, "x", "y", blocks=blocks)
    assert made.count() <= blocks and made.agg(F.max(F.octet_length("_bf_bits"))).first()[0] == 4096
    assert may_match(repeated, made, "x", "y", blocks=blocks).count() == 6000
    others = spark.range(20_000).select(F.concat(F.lit("o"), "id").alias("x"), F.lit(1).cast("long").alias("y"))
    passed = may_match(others, made, "x", "y", blocks=blocks).count()
    # Three of 32,768 bits a key: 1 - exp(-9000 / 32768 / blocks), cubed.
    assert passed <= 20_000 * (0.25 if blocks == 1 else 0.012) ** (3 if blocks == 1 else 1) + 40
    assert may_match(others, key_filter(keys.where("false"), "x", "y", blocks=blocks), "x", "y", blocks=blocks).count() == 0


def test_kept_rows_have_numbers(spark):
    led, _, _ = inputs(spark)
    assert kept_rows(led).where(~has_number("ledger_txn_no")).count() == 0
