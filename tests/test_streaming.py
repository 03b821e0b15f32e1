"""The stream, fed file by file, against the batch: whole results, late rows, timers, restarts, retried batches."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.pairing import classify_forward
from ledgerline.operators.prepare import prepare_customers, prepare_ledger, prepare_mappings
from ledgerline.operators.skew import Split
from ledgerline.operators.tally import tally_per_transaction
from ledgerline.session import scratch_path
from ledgerline.sources import fixtures
from ledgerline.streaming import pairing as streaming
from tests.conftest import SF_SMALL
from tests.helpers import customers, ledger, mappings

RESULT = ["account_number", "seq", "pair_type", "next_credit"]


def arrive(spark, base, raw, condition):
    """One file of the rows that fulfil ``condition``, after those already there."""
    raw.where(condition).coalesce(1).write.mode("append").parquet(f"{base}/in")


def run(spark, base, raw, start=streaming.start_pairing, *args, carry=(), **options):
    stream = streaming.ledger_file_stream(spark, f"{base}/in", raw.schema, files_per_trigger=1)
    query = start(prepare_ledger(stream, carry=carry), f"{base}/out", *args, **options)
    query.awaitTermination()
    assert query.exception() is None
    return f"{base}/out"


def same(got, want):
    got, want = sorted(map(tuple, got.collect()), key=str), sorted(map(tuple, want.collect()), key=str)
    assert got == want


def test_whole_ledger_equals_batch(spark):
    base = scratch_path(spark, "t-stream")
    schema = fixtures.ledger_arrivals(spark, SF_SMALL, f"{base}/in", 3)
    raw = spark.read.schema(schema).parquet(f"{base}/in")
    out = run(spark, base, raw, compact_every=2)
    same(streaming.all_rows(spark, out).select(RESULT), classify_forward(prepare_ledger(raw)).select(RESULT))
    assert streaming.late_rows(spark, out).count() == 0
    assert streaming.pending_rows(spark, out).count() == raw.select("AccountNumber").distinct().count()


@pytest.mark.parametrize("compact_every", [1, 2, 16])
def test_pair_over_arrivals_restarts_and_compaction(spark, compact_every):
    raw = ledger(spark, [("DR", "100", "n1"), ("CR", "100", None), ("DR", "5", "n2"), ("CR", "1", None), ("DR", "7", "n3"), ("CR", "7", None)])
    base = scratch_path(spark, "t-stream2")
    for seq in range(1, 7):  # each arrival by a query of its own, from the checkpoint
        arrive(spark, base, raw, f"seq = {seq}")
        out = run(spark, base, raw, compact_every=compact_every)
    assert streaming.committed(spark, out) == 5
    assert {r.seq: (r.pair_type, r.next_credit) for r in streaming.resolved_rows(spark, out).collect()} == {
        1: ("DR_with_paired_CR", 100.0), 2: ("CR_transaction", 0.0), 3: ("DR_unpaired", 1.0), 4: ("CR_transaction", 0.0), 5: ("DR_with_paired_CR", 7.0),
    }
    assert [r.seq for r in streaming.pending_rows(spark, out).collect()] == [6]


def test_late_rows_have_an_output_of_their_own(spark):
    rows = [("A", "DR", "100", "n1"), ("A", "DR", "9", "n2"), ("A", "CR", "100", None), ("B", "DR", "1", "m1"), (None, "DR", "2", "k"), (None, "CR", "2", None)]
    raw = ledger(spark, rows)
    base = scratch_path(spark, "t-late")
    for condition in ("seq in (1, 3, 5)", "seq in (2, 4)", "seq = 6"):
        arrive(spark, base, raw, condition)
    out = run(spark, base, raw, start=streaming.start_tally, customers=prepare_customers(customers(spark)), mappings=prepare_mappings(mappings(spark)))
    late = streaming.late_rows(spark, out).collect()
    assert [(r.seq, r.pair_type, r.next_credit) for r in late] == [(2, "DR_unpaired", None)]
    whole = streaming.all_rows(spark, out)
    assert sorted(r.seq for r in whole.collect()) == [1, 2, 3, 4, 5, 6]
    kinds = {r.seq: r.pair_type for r in whole.collect()}
    assert kinds[1] == "DR_with_paired_CR" and kinds[5] == "DR_with_paired_CR" and kinds[4] == "DR_unpaired"
    tally = streaming.all_tally(spark, out, prepare_customers(customers(spark)), None)
    assert {(r.seq, r.late) for r in tally.collect()} == {(1, False), (2, True), (4, False), (5, False)}


def test_retried_batch_replaces_what_it_wrote(spark):
    raw = ledger(spark, [("DR", "100", "n1"), ("CR", "100", None), ("DR", "5", "n2")])
    base = scratch_path(spark, "t-retry")
    step = streaming.MicroBatches(f"{base}/out", compact_every=2)
    rows = streaming._rows(prepare_ledger(raw))
    step(rows.where("seq = 1"), 0)
    for _ in range(2):  # an attempt that was lost after writing, and its repetition
        step(rows.where("seq = 2"), 1)
    step(rows.where("seq = 3"), 2)
    assert streaming.committed(spark, f"{base}/out") == -1  # nothing is committed outside a query
    assert streaming.all_rows(spark, f"{base}/out").count() == 0
    written = spark.read.parquet(f"{base}/out/rows")
    assert sorted((r.seq, r.batch) for r in written.where("kind = 'resolved'").collect()) == [(1, 1), (2, 2)]
    assert [(r.seq, r.kind) for r in step.state(spark, 3).collect()] == [(3, "pending")]


def test_event_time_timer_resolves_a_silent_account(spark):
    rows = [("A", "DR", "100", "n1"), ("B", "DR", "5", "m1"), ("B", "CR", "5", None), ("A", "CR", "100", None), ("A", "DR", "1", "n0")]
    raw = ledger(spark, rows).withColumn("arrived_at", F.timestamp_seconds(F.col("seq") * 100))
    base = scratch_path(spark, "t-timer")
    for condition in ("seq = 1", "seq in (2, 3)", "seq = 4"):
        arrive(spark, base, raw, condition)
    out = run(spark, base, raw, carry=("arrived_at",), timeout_s=150)
    got = {r.seq: (r.pair_type, r.next_credit) for r in streaming.resolved_rows(spark, out).collect()}
    # A is silent while B's rows move the watermark on to 300: its row of 100 is resolved, its credit of 400 comes too late for it.
    assert got == {1: ("DR_unpaired", None), 2: ("DR_with_paired_CR", 5.0)}
    assert {r.seq for r in streaming.pending_rows(spark, out).collect()} == {3, 4}
    delayed = scratch_path(spark, "t-timer-delay")
    for condition in ("seq = 1", "seq in (2, 3)", "seq = 4"):
        arrive(spark, delayed, raw, condition)
    out = run(spark, delayed, raw, carry=("arrived_at",), timeout_s=150, delay_s=100)
    assert {r.seq: r.pair_type for r in streaming.resolved_rows(spark, out).collect()}[1] == "DR_with_paired_CR"


def test_rows_before_a_closed_place_are_late(spark):
    raw = ledger(spark, [("A", "DR", "100", "n1"), ("A", "DR", "3", "n2"), ("B", "DR", "5", "m1"), ("A", "CR", "3", None)])
    raw = raw.withColumn("arrived_at", F.timestamp_seconds(F.col("seq") * 100))
    base = scratch_path(spark, "t-closed")
    for condition in ("seq = 2", "seq = 3", "seq in (1, 4)"):
        arrive(spark, base, raw, condition)
    out = run(spark, base, raw, carry=("arrived_at",), timeout_s=50)
    rows = {r.seq: (r.pair_type, r.late) for r in streaming.all_rows(spark, out).collect()}
    assert rows == {1: ("DR_unpaired", True), 2: ("DR_unpaired", False), 3: ("DR_unpaired", False), 4: ("CR_transaction", False)}


def test_hot_account_is_split_in_a_micro_batch(spark):
    n = 4000
    raw = ledger(spark, [("HOT" if i % 3 else f"a{i % 50}", "CR" if i % 2 else "DR", str(10 + i // 2 % 7), f"n{i}") for i in range(n)])
    base = scratch_path(spark, "t-hot")
    for k in range(3):
        arrive(spark, base, raw, f"seq div {n // 3 + 1} = {k}")
    out = run(spark, base, raw, span=Split(span=64, hot_rows=100))
    same(streaming.all_rows(spark, out).select(RESULT), classify_forward(prepare_ledger(raw)).select(RESULT))


def test_tally_equals_batch(spark):
    base = scratch_path(spark, "t-tally")
    schema = fixtures.ledger_arrivals(spark, SF_SMALL, f"{base}/in", 2)
    raw = spark.read.schema(schema).parquet(f"{base}/in")
    own = prepare_customers(fixtures.fixture_customers(spark, SF_SMALL)), prepare_mappings(fixtures.fixture_mappings(spark, SF_SMALL))
    out = run(spark, base, raw, streaming.start_tally, *own)
    want = tally_per_transaction(prepare_ledger(raw), *own)
    same(streaming.all_tally(spark, out, *own).drop("late").select(want.columns), want)


@pytest.mark.parametrize("delayed", [False, True])
def test_an_arrival_of_many_files_is_one_micro_batch(spark, monkeypatch, delayed):
    monkeypatch.setattr(fixtures, "ARRIVAL_FILE_ROWS", 200)
    whole = fixtures.fixture_ledger
    monkeypatch.setattr(fixtures, "fixture_ledger", lambda *a, **k: whole(*a, **k).repartition(6))
    base = scratch_path(spark, "t-files")
    seen, files = [], []

    def take(schema):
        stream = streaming.ledger_file_stream(spark, f"{base}/in", schema)
        query = streaming.start_pairing(prepare_ledger(stream, carry=("arrived_at",)), f"{base}/out")
        query.awaitTermination()
        assert query.exception() is None
        seen.append(streaming.committed(spark, f"{base}/out"))
        files.append(len([f for f in os.listdir(f"{base}/in".removeprefix("file:")) if f.startswith("part-")]))

    schema = fixtures.ledger_arrivals(spark, SF_SMALL, f"{base}/in", 2, delayed, take)
    assert seen == list(range(2 + delayed)) and files[0] > 1 and files[1] > files[0] + 1, (seen, files)
    raw = spark.read.schema(schema).parquet(f"{base}/in")
    got = streaming.all_rows(spark, f"{base}/out")
    assert got.count() == raw.count() == fixtures.fixture_ledger(spark, SF_SMALL).count()
    if not delayed:
        same(got.select(RESULT), classify_forward(prepare_ledger(raw)).select(RESULT))


def test_tally_with_a_kept_mapping(spark):
    raw = ledger(spark, [("A1", "DR", "100", "n1"), ("A1", "CR", "100", None), ("A1", "DR", "5", "n2"), (None, "DR", "7", "n3"), ("A1", "DR", "1", "")])
    base = scratch_path(spark, "t-kept")
    for condition in ("seq in (1, 2)", "seq > 2"):
        arrive(spark, base, raw, condition)
    held = [("A1", "2024-05-01", "n1"), ("A1", "2024-05-02", "n1"), ("A1", "2024-05-03", None), (None, "2024-05-04", "n3"), (None, "2024-05-05", None), ("A1", "2024-05-06", "")]
    own = prepare_customers(customers(spark)), prepare_mappings(mappings(spark, held))
    kept = streaming.kept_mappings(own[1], 3)
    assert kept.is_cached and kept.rdd.getNumPartitions() == 3 and kept.count() == 3
    out = run(spark, base, raw, streaming.start_tally, own[0], kept)
    kept.unpersist()
    want = tally_per_transaction(prepare_ledger(raw), *own)
    assert want.count() == 4
    same(streaming.all_tally(spark, out, *own).drop("late").select(want.columns), want)


def test_nothing_has_run(spark):
    out = scratch_path(spark, "t-none")
    assert streaming.all_rows(spark, out).collect() == [] and not os.path.exists(out)
