"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and their oracle SQL.

Every query reads the driver's tables through the derived inputs, over whole
tables; none returns a fixed small input.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ledgerline.config import DEFAULT_CHUNK_SIZE, REPORT_OPTIONS, TallyOptions
from ledgerline.functions import date_text
from ledgerline.functions import extract_txn_number as extract_number
from ledgerline.operators import activity, enrich, pairing, prepare, prune, report, rollup, sequence, tally
from ledgerline.operators.skew import Split, hot_keys
from ledgerline.plans import jobs, oracle
from ledgerline.plans.inputs import fixture_inputs
from ledgerline.session import scratch_path
from ledgerline.sources import fixtures
from ledgerline.sources import readers
from ledgerline.sources.readers import read_batches, write_batches
from ledgerline.streaming import pairing as streaming

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLE: dict[str, str] = {}

# A deliberately fine split: at test scale it makes most accounts "hot" and cuts
# them over many buckets, so the edge-stitching path of the neighbour lookup
# and the two-stage lists are exercised on the whole test ledger.
FINE_SPAN = Split(span=256, hot_rows=4)
# Positional slices use the reference's default chunk size.
REPORT_CHUNK = DEFAULT_CHUNK_SIZE


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def wrap(fn: Query) -> Query:
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLE[name] = oracle.with_fixtures(sql)
        return fn

    return wrap


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)


# ---- sources and preparation ---------------------------------------------------


@register(
    "accounts_prepared",
    "select account_number, customer_name, customer_amount from acc",
)
def accounts_prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture_inputs(spark, sf_dir).customers


@register(
    "mappings_prepared",
    "select account_number, txn_date, transaction_number from map",
)
def mappings_prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture_inputs(spark, sf_dir).mappings


@register(
    "ledger_prepared",
    """select account_number, date, transaction_type, amount, ledger_txn_no, opening_balance, closing_balance, seq
       from ledger""",
)
def ledger_prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture_inputs(spark, sf_dir).ledger.drop("debit_amount", "credit_amount")


@register(
    "debit_credit_split",
    "select account_number, seq, transaction_type, debit_amount, credit_amount from ledger",
)
def debit_credit_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture_inputs(spark, sf_dir).ledger.select(
        "account_number", "seq", "transaction_type", "debit_amount", "credit_amount"
    )


@register("ledger_row_count", "select cast(count(*) as bigint) row_count from led")
def ledger_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.row_count(fixtures.fixture_ledger(spark, sf_dir))


def _as_csv(spark: SparkSession, rows: DataFrame, name: str) -> str:
    path = f"{scratch_path(spark, name)}/{name}.csv"
    blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.write.options(header=True, quote=readers.QUOTE, escape=readers.QUOTE, **blanks).csv(path)
    return path


@register(
    "customers_from_csv",
    """select account_number, case when account_number like '%1' then concat(customer_name, chr(10), 'of "old"') else customer_name end customer_name,
              customer_amount from acc""",
)
def customers_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers as CSV files and back; some names hold a line break and quotes."""
    name = F.when(F.col("AccountNumber").like("%1"), F.concat("CustomerName", F.lit('\nof "old"'))).otherwise(F.col("CustomerName"))
    path = _as_csv(spark, fixtures.fixture_customers(spark, sf_dir).withColumn("CustomerName", name), "customers")
    return prepare.prepare_customers(readers.read_customers(spark, path))


@register(
    "ledger_from_csv",
    """select account_number, date, transaction_type, amount,
              case when seq % 200 = 2 then ledger_txn_no || chr(10) || '"x", y' else nullif(ledger_txn_no, '') end ledger_txn_no,
              opening_balance, closing_balance, seq from ledger""",
)
def ledger_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger as CSV files and back; some numbers hold a line break, quotes and a comma (empty text is null in CSV)."""
    number = F.when(F.col("seq") % 200 == 2, F.concat("TransactionNumber", F.lit('\n"x", y'))).otherwise(F.col("TransactionNumber"))
    path = _as_csv(spark, fixtures.fixture_ledger(spark, sf_dir).withColumn("TransactionNumber", number), "ledger")
    return prepare.prepare_ledger(readers.read_ledger(spark, path)).drop("debit_amount", "credit_amount")


@register("mappings_from_csv", "select account_number, txn_date, transaction_number from map")
def mappings_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mapping as CSV files and back, read in splits: no value holds a line break."""
    path = _as_csv(spark, fixtures.fixture_mappings(spark, sf_dir), "mappings")
    return prepare.prepare_mappings(readers.read_mappings(spark, path))


@register(
    "ledger_sequence",
    "select account_number, seq, cast(row_number() over (order by seq) as bigint) original_order from ledger",
)
def ledger_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = fixture_inputs(spark, sf_dir).ledger.select("account_number", "seq")
    return sequence.dense_position(led, "seq", "original_order", span=4096)


@register(
    "ledger_sequence_sparse",
    "select account_number, seq * 8388608 seq, cast(row_number() over (order by seq) as bigint) original_order from ledger",
)
def ledger_sequence_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions along an order with a bucket for every row."""
    led = fixture_inputs(spark, sf_dir).ledger.select("account_number", (F.col("seq") * (1 << 23)).alias("seq"))
    return sequence.dense_position(led, "seq", "original_order")


@register(
    "ledger_slice",
    f"""select account_number, seq, original_order, (original_order - 1) // {REPORT_CHUNK} chunk
        from (select account_number, seq, cast(row_number() over (order by seq) as bigint) original_order
              from ledger)""",
)
def ledger_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = fixture_inputs(spark, sf_dir).ledger.select("account_number", "seq")
    return sequence.positional_chunks(led, REPORT_CHUNK).select("account_number", "seq", "original_order", "chunk")


@register(
    "extract_txn_number",
    """select narration_id, nullif(regexp_extract(narration, 'Txn No:\\s*(TXN\\w+)', 1, 'i'), '') txn_number
       from (select o_orderkey narration_id,
                    case when o_orderkey % 7 = 0 then concat('Cash deposit ', cast(o_orderkey as varchar))
                         else concat('Payment, txn no: TXN', cast(o_orderkey as varchar), ' done') end narration
             from orders)""",
)
def extract_txn_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    notes = fixtures.fixture_narrations(spark, sf_dir)
    return notes.select("narration_id", extract_number("narration").alias("txn_number"))


# ---- pairing ------------------------------------------------------------------------


@register(
    "pair_next_credit",
    "select account_number, seq, transaction_type, amount, ledger_txn_no, next_credit from nb",
)
def pair_next_credit(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = fixture_inputs(spark, sf_dir).ledger
    return pairing.with_next_credit(led).select(
        "account_number", "seq", "transaction_type", "amount", "ledger_txn_no", "next_credit"
    )


@register(
    "pair_next_credit_bucketed",
    "select account_number, seq, transaction_type, amount, ledger_txn_no, next_credit from nb",
)
def pair_next_credit_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = fixture_inputs(spark, sf_dir).ledger
    return pairing.with_next_credit(led, span=FINE_SPAN).select(
        "account_number", "seq", "transaction_type", "amount", "ledger_txn_no", "next_credit"
    )


@register(
    "pair_prev_debit",
    "select account_number, seq, prev_debit, prev_txn_no from nb",
)
def pair_prev_debit(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = fixture_inputs(spark, sf_dir).ledger
    return pairing.with_prev_debit(led, keep_number=True).select(
        "account_number", "seq", "prev_debit", "prev_txn_no"
    )


@register(
    "pair_classes_forward",
    "select account_number, seq, forward_type pair_type from cls",
)
def pair_classes_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = fixture_inputs(spark, sf_dir).ledger
    return pairing.classify_forward(led).select("account_number", "seq", "pair_type")


@register(
    "pair_classes_backward",
    "select account_number, seq, pair_type from cls",
)
def pair_classes_backward(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = fixture_inputs(spark, sf_dir).ledger
    return pairing.classify_backward(led).select("account_number", "seq", "pair_type")


# ---- enrichment -----------------------------------------------------------------------


_NUMBERED_DR = "forward_type in ('DR_with_paired_CR', 'DR_unpaired')"


@register(
    "enrich_customer",
    f"""select c.account_number, c.seq, a.customer_name, a.customer_amount
        from cls c left join acc a on c.account_number = a.account_number where {_NUMBERED_DR}""",
)
def enrich_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    inp = fixture_inputs(spark, sf_dir)
    debits = pairing.paired_debits(inp.ledger)
    return enrich.add_customer(debits, inp.customers).select(
        "account_number", "seq", "customer_name", "customer_amount"
    )


@register(
    "enrich_mapped_date",
    f"""select c.account_number, c.seq, c.ledger_txn_no, m.txn_date
        from cls c left join map m on c.account_number = m.account_number and c.ledger_txn_no = m.transaction_number
        where {_NUMBERED_DR}""",
)
def enrich_mapped_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    inp = fixture_inputs(spark, sf_dir)
    debits = pairing.paired_debits(inp.ledger)
    return enrich.add_mapped_date(debits, inp.mappings).select("account_number", "seq", "ledger_txn_no", "txn_date")


@register(
    "enrich_mapped_date_pruned",
    f"""select c.account_number, c.seq, c.ledger_txn_no, m.txn_date
        from cls c left join map m on c.account_number = m.account_number and c.ledger_txn_no = m.transaction_number
        where {_NUMBERED_DR}""",
)
def enrich_mapped_date_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    inp = fixture_inputs(spark, sf_dir)
    wanted = prune.matching_mappings(inp.mappings, inp.ledger.where(pairing.numbered_debit()))
    debits = pairing.paired_debits(inp.ledger)
    return enrich.add_mapped_date(debits, wanted).select("account_number", "seq", "ledger_txn_no", "txn_date")


@register(
    "effective_date",
    f"""select c.account_number, c.seq, cast(coalesce(m.txn_date, c.date) as varchar) dates
        from cls c left join map m on c.account_number = m.account_number and c.ledger_txn_no = m.transaction_number
        where {_NUMBERED_DR}""",
)
def effective_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    inp = fixture_inputs(spark, sf_dir)
    debits = pairing.paired_debits(inp.ledger)
    dated = enrich.effective_date(enrich.add_mapped_date(debits, inp.mappings))
    return dated.select("account_number", "seq", date_text("final_date").alias("dates"))


# ---- per-transaction tally (the flagship) ------------------------------------------------


@register("tally_per_transaction", "select * from per_txn")
def tally_per_transaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    inp = fixture_inputs(spark, sf_dir)
    return tally.tally_per_transaction(inp.ledger, inp.customers, inp.mappings)


@register("tally_per_transaction_split", "select * from per_txn")
def tally_per_transaction_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both branches of the plan at work: accounts of more than 12 rows are hot, in buckets of 2,000 positions."""
    inp = fixture_inputs(spark, sf_dir)
    return tally.tally_per_transaction(inp.ledger, inp.customers, inp.mappings, span=Split(2000, 12), prune_mapping=True)


@register(
    "tally_per_transaction_sorted",
    "select * from per_txn order by account_number nulls last, seq",
)
def tally_per_transaction_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tally.sort_by_ledger_order(tally_per_transaction(spark, sf_dir))


@register(
    "tally_report_sorted",
    "select * from per_txn order by account_number nulls last, dates nulls last, seq",
)
def tally_report_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tally.sort_for_report(tally_per_transaction(spark, sf_dir))


@register(
    "report_projection",
    """select account_number, customer_name, transaction_nos, dates, total_debit, total_credit, opening_balance,
              debit_count, credit_count, tally_value from per_txn""",
)
def report_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.project_report(tally_per_transaction(spark, sf_dir), REPORT_OPTIONS)


@register("batches_combined", "select * from per_txn")
def batches_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results kept per batch (here: the month of their date), then read back from many Parquet folders as one table.

    The tally is computed over the whole ledger, so no pair is lost at a batch edge.
    """
    result = tally_per_transaction(spark, sf_dir)
    batched = result.withColumn("batch", F.substring("dates", 1, 7))
    base = scratch_path(spark, "batches")
    write_batches(batched, "batch", f"{base}/out")
    return read_batches(spark, [f"{base}/out"], batched.schema).select(*result.columns)


# ---- per-account form ---------------------------------------------------------------------


@register("account_activity", "select * from activity")
def account_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    inp = fixture_inputs(spark, sf_dir)
    return activity.account_activity(inp.ledger, inp.customers, inp.mappings)


@register("account_effective_date", "select account_number, seq, dates from activity")
def account_effective_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return account_activity(spark, sf_dir).select("account_number", "seq", "dates")


@register("pair_own_credit", "select account_number, seq, total_credit from activity")
def pair_own_credit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return account_activity(spark, sf_dir).select("account_number", "seq", "total_credit")


def _rollup(spark: SparkSession, sf_dir: str, form: str, balance_mode: str, split: Split) -> DataFrame:
    inp = fixture_inputs(spark, sf_dir)
    if form == "activity":
        rows = activity.account_activity(inp.ledger, inp.customers, inp.mappings, span=split)
    else:
        rows = tally.tally_per_transaction(inp.ledger, inp.customers, inp.mappings, span=split)
    hot = hot_keys(inp.ledger, "account_number", split)
    return rollup.account_rollup(rows, balance_mode, span=split, hot=hot)


@register("account_rollup", oracle.rollup_sql("activity", "minmax"))
def account_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rollup(spark, sf_dir, "activity", "minmax", Split())


@register("account_rollup_boundary", oracle.rollup_sql("activity", "boundary"))
def account_rollup_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rollup(spark, sf_dir, "activity", "boundary", Split())


@register("transaction_rollup", oracle.rollup_sql("per_txn", "minmax"))
def transaction_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rollup(spark, sf_dir, "per_txn", "minmax", Split())


ACCOUNT_REPORT_OPTIONS = TallyOptions(
    include_dates=True, include_closing_balance=True, include_customer_amount=True, balance_mode="minmax"
)


@register(
    "account_report_projection",
    "select account_number, customer_name, transaction_nos, dates, closing_balance, customer_amount, "
    "debit_count, credit_count, tally_value from (" + oracle.rollup_sql("activity", "minmax") + ")",
)
def account_report_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The per-account report with its column flags (closing balance and customer amount on)."""
    inp = fixture_inputs(spark, sf_dir)
    return jobs.per_account_report(inp, ACCOUNT_REPORT_OPTIONS)


# Small parts, so that most accounts of the test ledger have several.
LIST_PART_CHARS = 64


@register("account_rollup_list_parts", oracle.list_parts_sql(LIST_PART_CHARS))
def account_rollup_list_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rollup's two lists in parts of bounded size, as rows."""
    rows = account_activity(spark, sf_dir)
    return rollup.list_parts(rows, ("transaction_nos", "dates"), LIST_PART_CHARS, FINE_SPAN)


@register(
    "account_rollup_sorted",
    oracle.rollup_sql("activity", "minmax") + " order by account_number nulls last, customer_name nulls last",
)
def account_rollup_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.sort_rollup(account_rollup(spark, sf_dir))


@register("account_rollup_fine_buckets", oracle.rollup_sql("activity", "minmax"))
def account_rollup_fine_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rollup(spark, sf_dir, "activity", "minmax", FINE_SPAN)


@register("account_activity_shifted", oracle.SHIFTED)
def account_activity_shifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    inp = fixture_inputs(spark, sf_dir, with_duplicates=False)
    return activity.account_activity_shifted(inp.ledger, inp.customers, inp.mappings)


# ---- streaming ----------------------------------------------------------------------------

STREAM_ARRIVALS = 4
STREAM_TIMEOUT_S = 5000
# Which of the arrivals a row is in (see fixtures.ledger_arrivals), as SQL.
_ARRIVAL = f"(seq - min(seq) over ()) // ((max(seq) over () - min(seq) over ()) // {STREAM_ARRIVALS} + 1)"


def _arrivals(spark: SparkSession, sf_dir: str, name: str, start: Callable[[DataFrame, str], StreamingQuery], delayed: bool = False) -> str:
    """Folder of the output of a stream over the prepared ledger, one micro-batch per arrival.

    An arrival has as many files as its size asks for; the stream takes those
    that are there, ends, and goes on from its checkpoint with the next arrival.
    """
    base = scratch_path(spark, name)

    def take(schema: StructType) -> None:
        stream = streaming.ledger_file_stream(spark, f"{base}/in", schema)
        _finished(start(prepare.prepare_ledger(stream, carry=("arrived_at",)), f"{base}/out"))

    fixtures.ledger_arrivals(spark, sf_dir, f"{base}/in", STREAM_ARRIVALS, delayed, take)
    return f"{base}/out"


def _finished(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


@register("stream_pairing", "select account_number, seq, forward_type pair_type, next_credit from cls")
def stream_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resolved, late and pending rows of a stream over the whole ledger: the batch result."""
    out = _arrivals(spark, sf_dir, "stream-pairing", streaming.start_pairing)
    return streaming.all_rows(spark, out).select("account_number", "seq", "pair_type", "next_credit")


@register("stream_pairing_flushed", "select account_number, seq, forward_type pair_type, next_credit from cls")
def stream_pairing_flushed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resolved rows plus the pending ones, with hot accounts split finely and the state compacted every second batch."""
    out = _arrivals(spark, sf_dir, "stream-flushed", partial(streaming.start_pairing, span=FINE_SPAN, compact_every=2))
    rows = streaming.resolved_rows(spark, out).unionByName(streaming.pending_rows(spark, out))
    return rows.select("account_number", "seq", "pair_type", "next_credit")


@register(
    "stream_late_rows",
    f"""select account_number, seq, late,
               case when debit_amount > 0 and ledger_txn_no <> '' and not late and on_time_credit = debit_amount then 'DR_with_paired_CR'
                    when debit_amount > 0 and ledger_txn_no <> '' then 'DR_unpaired'
                    when credit_amount > 0 then 'CR_transaction' else 'other' end pair_type,
               case when not late then on_time_credit end next_credit
        from (select *, lead(credit_amount) over (partition by account_number, late order by seq) on_time_credit
              from (select *, coalesce(max(seq) over (partition by account_number order by arrival
                                       range between unbounded preceding and 1 preceding) >= seq, false) late
                    from (select *, {_ARRIVAL} + case when (seq // 2) % 97 = 0 then 1 else 0 end arrival from ledger)))""",
)
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream in which some rows come after later ones of their account: on-time and late rows are the input."""
    out = _arrivals(spark, sf_dir, "stream-late", streaming.start_pairing, delayed=True)
    return streaming.all_rows(spark, out).select("account_number", "seq", "late", "pair_type", "next_credit")


@register(
    "stream_pairing_event_time",
    f""", a as (select *, {_ARRIVAL} arrival from ledger),
             marks as (select arrival, max(seq) mark from a group by arrival),
             n as (select a.*, lead(arrival) over w next_arrival, lead(credit_amount) over w credit_after
                   from a window w as (partition by account_number order by seq)),
             t as (select n.*, case when next_arrival = n.arrival then credit_after
                                    when seq + {STREAM_TIMEOUT_S} <= (select max(mark) from marks m where m.arrival < next_arrival) then null
                                    else credit_after end known_credit
                   from n)
        select account_number, seq,
               case when debit_amount > 0 and ledger_txn_no <> '' and known_credit = debit_amount then 'DR_with_paired_CR'
                    when debit_amount > 0 and ledger_txn_no <> '' then 'DR_unpaired'
                    when credit_amount > 0 then 'CR_transaction' else 'other' end pair_type,
               known_credit next_credit,
               coalesce(next_arrival = arrival, false) or seq + {STREAM_TIMEOUT_S} <= (select max(mark) from marks)
                 or next_arrival is not null resolved
        from t""",
)
def stream_pairing_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairing with the event-time timer: a row whose account stays silent too long is resolved as unpaired."""
    out = _arrivals(spark, sf_dir, "stream-event-time", partial(streaming.start_pairing, timeout_s=STREAM_TIMEOUT_S))
    done = streaming.resolved_rows(spark, out).withColumn("resolved", F.lit(True))
    rows = done.unionByName(streaming.pending_rows(spark, out).withColumn("resolved", F.lit(False)))
    return rows.select("account_number", "seq", "pair_type", "next_credit", "resolved")


@register("stream_tally", "select * from per_txn")
def stream_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The per-transaction tally by stream-static joins, written per micro-batch, with the rows still pending."""
    inp = fixture_inputs(spark, sf_dir)
    kept = streaming.kept_mappings(inp.mappings)
    try:
        out = _arrivals(spark, sf_dir, "stream-tally", partial(streaming.start_tally, customers=inp.customers, mappings=kept))
    finally:
        kept.unpersist()
    return streaming.all_tally(spark, out, inp.customers, inp.mappings).drop("late")
