"""Reference-shaped input tables derived from the driver's TPC-H-like parquet.

The reference reads three spreadsheets: customers, a DR/CR ledger and a list of
dated transaction numbers.  These functions derive tables of exactly that shape
from ``customer`` and ``orders`` (see FIXTURES.md), so every query's work grows
with the given tables.  Columns carry the reference's source names
(``AccountNumber``, ``Type`` ...); the prepare operators rename and cast them.

The derivation is plain Spark SQL over DataFrame parameters (no global views),
so the same text runs for any ``sf_dir`` in one session.  The ledger's running
balances are a per-account prefix sum; it is computed per (account, seq bucket)
plus a carried total of the earlier buckets, so an account holding a large
share of the ledger is still split over many tasks.

``materialize`` writes the three derived inputs once (to the shared scratch
folder) so a benchmark can time the operators on stored tables, as a
deployment would read its ledger.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.config import DEFAULT_SPAN
from ledgerline.operators.running import running_totals


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def customers_derived(spark: SparkSession, sf_dir: str, with_duplicates: bool = True) -> DataFrame:
    """``acc``: every customer, one in ten under an account number that no ledger row has, one in fifty twice."""
    customer = base_table(spark, sf_dir, "customer")
    text = """
        select concat(case when c_custkey % 10 = 3 then 'X' else '' end, cast(c_custkey as string)) account_number,
               c_name customer_name, c_acctbal customer_amount
        from {customer}
    """
    if with_duplicates:
        text += """
        union all
        select cast(c_custkey as string), concat(c_name, '-dup'), c_acctbal + 1
        from {customer} where c_custkey % 50 = 7
        """
    return spark.sql(text, customer=customer)


def mappings_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``map``: a date one day after the order for every order; two numbers in three are no ledger row's."""
    orders = base_table(spark, sf_dir, "orders")
    return spark.sql(
        """
        select cast(o_custkey as string) account_number,
               cast(cast(o_orderdate as date) + interval '1' day as date) txn_date,
               concat(case when o_orderkey % 3 = 0 then 'TXN' else 'OLD' end, cast(o_orderkey as string)) transaction_number
        from {orders}
        """,
        orders=orders,
    )


def raw_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw``: a DR per order, a CR for status F (equal) and P (half)."""
    orders = base_table(spark, sf_dir, "orders")
    return spark.sql(
        """
        select cast(o_custkey as string) account_number, 2 * o_orderkey seq,
               cast(o_orderdate as date) d, 'DR' ty, o_totalprice amt,
               case when o_orderkey % 11 = 0 then null when o_orderkey % 13 = 0 then ''
                    else concat('TXN', cast(o_orderkey as string)) end txn
        from {orders}
        union all
        select cast(o_custkey as string),
               case when o_orderkey % 4 = 1 then 2 * (o_orderkey + 40) + 1 else 2 * o_orderkey + 1 end,
               cast(cast(o_orderdate as date) + interval '2' day as date), 'CR',
               case when o_orderstatus = 'F' then o_totalprice else round(o_totalprice * 50e0, 0) / 100e0 end,
               case when o_orderkey % 5 = 0 then concat('CRT', cast(o_orderkey as string)) else null end
        from {orders} where o_orderstatus in ('F', 'P')
        """,
        orders=orders,
    )


def ledger_derived(spark: SparkSession, sf_dir: str, span: int = DEFAULT_SPAN) -> DataFrame:
    """``led``: ``raw`` with opening/closing balances (customer balance + running sum)."""
    raw = raw_ledger(spark, sf_dir)
    customer = base_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("_ck"), F.col("c_acctbal")
    )
    signed = F.when(F.col("ty") == "CR", F.col("amt")).otherwise(-F.col("amt")).cast("decimal(18,2)")
    with_sums = running_totals(raw.withColumn("_signed", signed), "account_number", "seq", "_signed", span)
    start = F.coalesce(F.col("c_acctbal"), F.lit(0.0)).cast("decimal(18,2)")
    joined = with_sums.join(customer, F.col("account_number") == F.col("_ck"), "left")
    return joined.select(
        "account_number",
        "seq",
        F.col("d").cast("string").alias("dt"),
        "ty",
        "amt",
        "txn",
        (start + F.col("_before")).cast("double").alias("ob"),
        (start + F.col("_through")).cast("double").alias("cb"),
    )


# ---- the reference's input shapes ------------------------------------------------


def fixture_customers(spark: SparkSession, sf_dir: str, with_duplicates: bool = True) -> DataFrame:
    return customers_derived(spark, sf_dir, with_duplicates).select(
        F.col("customer_name").alias("CustomerName"),
        F.col("account_number").alias("AccountNumber"),
        F.col("customer_amount").alias("Amount"),
    )


def fixture_mappings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mappings_derived(spark, sf_dir).select(
        F.col("account_number").alias("AccountNumber"),
        F.col("txn_date").alias("Date"),
        F.col("transaction_number").alias("TransactionNumber"),
    )


def fixture_ledger(spark: SparkSession, sf_dir: str, span: int = DEFAULT_SPAN) -> DataFrame:
    return ledger_derived(spark, sf_dir, span).select(
        F.col("account_number").alias("AccountNumber"),
        F.col("dt").alias("Date"),
        F.col("ty").alias("Type"),
        F.col("amt").alias("Amount"),
        F.col("txn").alias("TransactionNumber"),
        F.col("ob").alias("OpeningBalance"),
        F.col("cb").alias("ClosingBalance"),
        "seq",
    )


#: Rows of a file of an arrival that may have several.
ARRIVAL_FILE_ROWS = 500_000


def ledger_arrivals(
    spark: SparkSession,
    sf_dir: str,
    path: str,
    parts: int,
    delayed: bool = False,
    each: Callable[[T.StructType], None] | None = None,
) -> T.StructType:
    """The whole ledger as files that arrive one after another; returns their schema.

    Arrival k has the rows of the k-th of ``parts`` equal ranges of ``seq``, and
    ``arrived_at`` one second of 2024 per unit of ``seq``.  With ``delayed`` the
    rows whose ``seq div 2`` 97 divides come one arrival later.

    ``each`` is called when an arrival is there, before the next one; a large
    arrival then has many files, written and read by a task each.  Without
    ``each`` an arrival is one file, so that a stream can tell them apart.
    """
    ledger = fixture_ledger(spark, sf_dir).withColumn("arrived_at", F.timestamp_seconds(F.lit(1704067200) + F.col("seq")))
    bounds = raw_ledger(spark, sf_dir).agg(F.min("seq").alias("lo"), F.max("seq").alias("hi")).first()
    lo, hi = (bounds["lo"] or 0), (bounds["hi"] or 0)
    arrival = F.expr(f"(seq - {lo}) div {(hi - lo) // parts + 1}")
    if delayed:
        arrival = arrival + F.when(F.expr("seq div 2") % 97 == 0, 1).otherwise(0)
    split = f"{path}-split"
    ledger.withColumn("arrival", arrival).write.mode("overwrite").partitionBy("arrival").parquet(split)
    dealt = spark.read.schema(T.StructType([*ledger.schema.fields, T.StructField("arrival", T.IntegerType())])).parquet(split)
    sizes = {r["arrival"]: r["count"] for r in dealt.groupBy("arrival").count().collect()} if each else {}
    # A file source takes files by their time: later arrivals are written later.
    for k in range(parts + delayed):
        files = max(1, -(-sizes.get(k, 0) // ARRIVAL_FILE_ROWS))
        dealt.where(F.col("arrival") == k).drop("arrival").coalesce(files).write.mode("append").parquet(path)
        if each:
            each(ledger.schema)
    return ledger.schema


def fixture_narrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narration text per order; every seventh carries no number."""
    orders = base_table(spark, sf_dir, "orders")
    return spark.sql(
        """
        select o_orderkey narration_id,
               case when o_orderkey % 7 = 0 then concat('Cash deposit ', cast(o_orderkey as string))
                    else concat('Payment, txn no: TXN', cast(o_orderkey as string), ' done') end narration
        from {orders}
        """,
        orders=orders,
    )


def materialize(spark: SparkSession, sf_dir: str, path: str, span: int = DEFAULT_SPAN) -> dict[str, str]:
    """Write customers, ledger and mapping (input shapes) as Parquet under ``path``."""
    out = {}
    for name, df in (
        ("customers", fixture_customers(spark, sf_dir)),
        ("ledger", fixture_ledger(spark, sf_dir, span)),
        ("mappings", fixture_mappings(spark, sf_dir)),
    ):
        target = f"{path.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(target)
        out[name] = target
    return out
