"""Incremental pairing: a Structured Streaming job whose state is a table.

The batch rule needs each row's *next* row in its account, which may arrive in
a later micro-batch.  Every account therefore has one row of state: its last
row so far ("pending").  A micro-batch is united with the pending rows of its
accounts and paired by the same ``add_neighbors`` as a batch ledger (JVM only,
hot accounts split): rows with a successor are *resolved*, the last row of each
account is the new pending one, and rows not after their account's pending row
arrived out of order: they are *late*, classified without successor, and go to
an output of their own.  Nothing is dropped: resolved, late and pending rows
together are the input.

All three are written in one job to ``rows/batch=<id>/kind=<kind>``, replacing
what an earlier attempt at the same micro-batch left, and a batch's state is
derived from the folders of earlier batches only.  So a micro-batch can run any
number of times, and readers look only at batches that the checkpoint's commit
log holds.  Every ``COMPACT_EVERY`` batches the state is compacted to one row
per account under ``state/upto=<id>``, in folders by account bucket; a
micro-batch reads the buckets its accounts are in and the batches since.

Event-time timer (``timeout_s``): the watermark is the largest ``arrived_at``
seen, less ``delay_s``.  A pending row whose ``arrived_at`` is ``timeout_s`` or
more behind it is resolved as unpaired; its place stays known, so an older row
that comes later is still late, and a later credit no longer pairs with it.

Tally: ``start_tally`` also writes each batch's resolved and late numbered
debits, joined with the static customers and mappings, to ``tally/batch=<id>``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerline.config import DEFAULT_SPAN
from ledgerline.operators.enrich import add_customer, add_mapped_date, effective_date
from ledgerline.operators.neighbors import add_neighbors
from ledgerline.operators.pairing import DR_UNPAIRED, DR_WITH_PAIRED_CR, KEY, ORDER, forward_class
from ledgerline.operators.skew import Split, as_split
from ledgerline.operators.tally import tally_rows

ARRIVED = "arrived_at"
ROW_SCHEMA = T.StructType(
    [
        T.StructField(KEY, T.StringType()),
        T.StructField(ORDER, T.LongType()),
        T.StructField("date", T.DateType()),
        T.StructField("transaction_type", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("ledger_txn_no", T.StringType()),
        T.StructField("opening_balance", T.DoubleType()),
        T.StructField("closing_balance", T.DoubleType()),
        T.StructField("debit_amount", T.DoubleType()),
        T.StructField("credit_amount", T.DoubleType()),
        T.StructField(ARRIVED, T.TimestampType()),
    ]
)
ROW_COLUMNS = ROW_SCHEMA.fieldNames()
OUTPUT_COLUMNS = [*ROW_COLUMNS, "next_credit", "pair_type"]
_WRITTEN = T.StructType(
    [
        *ROW_SCHEMA.fields,
        T.StructField("next_credit", T.DoubleType()),
        T.StructField("pair_type", T.StringType()),
        T.StructField("batch", T.LongType()),
        T.StructField("kind", T.StringType()),
    ]
)

# Kinds of rows in a batch's folder; a closed row is an expired pending one, kept for its place.
RESOLVED, LATE, PENDING, CLOSED = "resolved", "late", "pending", "closed"

COMPACT_EVERY = 16
BUCKETS = 64


def _with(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(name, kind)])


def _last_by_batch(rows: DataFrame) -> DataFrame:
    """One row per account: that of its last micro-batch."""
    last = F.max_by(F.struct(*[c for c in rows.columns if c != KEY]), "batch").alias("last")
    return rows.groupBy(KEY).agg(last).select(KEY, "last.*")


def _bucket() -> Column:
    return F.pmod(F.xxhash64(KEY), F.lit(BUCKETS)).cast("int").alias("bucket")


class MicroBatches:
    """The micro-batch step and the folders under ``path``."""

    def __init__(
        self,
        path: str,
        span: int | Split | None = DEFAULT_SPAN,
        timeout_s: float | None = None,
        delay_s: float = 0.0,
        compact_every: int = COMPACT_EVERY,
        after: Callable[[DataFrame, int], None] | None = None,
    ):
        self.path = path.rstrip("/")
        self.span, self.timeout_s, self.delay_s, self.compact_every, self.after = span, timeout_s, delay_s, compact_every, after

    # ---- state ---------------------------------------------------------------------------

    def state(self, spark: SparkSession, batch_id: int, accounts: DataFrame | None = None) -> DataFrame:
        """The last row of every account (of ``accounts`` only) before micro-batch ``batch_id``; ``kind`` tells if it is closed."""
        upto = batch_id // self.compact_every * self.compact_every - 1
        rows = spark.createDataFrame([], _WRITTEN)
        if upto >= 0:
            base = spark.read.schema(_with(_WRITTEN, "bucket", T.IntegerType())).parquet(f"{self.path}/state/upto={upto}")
            if accounts is not None:
                # At most BUCKETS values: the folders this micro-batch needs.
                here = [r.bucket for r in accounts.select(_bucket()).distinct().collect()]
                base = base.where(F.col("bucket").isin(here)) if here else base.limit(0)
            rows = rows.unionByName(base.drop("bucket"))
        recent = [f"{self.path}/rows/batch={i}" for i in range(upto + 1, batch_id)]
        if recent:
            found = spark.read.schema(_WRITTEN).option("basePath", f"{self.path}/rows").parquet(*recent)
            rows = rows.unionByName(found.where(F.col("kind").isin(PENDING, CLOSED)))
        if accounts is not None:
            own = accounts.select(F.col(KEY).alias("_a")).distinct()
            rows = rows.join(own, F.col(KEY).eqNullSafe(F.col("_a")), "left_semi")
        return _last_by_batch(rows)

    def _compact(self, spark: SparkSession, batch_id: int) -> None:
        if (batch_id + 1) % self.compact_every == 0:
            self._latest(spark, batch_id).withColumn("bucket", _bucket()).write.mode("overwrite").partitionBy("bucket").parquet(
                f"{self.path}/state/upto={batch_id}"
            )

    def _latest(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """State after ``batch_id``, from the last compaction and the batches since, this one included."""
        before = self.state(spark, batch_id)
        own = spark.read.schema(_WRITTEN).option("basePath", f"{self.path}/rows").parquet(f"{self.path}/rows/batch={batch_id}")
        return _last_by_batch(before.unionByName(own.where(F.col("kind").isin(PENDING, CLOSED))))

    def _watermark(self, spark: SparkSession, rows: DataFrame, batch_id: int) -> float | None:
        """Largest arrival time up to this micro-batch less the delay, in seconds; None before any."""
        seen = rows.select(F.max(F.unix_micros(ARRIVED)).alias("at"))
        if batch_id:
            seen = seen.unionByName(spark.read.schema("at long").parquet(f"{self.path}/marks/batch={batch_id - 1}"))
        at = seen.agg(F.max("at").alias("at")).first()["at"]
        spark.createDataFrame([(at,)], "at long").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/marks/batch={batch_id}")
        return None if at is None else at / 1e6 - self.delay_s

    # ---- one micro-batch -----------------------------------------------------------------

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.select(*ROW_COLUMNS)
        held = self.state(spark, batch_id, rows).persist() if batch_id else None
        if held is None:
            marked = rows.withColumn("_late", F.lit(False))
        else:
            places = held.select(F.col(KEY).alias("_a"), F.col(ORDER).alias("_held"))
            marked = rows.join(places, F.col(KEY).eqNullSafe(F.col("_a")), "left").withColumn(
                "_late", F.coalesce(F.col(ORDER) <= F.col("_held"), F.lit(False))
            )
        marked = marked.select(*ROW_COLUMNS, "_late").persist()
        try:
            self._write(spark, marked, held, batch_id)
        finally:
            marked.unpersist()
            if held is not None:
                held.unpersist()
        self._compact(spark, batch_id)
        if self.after:
            written = spark.read.schema(_WRITTEN).option("basePath", f"{self.path}/rows").parquet(f"{self.path}/rows/batch={batch_id}")
            self.after(written, batch_id)

    def _write(self, spark: SparkSession, marked: DataFrame, held: DataFrame | None, batch_id: int) -> None:
        on_time = marked.where(~F.col("_late")).drop("_late")
        if held is not None:
            on_time = on_time.unionByName(held.where(F.col("kind") == PENDING).select(*ROW_COLUMNS))
        # A micro-batch of no more rows than a hot account has holds no hot account.
        split = as_split(self.span)
        span = split if split is not None and marked.count() >= split.threshold else None
        paired = add_neighbors(on_time, KEY, ORDER, lead={"next_credit": "credit_amount", "_next": ORDER}, span=span)
        last = F.col("_next").isNull()
        expired = F.lit(False)
        if self.timeout_s is not None:
            mark = self._watermark(spark, marked, batch_id)
            if mark is not None:
                expired = last & F.coalesce(F.unix_micros(ARRIVED) / 1e6 + self.timeout_s <= F.lit(mark), F.lit(False))
            if batch_id:
                # Accounts that this micro-batch doesn't touch may have fallen silent.
                own = marked.select(F.col(KEY).alias("_a")).distinct()
                others = self.state(spark, batch_id).where(F.col("kind") == PENDING).join(own, F.col(KEY).eqNullSafe(F.col("_a")), "left_anti")
                silent = others.where(F.unix_micros(ARRIVED) / 1e6 + self.timeout_s <= F.lit(mark)).select(*ROW_COLUMNS)
                paired = paired.unionByName(silent, allowMissingColumns=True)
        kinds = (
            F.when(expired, F.array(F.lit(RESOLVED), F.lit(CLOSED)))
            .when(last, F.array(F.lit(PENDING)))
            .otherwise(F.array(F.lit(RESOLVED)))
        )
        late = marked.where("_late").select(*ROW_COLUMNS, F.lit(None).cast("double").alias("next_credit"), F.array(F.lit(LATE)).alias("kinds"))
        out = paired.select(*ROW_COLUMNS, "next_credit", kinds.alias("kinds")).unionByName(late)
        out = out.withColumn("pair_type", forward_class()).select(*OUTPUT_COLUMNS, F.explode("kinds").alias("kind"))
        out.write.mode("overwrite").partitionBy("kind").parquet(f"{self.path}/rows/batch={batch_id}")


# ---- starting -----------------------------------------------------------------------------


def _rows(ledger_stream: DataFrame) -> DataFrame:
    if ARRIVED not in ledger_stream.columns:
        ledger_stream = ledger_stream.withColumn(ARRIVED, F.lit(None).cast("timestamp"))
    return ledger_stream.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ROW_SCHEMA.fields])


def start_pairing(
    ledger_stream: DataFrame,
    path: str,
    span: int | Split | None = DEFAULT_SPAN,
    timeout_s: float | None = None,
    delay_s: float = 0.0,
    compact_every: int = COMPACT_EVERY,
    after: Callable[[DataFrame, int], None] | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Pair a prepared ledger stream into the folders under ``path`` (also the checkpoint's, so a restart goes on).

    ``timeout_s`` needs the column ``arrived_at`` (timestamp).  The rows of one
    account must reach the stream in ``seq`` order across micro-batches, else
    they are late; ``compact_every`` must stay the same over restarts.
    """
    step = MicroBatches(path, span, timeout_s, delay_s, compact_every, after)
    writer = _rows(ledger_stream).writeStream.foreachBatch(step.__call__).option("checkpointLocation", f"{step.path}/checkpoint")
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def tally_of(rows: DataFrame, customers: DataFrame, mappings: DataFrame | None) -> DataFrame:
    """Numbered debits among paired rows, with customer and mapped date, as tally rows; ``late`` is kept."""
    debits = rows.where(F.col("pair_type").isin(DR_WITH_PAIRED_CR, DR_UNPAIRED))
    enriched = effective_date(add_mapped_date(add_customer(debits, customers), mappings))
    credit = F.when(F.col("pair_type") == F.lit(DR_WITH_PAIRED_CR), F.col("next_credit")).otherwise(F.lit(0.0))
    return tally_rows(enriched.withColumns({"debit": F.col("debit_amount"), "credit": credit}), "late")


def kept_mappings(mappings: DataFrame, partitions: int | None = None) -> DataFrame:
    """The mapping for many micro-batches: dealt and sorted by its join columns once and kept by the executors until ``unpersist``.

    A micro-batch then deals and sorts only its own debits.  Null keys match
    nothing and are dropped; ``partitions``: the session's shuffle partitions by default.
    """
    keys = (KEY, "transaction_number")
    known = mappings.where(F.col(KEY).isNotNull() & F.col("transaction_number").isNotNull())
    n = partitions or int(mappings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return known.repartition(n, *keys).sortWithinPartitions(*keys).persist()


def start_tally(
    ledger_stream: DataFrame, path: str, customers: DataFrame, mappings: DataFrame | None = None, **options
) -> StreamingQuery:
    """``start_pairing`` that also writes the tally of each micro-batch's resolved and late rows."""

    def after(rows: DataFrame, batch_id: int) -> None:
        done = rows.where(F.col("kind").isin(RESOLVED, LATE)).withColumn("late", F.col("kind") == LATE)
        tally_of(done, customers, mappings).write.mode("overwrite").parquet(f"{path.rstrip('/')}/tally/batch={batch_id}")

    return start_pairing(ledger_stream, path, after=after, **options)


def ledger_file_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """Ledger files (input shapes) as a stream, oldest first; optionally a bounded number of files per micro-batch.

    Rows of an account are ordered across micro-batches, not across the files
    of one micro-batch.
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


# ---- reading ------------------------------------------------------------------------------


def committed(spark: SparkSession, path: str) -> int:
    """The last micro-batch that the checkpoint's commit log holds; -1 before any."""
    try:
        log = spark.read.text(f"{path.rstrip('/')}/checkpoint/commits").select(F.col("_metadata.file_name").cast("long").alias("id"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return -1
    last = log.agg(F.max("id").alias("id")).first()["id"]
    return -1 if last is None else last


def _read(spark: SparkSession, path: str, *kinds: str) -> DataFrame:
    last = committed(spark, path)
    if last < 0:
        return spark.createDataFrame([], _WRITTEN)
    rows = spark.read.schema(_WRITTEN).parquet(f"{path.rstrip('/')}/rows")
    return rows.where((F.col("batch") <= last) & F.col("kind").isin(*kinds))


def resolved_rows(spark: SparkSession, path: str) -> DataFrame:
    """On-time rows whose successor is known (or whose timer ran out)."""
    return _read(spark, path, RESOLVED).select(*OUTPUT_COLUMNS)


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows that arrived after a later one of their account, classified without successor."""
    return _read(spark, path, LATE).select(*OUTPUT_COLUMNS)


def pending_rows(spark: SparkSession, path: str) -> DataFrame:
    """The last row of each account that still waits for a successor, classified without one."""
    return _last_by_batch(_read(spark, path, PENDING, CLOSED)).where(F.col("kind") == PENDING).select(*OUTPUT_COLUMNS)


def all_rows(spark: SparkSession, path: str) -> DataFrame:
    """Every row of the stream once, with ``late``: resolved, late and pending."""
    on_time = resolved_rows(spark, path).unionByName(pending_rows(spark, path)).withColumn("late", F.lit(False))
    return on_time.unionByName(late_rows(spark, path).withColumn("late", F.lit(True)))


def all_tally(spark: SparkSession, path: str, customers: DataFrame, mappings: DataFrame | None = None) -> DataFrame:
    """The tally written by ``start_tally`` and that of the rows still pending: no numbered debit is left out."""
    waiting = tally_of(pending_rows(spark, path).withColumn("late", F.lit(False)), customers, mappings)
    last = committed(spark, path)
    if last < 0:
        return waiting
    done = spark.read.schema(_with(waiting.schema, "batch", T.LongType())).parquet(f"{path.rstrip('/')}/tally")
    return done.where(F.col("batch") <= last).drop("batch").unionByName(waiting)
