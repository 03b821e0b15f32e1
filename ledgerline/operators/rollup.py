"""Per-account rollup: one row per (account_number, customer_name).

Numeric parts (sums, counts, min/max) aggregate partially on the map side.
Transaction numbers and dates are joined with a newline in arrival order.  A
plain ``listagg`` would buffer every row of a group in one task; instead the
lists are built in two stages: per (account, name, bucket) -- hot accounts
cut into ``seq`` buckets of bounded size, others whole (see ``skew``) -- and
then the bucket strings in bucket order.  Nulls are
skipped and an all-null list is null at both stages, as in SQL STRING_AGG.
The final list of an account is, by definition of the report, as long as the
account's history; the numeric columns never need it.

Sums are exact (DECIMAL) so the result does not depend on partitioning; NaN
and infinities propagate as a double sum would.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.config import DEFAULT_SPAN
from ledgerline.functions import round_money
from ledgerline.functions.money import SUM_DECIMAL
from ledgerline.operators.running import running_totals
from ledgerline.operators.skew import BUCKET, HOT, WHOLE, Split, as_split, with_buckets
from ledgerline.session import scratch_path

# List separator of the per-account text columns (chr(10), a newline).
LIST_SEPARATOR = "\n"

GROUP = ("account_number", "customer_name")
_MONEY_SUMS = ("total_debit", "total_credit")


def ordered_list(col: str, order: str):
    """LISTAGG(col, newline) WITHIN GROUP (ORDER BY order): nulls skipped, all-null -> null."""
    return F.expr(f"listagg(`{col}`, chr(10)) WITHIN GROUP (ORDER BY `{order}`)")


def _special(c):
    return F.isnan(c) | (F.abs(c) == F.lit(float("inf")))


def account_rollup(
    rows: DataFrame,
    balance_mode: str = "minmax",
    span: "int | Split | None" = DEFAULT_SPAN,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Fold per-row results (``account_activity`` or per-transaction rows) per account.

    ``hot``: hot accounts from ``skew.hot_keys(ledger, ...)``; pass it so the
    account counts come from the ledger scan rather than from ``rows``' plan.
    """
    if balance_mode not in ("minmax", "boundary"):
        raise ValueError(f"unknown balance_mode {balance_mode!r}")
    split = as_split(span)
    if split is None:
        rows = rows.withColumn(BUCKET, F.lit(WHOLE).cast("long"))
    else:
        rows = with_buckets(rows, "account_number", "seq", split, hot).drop(HOT)

    first_stage = []
    for m in _MONEY_SUMS:
        first_stage += [
            F.try_sum(F.col(m).try_cast(SUM_DECIMAL)).alias(f"_{m}_dec"),
            F.sum(m).alias(f"_{m}_dbl"),
            # Amounts that the decimal cannot hold: the double sum stands for them all.
            (F.count(m) - F.count(F.col(m).try_cast(SUM_DECIMAL))).alias(f"_{m}_lost"),
        ]
    first_stage += [
        F.sum("debit_count").alias("_debit_count"),
        F.sum("credit_count").alias("_credit_count"),
        F.min("opening_balance").alias("_open_min"),
        F.max("closing_balance").alias("_close_max"),
        F.min_by("opening_balance", "seq").alias("_open_first"),
        F.max_by("closing_balance", "seq").alias("_close_last"),
        F.min("seq").alias("_seq_min"),
        F.max("seq").alias("_seq_max"),
        F.max("customer_amount").alias("_cust_amount"),
        ordered_list("transaction_nos", "seq").alias("_nos"),
        ordered_list("dates", "seq").alias("_dates"),
    ]
    buckets = rows.withColumnRenamed(BUCKET, "_rb").groupBy(*GROUP, "_rb").agg(*first_stage)

    second_stage = []
    for m in _MONEY_SUMS:
        dbl = F.sum(f"_{m}_dbl")
        dec = F.try_sum(f"_{m}_dec")
        # A bucket's decimal sum is also null where it overflows, while its double sum is not.
        over = F.sum((F.col(f"_{m}_dec").isNull() & F.col(f"_{m}_dbl").isNotNull()).cast("long")) > 0
        whole = _special(dbl) | (F.sum(f"_{m}_lost") > 0) | over | dec.isNull()
        second_stage.append(F.when(whole, dbl).otherwise(dec.cast("double")).alias(m))
    second_stage += [
        F.sum("_debit_count").cast("int").alias("debit_count"),
        F.sum("_credit_count").cast("int").alias("credit_count"),
        F.min("_open_min").alias("_open_min"),
        F.max("_close_max").alias("_close_max"),
        F.min_by("_open_first", "_seq_min").alias("_open_first"),
        F.max_by("_close_last", "_seq_max").alias("_close_last"),
        F.max("_cust_amount").alias("customer_amount"),
        ordered_list("_nos", "_rb").alias("transaction_nos"),
        ordered_list("_dates", "_rb").alias("dates"),
    ]
    folded = buckets.groupBy(*GROUP).agg(*second_stage)

    if balance_mode == "minmax":
        opening, closing = F.col("_open_min"), F.col("_close_max")
    else:
        opening, closing = F.col("_open_first"), F.col("_close_last")
    return folded.select(
        *GROUP,
        "transaction_nos",
        "dates",
        round_money("total_debit").alias("total_debit"),
        round_money("total_credit").alias("total_credit"),
        "debit_count",
        "credit_count",
        round_money(opening + F.col("total_credit") - F.col("total_debit")).alias("tally_value"),
        round_money(opening).alias("opening_balance"),
        round_money(closing).alias("closing_balance"),
        "customer_amount",
    )


#: Characters of a part of a list; one element more, however long, ends the part.
PART_CHARS = 1 << 20


def list_parts(
    rows: DataFrame, column: "str | Sequence[str]", part_chars: int = PART_CHARS, span: "int | Split" = DEFAULT_SPAN
) -> DataFrame:
    """The list of ``column`` of each (account, name) in bounded parts: account_number, customer_name, list, part, text.

    For accounts whose list is longer than a value should be.  A running sum of
    the lengths (hot accounts split) gives each element its part, so no task and
    no value ever holds a whole list; the parts in order, joined with a newline,
    are the list that ``account_rollup`` puts into one value.  Part numbers rise;
    after an element longer than a part some are left out.

    The lists of several columns are made in one pass.  The running sum reads
    its rows three times, so their few columns are written once to the shared
    scratch folder instead of computing ``rows`` again for each.
    """
    columns = [column] if isinstance(column, str) else list(column)
    path = f"{scratch_path(rows.sparkSession, 'list-parts')}/rows"
    some = rows.where(F.coalesce(*columns).isNotNull()).select(*GROUP, "seq", *columns)
    some.write.parquet(path)
    some = rows.sparkSession.read.schema(some.schema).parquet(path)
    # A row without an element adds nothing to the length of that list.
    sizes = {f"_size_{c}": F.coalesce(F.length(c) + 1, F.lit(0)).cast("long") for c in columns}
    sized = some.withColumns({"_k": F.struct(*GROUP), **sizes}).drop(*GROUP)
    placed = running_totals(sized, "_k", "seq", list(sizes), span)
    # The added rows of the running sum are gone again: every row has its elements.
    elements = [
        F.struct(F.lit(c).alias("list"), F.expr(f"_before__size_{c} div {int(part_chars)}").alias("part"), F.col(c).alias("_text")) for c in columns
    ]
    parts = placed.select("_k.*", "seq", F.inline(F.array(*elements))).where(F.col("_text").isNotNull())
    text = F.expr("listagg(_text, chr(10)) WITHIN GROUP (ORDER BY seq)").alias("text")
    return parts.groupBy(*GROUP, "list", "part").agg(text).select(*GROUP, "list", "part", "text")


def sort_rollup(result: DataFrame) -> DataFrame:
    """ORDER BY account_number (nulls last), customer_name."""
    return result.orderBy(F.asc_nulls_last("account_number"), F.asc_nulls_last("customer_name"))
