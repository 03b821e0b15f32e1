"""Per-account form, row level: the rows an account report is folded from.

Kept rows: every row with a transaction number except a credit already shown
by the debit it pairs with (``CR_paired``).  A paired debit carries its own
paired credit's amount and date; other rows carry their own amounts.

Dates of a numbered positive debit: mapped date, else (when paired) the
paired credit's ledger date, else its own ledger date.  Other rows: own date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.config import DEFAULT_SPAN
from ledgerline.functions import has_number
from ledgerline.operators.copartition import pair_and_enrich
from ledgerline.operators.enrich import add_customer, add_mapped_date
from ledgerline.operators.neighbors import add_neighbors
from ledgerline.operators.skew import as_split, hot_keys
from ledgerline.operators.pairing import CR_PAIRED, DR_WITH_PAIRED_CR, DR_WITH_TXN, classify_backward, classify_both
from ledgerline.operators.prune import matching_mappings
from ledgerline.session import ensure_checkpoint_dir
from ledgerline.operators.tally import tally_rows


def kept_rows(ledger: DataFrame, span: int | None = DEFAULT_SPAN) -> DataFrame:
    """Classified rows with a number, minus credits shown by their debit."""
    c = classify_both(ledger, span)
    return c.where(has_number("ledger_txn_no") & (F.col("pair_type") != F.lit(CR_PAIRED)))


def account_activity(
    ledger: DataFrame,
    customers: DataFrame,
    mappings: DataFrame | None = None,
    span: int | None = DEFAULT_SPAN,
    prune_mapping: bool = False,
) -> DataFrame:
    """Kept rows with own-pair credit and dates, enriched and tallied per row.

    ``prune_mapping``: as in ``tally.tally_per_transaction``.
    """
    if prune_mapping:
        mappings = matching_mappings(mappings, ledger.where(has_number("ledger_txn_no")))
    enriched = pair_and_enrich(ledger, customers, mappings, kept_rows, span)
    is_dr = F.col("pair_type") == F.lit(DR_WITH_TXN)
    paired = is_dr & (F.col("forward_type") == F.lit(DR_WITH_PAIRED_CR))
    rows = enriched.withColumns(
        {
            "debit": F.col("debit_amount"),
            "credit": F.coalesce(F.when(paired, F.col("next_credit")), F.col("credit_amount"), F.lit(0.0)),
            "final_date": F.when(
                is_dr, F.coalesce(F.col("txn_date"), F.when(paired, F.col("next_date")), F.col("date"))
            ).otherwise(F.col("date")),
        }
    )
    return tally_rows(rows)


def account_activity_shifted(
    ledger: DataFrame,
    customers: DataFrame,
    mappings: DataFrame | None = None,
    span: int | None = DEFAULT_SPAN,
    cut_lineage: bool = True,
) -> DataFrame:
    """The per-account form with the reference's literal credit attribution.

    A debit's partner is the row right after it *in the whole ledger* (same
    account, class ``CR_paired``); the partner's credit, date and mapped date
    are then read one kept row further on (LEAD over the kept rows of the
    account), which shifts credits up by one kept row.  Kept rows here include
    unnumbered ones until the final filter, as in the reference.  Ties (from
    duplicate customers or mappings) make that LEAD order-dependent, so use
    this mode on inputs without duplicate keys.

    Three neighbour passes, each bucketed: backward classes per account, the
    global next row (arrival order is ``seq``, so the next position is the next
    ``seq``), and the LEAD over kept rows per account.  Each pass reads its
    input twice (rows and edge table), so before the last pass the enriched
    kept rows are checkpointed to the shared checkpoint folder (an eager,
    reliable checkpoint) instead of recomputing the first two passes.
    """
    span = span or DEFAULT_SPAN
    split = as_split(span)
    classified = classify_backward(ledger, split).withColumn("_all", F.lit(0))
    # Whether the single global key is "hot" depends only on the row count:
    # take it from the ledger scan, not from the classified plan.
    global_hot = hot_keys(ledger.select(F.lit(0).alias("_all")), "_all", split)
    nxt = add_neighbors(
        classified,
        "_all",
        "seq",
        lead={
            "_g_account": "account_number",
            "_g_type": "pair_type",
            "_g_credit": "credit_amount",
            "_g_date": "date",
        },
        span=split,
        hot=global_hot,
    ).drop("_all")
    partner = (F.col("_g_account") == F.col("account_number")) & (F.col("_g_type") == F.lit(CR_PAIRED))
    kept = nxt.where(F.col("pair_type") != F.lit(CR_PAIRED))
    enriched = add_mapped_date(add_customer(kept, customers), mappings)
    joined = enriched.select(
        "account_number",
        "seq",
        "date",
        "ledger_txn_no",
        "debit_amount",
        "credit_amount",
        "opening_balance",
        "closing_balance",
        "pair_type",
        "customer_name",
        "customer_amount",
        "txn_date",
        F.when(partner, F.col("_g_credit")).alias("_p_credit"),
        F.when(partner, F.col("_g_date")).alias("_p_date"),
        F.when(partner, F.col("txn_date")).alias("_p_txn_date"),
    )
    if cut_lineage:
        ensure_checkpoint_dir(joined.sparkSession)
        joined = joined.checkpoint(eager=True)
    shifted = add_neighbors(
        joined,
        "account_number",
        "seq",
        lead={"_n_credit": "_p_credit", "_n_date": "_p_date", "_n_txn_date": "_p_txn_date"},
        span=split,
        hot=hot_keys(ledger, "account_number", split),
    )
    is_dr = F.col("pair_type") == F.lit(DR_WITH_TXN)
    own_date = F.when(is_dr & F.col("txn_date").isNotNull(), F.col("txn_date")).otherwise(F.col("date"))
    rows = shifted.where(has_number("ledger_txn_no")).withColumns(
        {
            "debit": F.col("debit_amount"),
            "credit": F.coalesce(F.col("_n_credit"), F.col("credit_amount"), F.lit(0.0)),
            "final_date": F.when(is_dr & F.col("_n_txn_date").isNotNull(), F.col("_n_txn_date"))
            .when(is_dr & F.col("_n_date").isNotNull(), F.col("_n_date"))
            .otherwise(own_date),
        }
    )
    return tally_rows(rows)
