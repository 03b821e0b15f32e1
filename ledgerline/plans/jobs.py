"""End-to-end jobs: what the reference's ``pipeline(accounts, ledger, mapping)`` does.

``per_transaction``: one report row per numbered debit.
``per_account``: one report row per (account, customer name).
``run_pipeline``: read the three files, build the chosen report, pick columns
by the option flags and write a CSV folder.  One lazy plan; the only action is
the write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.config import TallyOptions
from ledgerline.functions.dates import EXTRA_DATE_FORMATS
from ledgerline.operators import activity, report, rollup, tally
from ledgerline.operators.prepare import prepare_customers, prepare_ledger, prepare_mappings
from ledgerline.operators.sequence import sequence_from_files
from ledgerline.operators.skew import Split, hot_keys
from ledgerline.plans.inputs import Inputs
from ledgerline.sources import readers


def per_transaction_rows(inp: Inputs, options: TallyOptions = TallyOptions()) -> DataFrame:
    return tally.tally_per_transaction(
        inp.ledger, inp.customers, inp.mappings, span=options.neighbor_span, prune_mapping=options.prune_mapping
    )


def per_account_rows(inp: Inputs, options: TallyOptions = TallyOptions()) -> DataFrame:
    if options.attribution == "shifted":
        return activity.account_activity_shifted(inp.ledger, inp.customers, inp.mappings, span=options.neighbor_span)
    return activity.account_activity(
        inp.ledger, inp.customers, inp.mappings, span=options.neighbor_span, prune_mapping=options.prune_mapping
    )


def per_account(inp: Inputs, options: TallyOptions = TallyOptions()) -> DataFrame:
    rows = per_account_rows(inp, options)
    hot = hot_keys(inp.ledger, "account_number", Split(options.neighbor_span))
    return rollup.account_rollup(rows, options.balance_mode, span=options.neighbor_span, hot=hot)


def per_transaction_report(inp: Inputs, options: TallyOptions) -> DataFrame:
    return report.project_report(tally.sort_for_report(per_transaction_rows(inp, options)), options)


def per_account_report(inp: Inputs, options: TallyOptions) -> DataFrame:
    return report.project_report(rollup.sort_rollup(per_account(inp, options)), options)


def read_inputs(
    spark: SparkSession,
    accounts_path: str,
    ledger_path: str,
    mapping_path: str | None = None,
    order_col: str = "seq",
    money: str = "double",
    fmt: str | None = None,
    multi_line: bool | None = None,
    layouts: tuple[str, ...] = EXTRA_DATE_FORMATS,
) -> Inputs:
    """Read and prepare the inputs; a ledger without ``order_col`` is ordered by file order.

    ``fmt`` and ``multi_line`` are the readers' (``readers.read_input``), for
    all three inputs; ``layouts`` the patterns of text dates besides ISO.
    """
    how = {"fmt": fmt, "multi_line": multi_line}
    mappings = prepare_mappings(readers.read_mappings(spark, mapping_path, **how), layouts) if mapping_path else None
    raw_ledger = readers.read_ledger(spark, ledger_path, **how)
    if order_col not in raw_ledger.columns:
        raw_ledger = sequence_from_files(raw_ledger, order_col)
    return Inputs(
        customers=prepare_customers(readers.read_customers(spark, accounts_path, **how)),
        ledger=prepare_ledger(raw_ledger, order_col, money, layouts=layouts),
        mappings=mappings,
    )


def run_pipeline(
    spark: SparkSession,
    accounts_path: str,
    ledger_path: str,
    output_path: str | None = None,
    mapping_path: str | None = None,
    options: TallyOptions = TallyOptions(),
    form: str = "transaction",
    fmt: str | None = None,
    multi_line: bool | None = None,
    layouts: tuple[str, ...] = EXTRA_DATE_FORMATS,
) -> str:
    """Build the report and write it as a CSV folder at ``output_path``.

    Without a path the report goes to ``options.output_path``
    (``output/tally_results.csv`` by default, a folder of CSV parts).
    """
    output_path = output_path or options.output_path
    inp = read_inputs(spark, accounts_path, ledger_path, mapping_path, money=options.money, fmt=fmt, multi_line=multi_line, layouts=layouts)
    if form == "transaction":
        out = per_transaction_report(inp, options)
    elif form == "account":
        out = per_account_report(inp, options)
    else:
        raise ValueError(f"form must be 'transaction' or 'account', not {form!r}")
    readers.write_report_csv(out, output_path)
    return output_path
