"""Command line: build a tally report with spark-submit (or python -m ledgerline).

Example::

    spark-submit -m ledgerline --customers s3://.../customers.csv --ledger s3://.../ledger/ \
        --mapping s3://.../transactions.csv --output s3://.../report --form transaction \
        --dates --debit --credit --opening-balance
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from ledgerline.config import DEFAULT_SPAN, TallyOptions
from ledgerline.functions.dates import EXTRA_DATE_FORMATS
from ledgerline.plans.jobs import run_pipeline


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="ledgerline", description="Ledger tally report on Spark")
    p.add_argument("--customers", required=True, help="customer table (CSV or Parquet)")
    p.add_argument("--ledger", required=True, help="ledger table (CSV or Parquet); file order if it has no seq")
    p.add_argument("--mapping", help="optional table of dated transaction numbers")
    p.add_argument("--output", help="output folder for the CSV report (default output/tally_results.csv)")
    p.add_argument("--form", choices=("transaction", "account"), default="transaction")
    for flag in ("dates", "debit", "credit", "opening-balance", "closing-balance", "customer-amount"):
        p.add_argument(f"--{flag}", action="store_true", help=f"include the {flag.replace('-', ' ')} column")
    p.add_argument("--balance-mode", choices=("minmax", "boundary"), default="minmax")
    p.add_argument("--attribution", choices=("own", "shifted"), default="own")
    p.add_argument("--money", choices=("double", "cents"), default="double", help="amount equality rule")
    p.add_argument("--format", choices=("csv", "parquet"), help="format of the inputs (default: by ending, else by the files)")
    p.add_argument("--multi-line", choices=("auto", "yes", "no"), default="auto", help="line breaks inside quoted CSV values")
    p.add_argument("--date-layout", action="append", default=[], metavar="PATTERN", help="text dates besides ISO, e.g. dd.MM.yyyy; may be repeated")
    p.add_argument("--prune-mapping", action="store_true", help="drop mapping rows that match nothing before the join (a large mapping)")
    p.add_argument("--span", type=int, default=DEFAULT_SPAN, help="rows per window group bound (seq units)")
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    a = parse_args(argv)
    options = TallyOptions(
        include_dates=a.dates,
        include_debit=a.debit,
        include_credit=a.credit,
        include_opening_balance=a.opening_balance,
        include_closing_balance=a.closing_balance,
        include_customer_amount=a.customer_amount,
        neighbor_span=a.span,
        balance_mode=a.balance_mode,
        attribution=a.attribution,
        money=a.money,
        prune_mapping=a.prune_mapping,
    )
    spark = SparkSession.builder.appName("ledgerline").getOrCreate()
    multi_line = {"auto": None, "yes": True, "no": False}[a.multi_line]
    layouts = (*a.date_layout, *EXTRA_DATE_FORMATS)
    run_pipeline(spark, a.customers, a.ledger, a.output, a.mapping, options, a.form, a.format, multi_line, layouts)


if __name__ == "__main__":
    main()
