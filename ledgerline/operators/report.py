"""Config-driven column choice of the report."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerline.config import TallyOptions

# The column order of the report.
LEADING = ("account_number", "customer_name", "transaction_nos")
OPTIONAL = (
    ("include_dates", "dates"),
    ("include_debit", "total_debit"),
    ("include_credit", "total_credit"),
    ("include_opening_balance", "opening_balance"),
    ("include_closing_balance", "closing_balance"),
    ("include_customer_amount", "customer_amount"),
)
TRAILING = ("debit_count", "credit_count", "tally_value")


def report_columns(options: TallyOptions) -> list[str]:
    chosen = [name for flag, name in OPTIONAL if getattr(options, flag)]
    return [*LEADING, *chosen, *TRAILING]


def project_report(result: DataFrame, options: TallyOptions) -> DataFrame:
    """Keep the leading columns, the flagged optional ones, then the counts and tally."""
    return result.select(*report_columns(options))
