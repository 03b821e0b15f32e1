"""Sources and sinks: input readers, the CSV report sink, derived fixtures."""

from ledgerline.sources.readers import (
    read_batches,
    read_customers,
    read_ledger,
    read_mappings,
    read_report_csv,
    write_report_csv,
)

__all__ = [
    "read_batches",
    "read_customers",
    "read_ledger",
    "read_mappings",
    "read_report_csv",
    "write_report_csv",
]
