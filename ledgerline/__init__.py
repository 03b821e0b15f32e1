"""ledgerline: ledger reconciliation (DR/CR pairing, tally, rollup) on Spark."""

from ledgerline.config import REPORT_OPTIONS, TallyOptions

__all__ = ["REPORT_OPTIONS", "TallyOptions"]
