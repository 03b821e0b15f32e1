"""Options of a tally run (the reference's config dict, typed)."""

from __future__ import annotations

from dataclasses import dataclass

# Rows of one account are cut into buckets of this many ``seq`` units before any
# per-account window, so a hot account never lands in a single task.  With a
# dense ``seq`` (row position) it bounds a window group to 4M rows.
DEFAULT_SPAN = 1 << 22

# The reference's default output folder, file name and chunk size.
DEFAULT_OUTPUT_DIR = "output"
DEFAULT_OUTPUT_FILENAME = "tally_results.csv"
DEFAULT_CHUNK_SIZE = 10000


@dataclass(frozen=True)
class TallyOptions:
    """Column flags (all off by default, as in the reference) and engine knobs."""

    include_dates: bool = False
    include_debit: bool = False
    include_credit: bool = False
    include_opening_balance: bool = False
    include_closing_balance: bool = False
    include_customer_amount: bool = False
    # Span of the per-account buckets used by neighbour lookups and rollups.
    neighbor_span: int = DEFAULT_SPAN
    # Per-account rollup: "minmax" (MIN opening / MAX closing, as written) or
    # "boundary" (opening of the first row / closing of the last row by seq).
    balance_mode: str = "minmax"
    # Credit attribution of the per-account form: "own" (the row's own paired
    # credit) or "shifted" (the literal LEAD over kept rows).
    attribution: str = "own"
    # Drop the mapping's rows that match no ledger row by a Bloom filter, before
    # they are shuffled (for a mapping far larger than the ledger's debits).
    prune_mapping: bool = False
    # Ledger money: "double" (as read; exact double equality pairs, as in the
    # reference) or "cents" (DECIMAL(18,2) reading: amounts rounded to cents).
    money: str = "double"
    # Rows of the positional chunking (``ledger_slice``).
    chunk_size: int = DEFAULT_CHUNK_SIZE
    # Where ``run_pipeline`` writes when no output path is given (a folder of CSV parts).
    output_dir: str = DEFAULT_OUTPUT_DIR
    output_filename: str = DEFAULT_OUTPUT_FILENAME

    @property
    def output_path(self) -> str:
        return f"{self.output_dir.rstrip('/')}/{self.output_filename}"

    def __post_init__(self) -> None:
        if self.balance_mode not in ("minmax", "boundary"):
            raise ValueError(f"balance_mode must be 'minmax' or 'boundary', not {self.balance_mode!r}")
        if self.attribution not in ("own", "shifted"):
            raise ValueError(f"attribution must be 'own' or 'shifted', not {self.attribution!r}")
        if self.money not in ("double", "cents"):
            raise ValueError(f"money must be 'double' or 'cents', not {self.money!r}")
        if self.neighbor_span <= 0 or self.chunk_size <= 0:
            raise ValueError("neighbor_span and chunk_size must be positive")


# The column choice the reference's script runs with.
REPORT_OPTIONS = TallyOptions(
    include_dates=True,
    include_debit=True,
    include_credit=True,
    include_opening_balance=True,
)
