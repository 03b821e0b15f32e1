"""Column expressions (JVM-side, codegen-friendly) shared by the operators."""

from ledgerline.functions.dates import as_date, date_text
from ledgerline.functions.money import exact_sum, lenient_double, round_money
from ledgerline.functions.text import extract_txn_number, has_number, number_or_null

__all__ = [
    "as_date",
    "date_text",
    "exact_sum",
    "extract_txn_number",
    "has_number",
    "lenient_double",
    "number_or_null",
    "round_money",
]
