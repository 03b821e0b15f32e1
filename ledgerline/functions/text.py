"""Predicates and extraction on transaction-number text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The narration pattern for a transaction number, matched
# case-insensitively with Unicode classes (as a Python ``re`` pattern would).
TXN_PATTERN = r"(?iU)Txn No:\s*(TXN\w+)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def has_number(c: Column | str) -> Column:
    """A transaction number is present: not null and not the empty string."""
    c = _col(c)
    return c.isNotNull() & (c != F.lit(""))


def number_or_null(c: Column | str) -> Column:
    """Empty text becomes null; other values pass through."""
    return F.nullif(_col(c), F.lit(""))


def extract_txn_number(c: Column | str) -> Column:
    """First ``Txn No: TXN...`` number in a narration, else null.

    Null, empty and no-match give null; the text 'nan' cannot match.
    """
    return F.nullif(F.regexp_extract(_col(c), TXN_PATTERN, 1), F.lit(""))
