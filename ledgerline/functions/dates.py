"""Date handling for ledger and mapping dates.

Dates arrive "as read": a DATE/TIMESTAMP column from Parquet or text from CSV.
Text is parsed leniently (bad text -> null), never with an error, because one
malformed row must not fail a job over the whole ledger.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text date layouts accepted besides ISO ``yyyy-MM-dd``, and the
# shape an ISO date must have (Spark's cast would also take '2024' or '2024-01').
EXTRA_DATE_FORMATS = ("yyyy/MM/dd",)
ISO_DATE_TEXT = r"^\s*\d{4}-\d{1,2}-\d{1,2}([ T].*)?$"


def as_date(c: Column, dtype: T.DataType, layouts: tuple[str, ...] = EXTRA_DATE_FORMATS) -> Column:
    """Cast a column of type ``dtype`` to DATE, leniently for text.

    Text is read as ISO, else by the first of ``layouts`` (date patterns such
    as ``dd.MM.yyyy``) that fits it; put the intended one of ambiguous patterns
    first.
    """
    if isinstance(dtype, T.DateType):
        return c
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return c.cast("date")
    text = c.cast("string")
    parsed = [F.when(text.rlike(ISO_DATE_TEXT), text.try_cast("date"))]
    parsed += [F.try_to_date(F.trim(text), fmt) for fmt in layouts]
    return F.coalesce(*parsed)


def date_text(c: Column | str) -> Column:
    """DATE as ISO text, as ``CAST(d AS VARCHAR)`` gives it."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("string")
