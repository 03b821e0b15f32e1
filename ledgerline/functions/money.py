"""Money arithmetic as JVM-side column expressions.

Two rules keep Spark results equal to the reference's SQL engine:

* ``round_money``: half-away-from-zero at two places is computed on ``x * 100``
  rounded to an integer, then divided back.  ``F.round(x, 2)`` rounds the
  decimal expansion of the double instead and disagrees on values such as
  1.005 (binary 1.00499999...), so it is never used for money.
* ``exact_sum``: sums of already-rounded amounts are taken as DECIMAL, so the
  result does not depend on partition or arrival order.  NaN and infinities
  cannot be decimals; when present they propagate as a double sum would.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Scale used for money arithmetic and the decimal type of sums.
MONEY_SCALE = 100.0
SUM_DECIMAL = "decimal(38,2)"


def round_money(c: Column | str) -> Column:
    """ROUND(x, 2) with half-away-from-zero on ``x * 100`` (null stays null)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c * F.lit(MONEY_SCALE), 0) / F.lit(MONEY_SCALE)


# The number text accepted by the lenient cast -- decimal or
# exponent notation, or nan/inf/infinity, with optional sign and blanks.  Spark's
# own cast would also take Java suffixes such as '1.5d'; those become null here.
NUMBER_TEXT = r"^\s*[+-]?((\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?|(?i:nan|inf|infinity))\s*$"


def lenient_double(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """Text or number to DOUBLE; unparsable text becomes null instead of an error."""
    c = F.col(c) if isinstance(c, str) else c
    if dtype is None or isinstance(dtype, T.StringType):
        text = c.cast("string")
        return F.when(text.rlike(NUMBER_TEXT), _try_cast(text, "double"))
    return _try_cast(c, "double")


def _try_cast(c: Column, to: str) -> Column:
    # Column.try_cast exists since Spark 4.0; it keeps the plan JVM-side.
    return c.try_cast(to)


def exact_sum(c: Column | str) -> Column:
    """SUM of two-decimal amounts, exact; NaN/inf propagate like a double sum."""
    c = F.col(c) if isinstance(c, str) else c
    as_double = F.sum(c)
    as_decimal = F.sum(_try_cast(c, SUM_DECIMAL)).cast("double")
    special = F.isnan(as_double) | (F.abs(as_double) == F.lit(float("inf")))
    return F.when(special, as_double).otherwise(as_decimal)
