"""Turning all-text feed columns into typed values.

Sentinel handling happens inside the same ``CASE`` as the cast, so a later filter can never be
reordered in front of a failing cast (ANSI mode), and nothing leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from qualmart.functions.textkeys import _col, ci_isin

# --- fixed values (must equal the source warehouse) -------------------------------------------
NOT_AVAILABLE = "Not Available"
NOT_COMPUTED = "--"
# Score statistics treat both markers as missing.
STAT_SENTINELS = (NOT_AVAILABLE, NOT_COMPUTED)
# Row-level values: outcomes feed knows only "Not Available"; infections feed knows both.
OUTCOMES_SENTINELS = (NOT_AVAILABLE,)
INFECTIONS_SENTINELS = (NOT_AVAILABLE, NOT_COMPUTED)
SCORE_TYPE = DecimalType(10, 3)
# Feed date text format (assumed; the public feed writes month/day/year).
DEFAULT_DATE_FORMAT = "MM/dd/yyyy"
# ------------------------------------------------------------------------------------------

STRICT = "strict"
LENIENT = "lenient"


def null_if_in(c: str | Column, sentinels: Iterable[str]) -> Column:
    """NULL when the text equals one of ``sentinels`` (case-insensitively), else the text."""
    column = _col(c)
    return F.when(ci_isin(column, list(sentinels)), F.lit(None).cast("string")).otherwise(column)


def to_decimal(c: str | Column, sentinels: Iterable[str] = STAT_SENTINELS, mode: str = STRICT,
               dtype: DecimalType = SCORE_TYPE) -> Column:
    """Text → decimal(10,3). Sentinels → NULL. Anything else unparseable raises (strict, like the
    source warehouse) or becomes NULL (lenient; count those with ``quality.reject_profile``)."""
    column = _col(c)
    cast = column.try_cast(dtype) if mode == LENIENT else column.cast(dtype)
    return F.when(ci_isin(column, list(sentinels)), F.lit(None).cast(dtype)).otherwise(cast)


def is_reject(c: str | Column, sentinels: Iterable[str] = STAT_SENTINELS,
              dtype: DecimalType = SCORE_TYPE) -> Column:
    """True where a value is present, not a sentinel, and still does not convert."""
    column = _col(c)
    return column.isNotNull() & ~ci_isin(column, list(sentinels)) & column.try_cast(dtype).isNull()


def is_date_reject(c: str | Column, fmt: str = DEFAULT_DATE_FORMAT) -> Column:
    """True where a date text is present and does not convert."""
    column = _col(c)
    return column.isNotNull() & F.try_to_date(column, fmt).isNull()


def to_feed_date(c: str | Column, fmt: str = DEFAULT_DATE_FORMAT, mode: str = STRICT) -> Column:
    column = _col(c)
    if mode == LENIENT:
        return F.try_to_date(column, fmt)
    return F.to_date(column, fmt)


def null_decimal(dtype: DecimalType = SCORE_TYPE) -> Column:
    """NULL padding that keeps the decimal type through a UNION."""
    return F.lit(None).cast(dtype)
