"""Calendar attributes of a date column (all built-in, codegen'd expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from qualmart.functions.textkeys import _col

# --- fixed values -----------------------------------------------------------------------------
# Day-of-week numbering: Sunday = 1 … Saturday = 7; weekend = day 1 or 7.
WEEKEND_DAYS = (1, 7)
WEEKEND_LABEL, WEEKDAY_LABEL = "Weekend", "Weekday"
# ------------------------------------------------------------------------------------------------


def date_key(c: str | Column) -> Column:
    """yyyymmdd as an int."""
    return F.date_format(_col(c), "yyyyMMdd").cast("int")


def calendar_columns(c: str | Column) -> dict[str, Column]:
    d = _col(c)
    dow = F.dayofweek(d)
    return {
        "DateKey": date_key(d),
        "Date": d,
        "DayOfMonth": F.dayofmonth(d).cast("short"),
        "MonthNumber": F.month(d).cast("short"),
        "MonthName": F.date_format(d, "MMMM"),
        "Year": F.year(d).cast("short"),
        "DayOfWeekName": F.date_format(d, "EEEE"),
        "DayOfWeekNumber": dow.cast("short"),
        "IsWeekend": dow.isin(*WEEKEND_DAYS),
    }


def _text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def described_columns() -> dict[str, Column]:
    """Descriptions over a date-dimension row. Text concatenation treats NULL as empty."""
    return {
        "MonthDescription": F.concat(_text("MonthNumber"), F.lit(" - "), _text("MonthName")),
        "DayOfWeekDescription": F.concat(_text("DayOfWeekNumber"), F.lit(" - "),
                                         _text("DayOfWeekName")),
        "DayLongDescription": F.concat(_text("DayOfWeekName"), F.lit(", "), _text("MonthName"),
                                       F.lit(" "), _text("DayOfMonth"), F.lit(", "),
                                       _text("Year")),
        "IsWeekendLabel": F.when(F.col("IsWeekend"), F.lit(WEEKEND_LABEL))
                           .otherwise(F.lit(WEEKDAY_LABEL)),
    }
