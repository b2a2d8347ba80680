"""Typing and slicing of landing feeds (all-text rows → typed rows)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualmart.functions.clean import (DEFAULT_DATE_FORMAT, INFECTIONS_SENTINELS, NOT_AVAILABLE,
                                      OUTCOMES_SENTINELS, STAT_SENTINELS, STRICT, null_decimal,
                                      null_if_in, to_decimal, to_feed_date)
from qualmart.functions.textkeys import ci_eq, ci_isin
from qualmart.sources.schemas import INFECTIONS_TYPE_ID, OUTCOMES_TYPE_ID

OUTCOMES = "outcomes"
INFECTIONS = "infections"

#: Per feed: its decimal columns and the markers that its rows use for a missing number.
ROW_RULES = {
    OUTCOMES: (("Denominator", "Score", "LowerEstimate", "HigherEstimate"), OUTCOMES_SENTINELS),
    INFECTIONS: (("Score",), INFECTIONS_SENTINELS),
}

TYPED_COLUMNS = [
    "FacilityCode", "FacilityName", "Address", "City", "State", "ZipCode", "CountyName",
    "PhoneNumber", "MeasureCode", "MeasureName", "MeasureTypeID", "ComparedToNational",
    "Denominator", "Score", "LowerEstimate", "HigherEstimate", "Footnote", "StartDate", "EndDate",
    "StatScore",
]


def typed_feed(feed: DataFrame, kind: str, mode: str = STRICT,
               date_format: str = DEFAULT_DATE_FORMAT) -> DataFrame:
    """Typed view of one landing feed.

    ``Score`` follows the row-level rule of each feed (outcomes: only "Not Available" is missing,
    so "--" fails in strict mode; infections: both markers are missing). ``StatScore`` is the value
    the national statistics use (both markers missing). Unused columns are pruned by Catalyst, so
    a statistics-only plan never evaluates the stricter row-level cast.
    """
    outcomes = kind == OUTCOMES
    numbers, row_sentinels = ROW_RULES[kind]

    def num(c: str) -> Column:
        return to_decimal(c, row_sentinels, mode) if c in numbers else null_decimal()

    return feed.select(
        F.col("FacilityID").alias("FacilityCode"),
        "FacilityName", "Address", "City", "State", "ZipCode", "CountyName", "PhoneNumber",
        F.col("MeasureID").alias("MeasureCode"),
        "MeasureName",
        F.lit(OUTCOMES_TYPE_ID if outcomes else INFECTIONS_TYPE_ID).cast("short")
         .alias("MeasureTypeID"),
        null_if_in("ComparedToNational", [NOT_AVAILABLE]).alias("ComparedToNational"),
        num("Denominator").alias("Denominator"),
        to_decimal("Score", row_sentinels, mode).alias("Score"),
        num("LowerEstimate").alias("LowerEstimate"),
        num("HigherEstimate").alias("HigherEstimate"),
        "Footnote",
        to_feed_date("StartDate", date_format, mode).alias("StartDate"),
        to_feed_date("EndDate", date_format, mode).alias("EndDate"),
        to_decimal("Score", STAT_SENTINELS, mode).alias("StatScore"),
    )


def region_predicate(state: str, counties: Iterable[str]) -> Column:
    """``State = s AND CountyName IN (...)`` under case-insensitive comparison."""
    return ci_eq("State", state) & ci_isin("CountyName", list(counties))


def region_slice(df: DataFrame, state: str, counties: Iterable[str]) -> DataFrame:
    return df.where(region_predicate(state, counties))
