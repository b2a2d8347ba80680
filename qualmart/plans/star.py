"""Star schema: facility dimension and score fact, plus the flat reports over it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualmart.operators.upsert import upsert
from qualmart.sources.schemas import DIM_FACILITY_SCHEMA, FACT_MEASURE_SCHEMA

# --- fixed values: star columns and the staging columns they come from ---------------------------
DIM_ATTRS = {
    "FacilityAddress": "Address", "FacilityCity": "City", "FacilityState": "State",
    "FacilityZipCode": "ZipCode", "FacilityCountyName": "CountyName",
    "FacilityPhoneNumber": "PhoneNumber",
}
FACT_UPDATE = {
    "ScoreComparedToNational": "ComparedToNational", "Score": "Score",
    "NationalScoreHigh": "NationalScoreMax", "NationalScoreLow": "NationalScoreMin",
    "NationalScoreAverage": "NationalScoreAverage", "StartDate": "StartDate",
    "EndDate": "EndDate", "StartDateKey": "StartDateKey", "EndDateKey": "EndDateKey",
}
# ------------------------------------------------------------------------------------------------


def upsert_dim_facility(target: DataFrame, facilities: DataFrame,
                        target_empty: bool = False) -> DataFrame:
    """Facility dimension from the regional staging facilities, matched by name."""
    return upsert(
        target, facilities, on=[("FacilityName", "FacilityName")],
        update={"FacilityID": "FacilityID", **DIM_ATTRS},
        insert={"FacilityID": "FacilityID", "FacilityName": "FacilityName", **DIM_ATTRS},
        key_col="FacilityKey", order=["FacilityName", "FacilityID"],
        schema=DIM_FACILITY_SCHEMA, target_empty=target_empty)


def fact_source(fm: DataFrame, measures: DataFrame, measure_types: DataFrame,
                sort_orders: DataFrame, dim_facility: DataFrame, dim_date: DataFrame
                ) -> DataFrame:
    """Seven-way inner join assembling fact rows. The date dimension is joined twice (start and
    end role), so facts dated outside the calendar drop out."""
    m = measures.select("MeasureID", "MeasureName", "MeasureTypeID", "SortOrderID",
                        "NationalScoreMax", "NationalScoreMin", "NationalScoreAverage")
    start = dim_date.select(F.col("Date").alias("StartDate"), F.col("DateKey").alias("StartDateKey"))
    end = dim_date.select(F.col("Date").alias("EndDate"), F.col("DateKey").alias("EndDateKey"))
    return (fm.join(m, "MeasureID")
              .join(measure_types, "MeasureTypeID")
              .join(sort_orders, F.col("SortOrderID") == F.col("MeasureSortOrderID"))
              .join(dim_facility.select("FacilityID", "FacilityKey"), "FacilityID")
              .join(start, "StartDate")
              .join(end, "EndDate")
              .select("FacilityMeasureID", "MeasureID", "FacilityKey", "FacilityID",
                      "MeasureName", "ComparedToNational", "Score", "NationalScoreMax",
                      "NationalScoreMin", "NationalScoreAverage", "MeasureSortOrderName",
                      "MeasureSortOrderID", "MeasureTypeName", "StartDate", "EndDate",
                      "StartDateKey", "EndDateKey"))


def upsert_fact(target: DataFrame, source: DataFrame, target_empty: bool = False,
                spread: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Fact upsert on (facility, measure, facility measure). On match only the values and dates
    are refreshed; facility key, measure name, sort order and type stay as first inserted."""
    insert = {
        "MeasureID": "MeasureID", "FacilityKey": "FacilityKey", "FacilityID": "FacilityID",
        "FacilityMeasureID": "FacilityMeasureID", "MeasureName": "MeasureName",
        "MeasureSortOrderName": "MeasureSortOrderName",
        "MeasureSortOrderNumber": "MeasureSortOrderID", "MeasureTypeName": "MeasureTypeName",
        **FACT_UPDATE,
    }
    return upsert(
        target, source,
        on=[("FacilityID", "FacilityID"), ("MeasureID", "MeasureID"),
            ("FacilityMeasureID", "FacilityMeasureID")],
        update=FACT_UPDATE, insert=insert, key_col="MeasureKey",
        order=["FacilityMeasureID", "FacilityID", "MeasureID"], schema=FACT_MEASURE_SCHEMA,
        target_empty=target_empty, spread=spread)


def with_start_year(fact: DataFrame) -> DataFrame:
    """The fact with its partition column; the calendar's ``Year`` of the start date."""
    return fact.withColumn("StartYear", F.year("StartDate"))


def facts_outside_calendar(fm: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Facility-measure rows whose start or end date has no calendar row (they never reach the
    fact table)."""
    dates = dim_date.select("Date")
    missing_start = fm.join(dates, fm.StartDate == dates.Date, "left_anti")
    missing_end = fm.join(dates, fm.EndDate == dates.Date, "left_anti")
    return missing_start.unionByName(missing_end).distinct()


def flat_fact_report(fact: DataFrame, dim_facility: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Fact ⋈ facility ⋈ start date ⋈ end date (inner, on keys)."""
    s = dim_date.select(F.col("DateKey").alias("StartDateKey"),
                        F.col("Year").alias("StartYear"),
                        F.col("MonthName").alias("StartMonthName"),
                        F.col("DayOfWeekName").alias("StartDayOfWeekName"))
    e = dim_date.select(F.col("DateKey").alias("EndDateKey"), F.col("Year").alias("EndYear"),
                        F.col("MonthName").alias("EndMonthName"),
                        F.col("DayOfWeekName").alias("EndDayOfWeekName"))
    return (fact.drop("StartYear").join(dim_facility.drop("FacilityID"), "FacilityKey")
                .join(s, "StartDateKey").join(e, "EndDateKey"))


def fact_dim_left(fact: DataFrame, dim_facility: DataFrame) -> DataFrame:
    """Facility name, measure name and score: fact left-joined to the facility dimension."""
    return (fact.join(dim_facility.select("FacilityKey", "FacilityName"), "FacilityKey", "left")
                .select("FacilityName", "MeasureName", "Score")
                .orderBy("FacilityName", "MeasureName"))
