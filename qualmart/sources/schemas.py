"""Schemas of the landing feeds, staging tables and star schema, plus the fixed lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DateType, DecimalType, IntegerType, LongType,
                               ShortType, StringType, StructField, StructType)

from qualmart.sources.tables import Layout

SCORE = DecimalType(10, 3)

# --- fixed values: landing feed columns and maximum text lengths ------------------------------
# Outcomes feed ("complications and deaths"), 18 text columns.
OUTCOMES_COLUMNS = [
    ("FacilityID", 10), ("FacilityName", 100), ("Address", 100), ("City", 50), ("State", 2),
    ("ZipCode", 5), ("CountyName", 50), ("PhoneNumber", 20), ("MeasureID", 50),
    ("MeasureName", 100), ("ComparedToNational", 50), ("Denominator", 20), ("Score", 20),
    ("LowerEstimate", 20), ("HigherEstimate", 20), ("Footnote", 10), ("StartDate", 10),
    ("EndDate", 10),
]
# Infections feed ("healthcare associated infections"): the same without Denominator,
# LowerEstimate and HigherEstimate.
INFECTIONS_COLUMNS = [c for c in OUTCOMES_COLUMNS
                      if c[0] not in ("Denominator", "LowerEstimate", "HigherEstimate")]

# --- fixed values: lookups ----------------------------------------------------------------------
MEASURE_TYPES = [
    (1, "Complications and Deaths"),
    (2, "Healthcare Associated Infections"),
]
SORT_ORDERS = [
    (0, "Descending - Largest Score Is High Rank"),
    (1, "Ascending - Largest Score Is Low Rank"),
    (2, "Unknown"),
]
OUTCOMES_TYPE_ID = 1
INFECTIONS_TYPE_ID = 2
# ------------------------------------------------------------------------------------------------

def text_schema(columns) -> StructType:
    return StructType([StructField(name, StringType(), True) for name, _ in columns])


OUTCOMES_SCHEMA = text_schema(OUTCOMES_COLUMNS)
INFECTIONS_SCHEMA = text_schema(INFECTIONS_COLUMNS)


def _s(fields) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


FACILITIES_SCHEMA = _s([
    ("FacilityID", LongType(), False), ("FacilityCode", StringType(), True),
    ("FacilityName", StringType(), False), ("Address", StringType(), True),
    ("City", StringType(), True), ("State", StringType(), False),
    ("ZipCode", StringType(), True), ("CountyName", StringType(), False),
    ("PhoneNumber", StringType(), True),
])
MEASURES_SCHEMA = _s([
    ("MeasureID", ShortType(), False), ("MeasureCode", StringType(), False),
    ("MeasureName", StringType(), False), ("MeasureTypeID", ShortType(), False),
    ("SortOrderID", ShortType(), False), ("NationalScoreMax", SCORE, False),
    ("NationalScoreMin", SCORE, False), ("NationalScoreAverage", SCORE, False),
])
FACILITY_MEASURES_SCHEMA = _s([
    ("FacilityMeasureID", LongType(), False), ("FacilityID", LongType(), False),
    ("MeasureID", ShortType(), False), ("ComparedToNational", StringType(), True),
    ("Denominator", SCORE, True), ("Score", SCORE, True), ("LowerEstimate", SCORE, True),
    ("HigherEstimate", SCORE, True), ("Footnote", StringType(), True),
    ("StartDate", DateType(), False), ("EndDate", DateType(), False),
])
MEASURE_TYPES_SCHEMA = _s([("MeasureTypeID", ShortType(), False),
                           ("MeasureTypeName", StringType(), False)])
SORT_ORDERS_SCHEMA = _s([("MeasureSortOrderID", ShortType(), False),
                         ("MeasureSortOrderName", StringType(), False)])
DIM_FACILITY_SCHEMA = _s([
    ("FacilityKey", LongType(), False), ("FacilityID", LongType(), False),
    ("FacilityName", StringType(), False), ("FacilityAddress", StringType(), True),
    ("FacilityCity", StringType(), True), ("FacilityState", StringType(), False),
    ("FacilityZipCode", StringType(), True), ("FacilityCountyName", StringType(), False),
    ("FacilityPhoneNumber", StringType(), True),
])
DIM_DATE_SCHEMA = _s([
    ("DateKey", IntegerType(), False), ("Date", DateType(), False),
    ("DayOfMonth", ShortType(), False), ("MonthNumber", ShortType(), False),
    ("MonthName", StringType(), False), ("Year", ShortType(), False),
    ("DayOfWeekName", StringType(), False), ("DayOfWeekNumber", ShortType(), False),
    ("IsWeekend", BooleanType(), False),
])
FACT_MEASURE_SCHEMA = _s([
    ("MeasureKey", LongType(), False), ("MeasureID", ShortType(), False),
    ("FacilityKey", LongType(), False), ("FacilityID", LongType(), False),
    ("FacilityMeasureID", LongType(), False), ("MeasureName", StringType(), False),
    ("ScoreComparedToNational", StringType(), True), ("Score", SCORE, True),
    ("NationalScoreHigh", SCORE, False), ("NationalScoreLow", SCORE, False),
    ("NationalScoreAverage", SCORE, False), ("MeasureSortOrderName", StringType(), False),
    ("MeasureSortOrderNumber", ShortType(), False), ("MeasureTypeName", StringType(), False),
    ("StartDate", DateType(), False), ("EndDate", DateType(), False),
    ("StartDateKey", IntegerType(), False), ("EndDateKey", IntegerType(), False),
])

# --- fixed values: declared maximum text lengths of the staging and star tables -----------------
TEXT_LIMITS = {
    "facilities": {"FacilityCode": 10, "FacilityName": 100, "Address": 100, "City": 50,
                   "State": 2, "ZipCode": 5, "CountyName": 50, "PhoneNumber": 20},
    "measures": {"MeasureCode": 50, "MeasureName": 100},
    "facility_measures": {"ComparedToNational": 100, "Footnote": 10},
    "measure_types": {"MeasureTypeName": 100},
    "sort_orders": {"MeasureSortOrderName": 100},
    "dim_facility": {"FacilityName": 100, "FacilityAddress": 100, "FacilityCity": 50,
                     "FacilityState": 2, "FacilityZipCode": 5, "FacilityCountyName": 50,
                     "FacilityPhoneNumber": 20},
    "dim_date": {"MonthName": 10, "DayOfWeekName": 10},
    "fact_measure": {"MeasureName": 100, "ScoreComparedToNational": 100,
                     "MeasureSortOrderName": 100, "MeasureTypeName": 100},
}
# ------------------------------------------------------------------------------------------------

# Primary keys, foreign keys, NOT NULL columns per table shape (declared constraints).
TABLES = {
    "facilities": (FACILITIES_SCHEMA, ["FacilityID"]),
    "measures": (MEASURES_SCHEMA, ["MeasureID"]),
    "facility_measures": (FACILITY_MEASURES_SCHEMA, ["FacilityMeasureID"]),
    "measure_types": (MEASURE_TYPES_SCHEMA, ["MeasureTypeID"]),
    "sort_orders": (SORT_ORDERS_SCHEMA, ["MeasureSortOrderID"]),
    "dim_facility": (DIM_FACILITY_SCHEMA, ["FacilityKey"]),
    "dim_date": (DIM_DATE_SCHEMA, ["DateKey"]),
    "fact_measure": (FACT_MEASURE_SCHEMA, ["MeasureKey"]),
}
FOREIGN_KEYS = {
    "measures": [("MeasureTypeID", "measure_types", "MeasureTypeID")],
    "facility_measures": [("FacilityID", "facilities", "FacilityID"),
                          ("MeasureID", "measures", "MeasureID")],
    "fact_measure": [("FacilityKey", "dim_facility", "FacilityKey"),
                     ("StartDateKey", "dim_date", "DateKey"),
                     ("EndDateKey", "dim_date", "DateKey")],
}

# Tables that merges read again and again, bucketed by their merge keys. The fact is also partitioned by
# the year of its start date, so that a slicer on the calendar reads the years it needs.
_BY_MEASURE = Layout(keys=("MeasureID", "FacilityID"))
LAYOUTS = {
    "us_facility_measures": _BY_MEASURE,
    "regional_facility_measures": _BY_MEASURE,
    "fact_measure": Layout(keys=("FacilityID", "MeasureID", "FacilityMeasureID"),
                           sort=("MeasureName", "StartDateKey"), partition=("StartYear",)),
}


def shape_of(table: str) -> str:
    """Key of ``TABLES`` for a published table (national and regional copies share a shape)."""
    return table.split("_", 1)[1] if table.startswith(("us_", "regional_")) else table


def not_null_columns(schema: StructType) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select and cast to a declared schema (column order and types)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def measure_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(MEASURE_TYPES, MEASURE_TYPES_SCHEMA)


def sort_orders(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SORT_ORDERS, SORT_ORDERS_SCHEMA)
