"""Date dimension: generated, guarded sentinels, model view."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qualmart.functions.calendar import calendar_columns, described_columns
from qualmart.sources.schemas import DIM_DATE_SCHEMA, conform

# --- fixed values -----------------------------------------------------------------------------
DEFAULT_START, DEFAULT_END = "2015-01-01", "2030-01-01"
BEGINNING_OF_TIME, END_OF_TIME = "1900-01-01", "9999-01-01"
# ------------------------------------------------------------------------------------------------


def _days(start: str, end: str) -> int:
    return (dt.date.fromisoformat(end) - dt.date.fromisoformat(start)).days + 1


def date_dim(spark: SparkSession, start: str = DEFAULT_START, end: str = DEFAULT_END,
             num_partitions: int | None = None) -> DataFrame:
    """One row per day, both ends included. Built from ``spark.range`` so the rows are generated
    in parallel; the row count is fixed by the parameters, not by any data."""
    n = max(_days(start, end), 0)
    parts = num_partitions or max(1, min(n // 4096 + 1, 64))
    days = spark.range(0, n, 1, parts).select(
        F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("Date"))
    return conform(days.select(*[e.alias(k) for k, e in calendar_columns("Date").items()]),
                   DIM_DATE_SCHEMA)


def sentinel_dates(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame([(BEGINNING_OF_TIME,), (END_OF_TIME,)], "d string")
    return conform(rows.select(*[e.alias(k) for k, e in
                                 calendar_columns(F.col("d").cast("date")).items()]),
                   DIM_DATE_SCHEMA)


def insert_if_absent(existing: DataFrame, candidates: DataFrame, key: str = "DateKey"
                     ) -> DataFrame:
    """``existing`` plus the ``candidates`` whose key is not present yet (NOT EXISTS guard)."""
    return existing.unionByName(candidates.join(existing.select(key), key, "left_anti"))


def calendar(spark: SparkSession, start: str = DEFAULT_START, end: str = DEFAULT_END,
             existing: DataFrame | None = None) -> DataFrame:
    """The full date dimension: guarded sentinels first, then the daily rows (not guarded)."""
    base = existing if existing is not None else spark.createDataFrame([], DIM_DATE_SCHEMA)
    with_sentinels = insert_if_absent(base, sentinel_dates(spark))
    return with_sentinels.unionByName(date_dim(spark, start, end))


def model_dates(dim_date: DataFrame, today: str) -> DataFrame:
    """The model's Date table: days before ``today`` except the beginning-of-time row (the
    end-of-time row falls out by the same filter), with description columns, ordered by date."""
    kept = dim_date.where((F.col("Date") < F.lit(today).cast("date"))
                          & (F.col("Date") != F.lit(BEGINNING_OF_TIME).cast("date")))
    return kept.withColumns(described_columns()).orderBy("Date")
