"""Staging layer: facilities, measures and facility measures (national and regional).

Each ``*_source`` builds the MERGE source as a lazy plan; each ``upsert_*`` applies it to the
previous version of the table with ``operators.upsert.upsert``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from qualmart.functions.textkeys import ci_key
from qualmart.operators.benchmark import (measure_benchmarks, measure_label_summary,
                                          regional_measure_benchmarks)
from qualmart.operators.feeds import region_slice
from qualmart.operators.keys import assign_keys_in_buckets
from qualmart.operators.setops import ci_distinct, ci_distinct_in_place, ci_union
from qualmart.operators.upsert import upsert
from qualmart.sources.schemas import (FACILITIES_SCHEMA, FACILITY_MEASURES_SCHEMA,
                                      INFECTIONS_TYPE_ID, MEASURES_SCHEMA, OUTCOMES_TYPE_ID, conform)
from qualmart.sources.tables import Layout


@dataclass(frozen=True)
class Region:
    state: str
    counties: tuple[str, ...] = field(default_factory=tuple)

    def as_tuple(self) -> tuple[str, tuple[str, ...]]:
        return self.state, tuple(self.counties)


# --- fixed values: columns of the staging tables that come from the feeds -------------------------
FEED_FACILITY_COLUMNS = ["FacilityCode", "FacilityName", "Address", "City", "State", "ZipCode",
                         "CountyName", "PhoneNumber"]
FM_VALUE_COLUMNS = ["ComparedToNational", "Denominator", "Score", "LowerEstimate",
                    "HigherEstimate", "Footnote", "StartDate", "EndDate"]
FM_ORDER = ["FacilityID", "MeasureID", "StartDate", "EndDate", "ComparedToNational", "Denominator",
            "Score", "LowerEstimate", "HigherEstimate", "Footnote"]
# ------------------------------------------------------------------------------------------------


def _maybe_slice(df: DataFrame, region: Region | None) -> DataFrame:
    return df if region is None else region_slice(df, region.state, region.counties)


# ---------------------------------------------------------------------------------- facilities
def facility_source(typed_a: DataFrame, typed_b: DataFrame, region: Region | None = None
                    ) -> DataFrame:
    """Distinct facility rows of both feeds (UNION, case-insensitive)."""
    return ci_union(*[_maybe_slice(t, region).select(*FEED_FACILITY_COLUMNS)
                      for t in (typed_a, typed_b)])


def upsert_facilities(target: DataFrame, source: DataFrame,
                      target_empty: bool = False) -> DataFrame:
    attrs = ["Address", "City", "State", "ZipCode", "CountyName", "PhoneNumber"]
    return upsert(
        target, source, on=[("FacilityName", "FacilityName")],
        update={"FacilityCode": "FacilityCode", **{a: a for a in attrs}},
        insert={"FacilityCode": "FacilityCode", "FacilityName": "FacilityName",
                **{a: a for a in attrs}},
        key_col="FacilityID",
        order=["FacilityName", "FacilityCode", "Address", "City", "State", "ZipCode",
               "CountyName", "PhoneNumber"],
        schema=FACILITIES_SCHEMA, target_empty=target_empty)


# ------------------------------------------------------------------------------------ measures
def feed_summaries(typed_a: DataFrame, typed_b: DataFrame, region: Region | None = None,
                   materialize: bool = True) -> tuple[DataFrame, DataFrame]:
    r = region.as_tuple() if region else None
    return (measure_label_summary(typed_a, r, materialize),
            measure_label_summary(typed_b, r, materialize))


def measures_source(summary_a: DataFrame, summary_b: DataFrame) -> DataFrame:
    """National measure rows of both feeds (UNION)."""
    return ci_union(measure_benchmarks(summary_a, OUTCOMES_TYPE_ID),
                    measure_benchmarks(summary_b, INFECTIONS_TYPE_ID))


def regional_measures_source(summary_a: DataFrame, summary_b: DataFrame) -> DataFrame:
    """Regional measure rows with national statistics from the unfiltered feeds (UNION)."""
    return ci_union(regional_measure_benchmarks(summary_a, OUTCOMES_TYPE_ID),
                    regional_measure_benchmarks(summary_b, INFECTIONS_TYPE_ID))


def upsert_measures(target: DataFrame, source: DataFrame,
                    target_empty: bool = False) -> DataFrame:
    upd = ["MeasureTypeID", "SortOrderID", "NationalScoreMax", "NationalScoreMin",
           "NationalScoreAverage"]
    return upsert(
        target, source, on=[("MeasureName", "MeasureName")],
        update={"MeasureCode": "MeasureCode", **{c: c for c in upd}},
        insert={"MeasureCode": "MeasureCode", "MeasureName": "MeasureName",
                **{c: c for c in upd}},
        key_col="MeasureID",
        order=["MeasureCode", "MeasureName", "MeasureTypeID", "SortOrderID"],
        schema=MEASURES_SCHEMA, target_empty=target_empty)


# --------------------------------------------------------------------------- facility measures
def _resolve(typed: DataFrame, facilities: DataFrame, measures: DataFrame) -> DataFrame:
    """Feed row → staging facility and measure ids by natural code (inner equi-joins)."""
    fac = facilities.select(ci_key("FacilityCode").alias("_fk"), "FacilityID")
    mea = measures.select(ci_key("MeasureCode").alias("_mk"), "MeasureID")
    return (typed.withColumn("_fk", ci_key("FacilityCode")).withColumn("_mk", ci_key("MeasureCode"))
                 .join(fac, "_fk").join(mea, "_mk")
                 .select("FacilityID", "MeasureID", *FM_VALUE_COLUMNS))


def facility_measure_rows(typed_a: DataFrame, typed_b: DataFrame, facilities: DataFrame,
                          measures: DataFrame, region: Region | None = None) -> DataFrame:
    """All rows of both feeds, repeated ones too."""
    a = _resolve(_maybe_slice(typed_a, region), facilities, measures)
    b = _resolve(_maybe_slice(typed_b, region), facilities, measures)
    return a.unionByName(b)


def facility_measures_source(typed_a: DataFrame, typed_b: DataFrame, facilities: DataFrame,
                             measures: DataFrame, region: Region | None = None) -> DataFrame:
    rows = facility_measure_rows(typed_a, typed_b, facilities, measures, region)
    return ci_distinct(rows, mostly_distinct=True)


def first_facility_measures(rows: DataFrame, layout: Layout, buckets: int) -> DataFrame:
    """What ``upsert_facility_measures`` makes of the distinct ``rows`` on a first load. The rows are
    shuffled once, to the buckets of the table: what is equal lies in one bucket, keys are handed out
    there, and the table is written from there."""
    distinct = ci_distinct_in_place(layout.spread(rows, buckets), layout.keys)
    keyed = assign_keys_in_buckets(distinct, "FacilityMeasureID", FM_ORDER, layout, buckets)
    return conform(keyed, FACILITY_MEASURES_SCHEMA)


def upsert_facility_measures(target: DataFrame, source: DataFrame, target_empty: bool = False,
                             spread: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    return upsert(
        target, source, on=[("MeasureID", "MeasureID"), ("FacilityID", "FacilityID")],
        update={c: c for c in FM_VALUE_COLUMNS},
        insert={"FacilityID": "FacilityID", "MeasureID": "MeasureID",
                **{c: c for c in FM_VALUE_COLUMNS}},
        key_col="FacilityMeasureID",
        order=FM_ORDER, schema=FACILITY_MEASURES_SCHEMA, target_empty=target_empty, spread=spread)


def staging_facility_measures_report(fm: DataFrame, facilities: DataFrame, measures: DataFrame
                                     ) -> DataFrame:
    """Facility name, measure name and score of a staging layer (inner joins on ids)."""
    return (fm.join(facilities.select("FacilityID", "FacilityName"), "FacilityID")
              .join(measures.select("MeasureID", "MeasureName"), "MeasureID")
              .select("FacilityName", "MeasureName", "Score"))
