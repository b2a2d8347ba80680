"""Registered queries against their DuckDB oracle on the smallest test tables."""

import os

import pytest

from oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
SF_STAR = "/root/testdata/sf0.01"    # the smallest tables whose test region has facilities
FAST = ["clean_feed_a", "clean_feed_b", "facilities_union", "national_stats_by_id",
        "national_stats_by_direction", "class_averages", "score_direction", "direction_rank",
        "region_slice", "facility_point_lookup", "reject_profile", "earliest_dates",
        "composite_key_outer_chain", "landing_feed_a", "landing_feed_b", "landing_replaced",
        "landing_quarantine", "landing_accepted"]
STAR = ["measures_us", "measures_regional", "facility_measures_us", "dim_facility",
        "fact_measure", "measure_summary", "facility_measure_crosstab", "calendar_rollup",
        "facility_rank", "layer_reconciliation", "fk_violations", "null_violations",
        "length_violations", "flat_report_staging_us", "flat_report_star", "facility_comparison",
        "county_report", "attribute_totals", "year_slicer", "month_slicer", "cardinality_by_sketch", "cardinality_over_loads", "cardinality_over_loads",
        "model_calendar", "calendar_usage", "damaged_keys", "damaged_references", "damaged_nulls", "lost_facts", "upsert_facility_measures",
        "upsert_regional_facilities", "upsert_regional_measures", "refresh_idempotent_state"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def registry():
    import __spark_entry__ as E
    return E.queries(), E.oracle_sql(), duck(SF), duck(SF_STAR)


def test_every_query_has_an_oracle(registry):
    from qualmart.catalog import QUERIES
    qs, sqls = registry[:2]
    assert set(QUERIES) <= set(qs)
    assert set(QUERIES) <= set(sqls) <= set(qs)


@pytest.mark.parametrize("name", FAST)
def test_matches_oracle(spark, registry, name):
    qs, sqls, con, _ = registry
    assert compare(spark, name, qs[name], sqls[name], con, SF)


@pytest.mark.parametrize("name", STAR)
def test_star_matches_oracle(spark, registry, name):
    qs, sqls, _, con = registry
    assert qs[name](spark, SF_STAR).count() > 0
    assert compare(spark, name, qs[name], sqls[name], con, SF_STAR)


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["MeasureCode", "FacilityName", "Score", "MeasureSortOrderNumber",
                          "facility_rank"]
    assert df.count() > 0
