"""Typing of feed text: sentinels, decimal rounding, dates, strict vs lenient, region slice."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import infections, outcomes
from qualmart.functions.clean import LENIENT
from qualmart.operators import quality
from qualmart.operators.feeds import INFECTIONS, OUTCOMES, region_slice, typed_feed


def test_sentinels_and_rounding(spark):
    df = infections(spark, [dict(Score="Not Available"), dict(Score="--"), dict(Score="12.3456")])
    got = [r.Score for r in typed_feed(df, INFECTIONS).orderBy(F.col("Score").asc_nulls_first())
           .collect()]
    assert got == [None, None, Decimal("12.346")]


def test_outcomes_double_dash_strict_raises(spark):
    df = outcomes(spark, [dict(Score="--")])
    with pytest.raises(Exception):
        typed_feed(df, OUTCOMES).select("Score").collect()


def test_outcomes_double_dash_statistics_path_is_null(spark):
    df = outcomes(spark, [dict(Score="--")])
    assert typed_feed(df, OUTCOMES).select("StatScore").collect()[0][0] is None


def test_lenient_mode_nulls_and_counts_rejects(spark):
    df = outcomes(spark, [dict(Score="abc"), dict(Score="1.5")])
    got = sorted((r.Score is None) for r in typed_feed(df, OUTCOMES, mode=LENIENT).collect())
    assert got == [False, True]
    prof = {r.column_name: r.reject_count for r in quality.reject_profile(df, ["Score"]).collect()}
    assert prof == {"Score": 1}


def test_rejects_follow_the_row_level_rule(spark):
    df = outcomes(spark, [dict(Score="--", Denominator="--", EndDate="99/99/2018"), dict(Score="7")])
    got = {r.column_name: r.reject_count for r in quality.feed_rejects(df, OUTCOMES).collect()}
    assert got == {"Score": 1, "Denominator": 1, "EndDate": 1, "StartDate": 0, "LowerEstimate": 0,
                   "HigherEstimate": 0}


def test_dates_parse_month_day_year(spark):
    df = outcomes(spark, [dict(StartDate="04/01/2015", EndDate="03/31/2018")])
    r = typed_feed(df, OUTCOMES).collect()[0]
    assert (r.StartDate.isoformat(), r.EndDate.isoformat()) == ("2015-04-01", "2018-03-31")


def test_region_slice_case_insensitive(spark):
    df = outcomes(spark, [dict(CountyName="MILWAUKEE"), dict(CountyName="DANE"),
                          dict(CountyName="WAUKESHA ", State="wi")])
    kept = region_slice(df, "WI", ["Milwaukee", "Waukesha", "Washington"])
    assert kept.count() == 2


def test_measure_without_numeric_score_violates_not_null(spark):
    from qualmart.operators.benchmark import measure_benchmarks, measure_label_summary
    df = outcomes(spark, [dict(Score="Not Available"), dict(Score="Not Available")])
    summary = measure_label_summary(typed_feed(df, OUTCOMES))
    m = measure_benchmarks(summary, 1)
    v = {r.column_name: r.null_count for r in
         quality.null_violations(m, ["NationalScoreMax", "NationalScoreMin"]).collect()}
    assert v == {"NationalScoreMax": 1, "NationalScoreMin": 1}
