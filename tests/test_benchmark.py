"""Direction inference, class averages and national statistics on hand-written rows."""

from decimal import Decimal

import pytest

from helpers import outcomes
from qualmart.operators.benchmark import (measure_benchmarks, measure_label_summary,
                                          national_stats, regional_measure_benchmarks,
                                          score_direction)
from qualmart.operators.feeds import OUTCOMES, typed_feed

B = "Better Than the National Rate"
W = "Worse Than the National Rate"
N = "No Different Than the National Rate"


def rows(*pairs, name="Measure One"):
    return [dict(ComparedToNational=label, Score=score, MeasureName=name) for label, score in pairs]


def directions(spark, data):
    summary = measure_label_summary(typed_feed(outcomes(spark, data), OUTCOMES))
    return sorted(r.SortOrderID for r in score_direction(summary).collect())


@pytest.mark.parametrize("pairs,expected", [
    (((B, "5"), (W, "9")), [1]),
    (((B, "9"), (W, "5")), [0]),
    (((N, "7"), (W, "3")), [0]),
    (((N, "3"), (W, "7")), [1]),
    (((B, "7"), (N, "3")), [0]),
    (((B, "3"), (N, "7")), [1]),
    (((B, "7"),), [1]),
    (((W, "7"),), [1]),
    (((N, "7"),), [1]),
    ((("Not Available", "7"),), [1]),
    (((B, "5"), (W, "5")), [1]),
])
def test_direction_truth_table(spark, pairs, expected):
    assert directions(spark, rows(*pairs)) == expected


def test_label_variants_fan_out(spark):
    data = rows((B, "9"), ("Better Than the National Value", "1"), (W, "5"))
    assert directions(spark, data) == [0, 1]


def test_label_compare_ignores_case_and_trailing_blank(spark):
    data = rows(("BETTER THAN THE NATIONAL RATE ", "9"), (W, "5"))
    assert directions(spark, data) == [0]


def test_national_stats_and_average_precision(spark):
    data = rows((B, "1.0004"), (W, "1.0005"), (N, "--"), ("Not Available", "Not Available"))
    summary = measure_label_summary(typed_feed(outcomes(spark, data), OUTCOMES))
    s = national_stats(summary).collect()[0]
    assert s.NationalScoreMax == Decimal("1.001")   # '1.0005' rounds half-up to 1.001
    assert s.NationalScoreMin == Decimal("1.000")
    assert s.NationalScoreAverage == Decimal("1.001")  # avg(1.000, 1.001) = 1.0005 -> 1.001


def test_measure_benchmarks_one_row_per_direction(spark):
    data = rows((B, "9"), ("Better Than the National Value", "1"), (W, "5"))
    summary = measure_label_summary(typed_feed(outcomes(spark, data), OUTCOMES))
    got = sorted((r.MeasureCode, r.SortOrderID) for r in measure_benchmarks(summary, 1).collect())
    assert got == [("M1", 0), ("M1", 1)]


def test_regional_measures_use_unfiltered_stats(spark):
    data = [dict(ComparedToNational=B, Score="10", CountyName="MILWAUKEE"),
            dict(ComparedToNational=W, Score="2", CountyName="DANE")]
    summary = measure_label_summary(typed_feed(outcomes(spark, data), OUTCOMES),
                                    ("WI", ["Milwaukee"]))
    r = regional_measure_benchmarks(summary, 1).collect()
    assert len(r) == 1
    assert r[0].NationalScoreMin == Decimal("2.000") and r[0].SortOrderID == 0


def test_measure_without_name_is_kept_for_the_gate(spark):
    feed = outcomes(spark, [dict(MeasureID="M1", MeasureName=None, Score="5"), dict(MeasureID="M2", MeasureName="Two", Score="6")])
    out = measure_benchmarks(measure_label_summary(typed_feed(feed, OUTCOMES)), 1).collect()
    assert sorted(r.MeasureCode for r in out) == ["M1", "M2"]
