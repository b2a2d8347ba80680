"""Physical-plan properties the design relies on at scale."""

from decimal import Decimal

from helpers import outcomes
from qualmart.operators.benchmark import measure_label_summary
from qualmart.operators.feeds import OUTCOMES, typed_feed
from qualmart.operators.setops import ci_distinct
from qualmart.plans import model as M
from qualmart.session import scratch_path
from qualmart.sources import schemas


def _plan(df, capsys):
    df.explain(mode="formatted")
    return capsys.readouterr().out


def test_feed_summary_is_a_hash_aggregate(spark, capsys):
    typed = typed_feed(outcomes(spark, [dict(Score="5")]), OUTCOMES)
    plan = _plan(measure_label_summary(typed, materialize=False), capsys)
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_distinct_sorts_no_rows_before_its_hash_aggregate(spark, capsys):
    plan = _plan(ci_distinct(outcomes(spark, [dict(Score="5")])), capsys)
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_slicer_filter_reaches_the_parquet_scan(spark, capsys):
    import datetime as dt
    path = scratch_path(spark, "t-plan-fact")
    row = dict(MeasureKey=1, MeasureID=1, FacilityKey=1, FacilityID=1, FacilityMeasureID=1,
               MeasureName="M", ScoreComparedToNational=None, Score=Decimal("1"),
               NationalScoreHigh=Decimal("1"), NationalScoreLow=Decimal("1"),
               NationalScoreAverage=Decimal("1"), MeasureSortOrderName="x",
               MeasureSortOrderNumber=0, MeasureTypeName="t", StartDate=dt.date(2015, 1, 1),
               EndDate=dt.date(2015, 1, 2), StartDateKey=20150101, EndDateKey=20150102)
    spark.createDataFrame([tuple(row[f.name] for f in schemas.FACT_MEASURE_SCHEMA.fields)],
                          schemas.FACT_MEASURE_SCHEMA).write.parquet(path)
    fact = spark.read.parquet(path)
    model = M.StarModel(fact, None, None)
    q = M.measure_query(model, ["MeasureName"], ["measure_score"], filters={"MeasureName": ["m "]})
    plan = _plan(q, capsys)
    assert "PushedFilters: [IsNotNull(MeasureName), EqualTo(MeasureName,M)]" in plan
    assert "ReadSchema: struct<MeasureName:string,Score:decimal(10,3)>" in plan
    assert q.count() == 1
    none = M.measure_query(model, ["MeasureName"], ["measure_score"], filters={"MeasureName": ["x"]})
    assert none.count() == 0
