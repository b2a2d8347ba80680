"""Calendar generation, model views, measure query, rollups and ranking."""

import datetime as dt
from collections import Counter
from decimal import Decimal

from pyspark.sql import functions as F

from qualmart.operators.calendar import calendar, date_dim, insert_if_absent, sentinel_dates
from qualmart.plans import model as M
from qualmart.plans import reports as R
from qualmart.sources import schemas


def test_calendar_edges_default_range(spark):
    d = date_dim(spark)
    assert d.count() == 5480
    first = d.orderBy("Date").first()
    last = d.orderBy(F.col("Date").desc()).first()
    assert (first.DateKey, first.DayOfWeekName, first.DayOfWeekNumber, first.IsWeekend) == \
        (20150101, "Thursday", 5, False)
    assert (last.DateKey, last.DayOfWeekName, last.DayOfWeekNumber, last.IsWeekend) == \
        (20300101, "Tuesday", 3, False)


def test_sentinels_guarded(spark):
    once = insert_if_absent(schemas.empty(spark, schemas.DIM_DATE_SCHEMA), sentinel_dates(spark))
    twice = insert_if_absent(once, sentinel_dates(spark))
    rows = sorted((r.DateKey, r.DayOfWeekName, r.DayOfWeekNumber, r.IsWeekend)
                  for r in twice.collect())
    assert rows == [(19000101, "Monday", 2, False), (99990101, "Friday", 6, False)]
    assert calendar(spark).count() == 5482


def _fact(spark, rows):
    base = dict(MeasureKey=1, MeasureID=1, FacilityKey=1, FacilityID=1, FacilityMeasureID=1,
                MeasureName="M", ScoreComparedToNational=None, Score=None,
                NationalScoreHigh=Decimal("9"), NationalScoreLow=Decimal("1"),
                NationalScoreAverage=Decimal("5"), MeasureSortOrderName="x",
                MeasureSortOrderNumber=0, MeasureTypeName="t", StartDate=dt.date(2015, 4, 1),
                EndDate=dt.date(2018, 3, 31), StartDateKey=20150401, EndDateKey=20180331)
    data = []
    for i, r in enumerate(rows):
        row = {**base, "MeasureKey": i + 1, **r}
        data.append(tuple(row[f.name] for f in schemas.FACT_MEASURE_SCHEMA.fields))
    return spark.createDataFrame(data, schemas.FACT_MEASURE_SCHEMA)


def _dim(spark, zipcode=None):
    return spark.createDataFrame(
        [(1, 1, "A", "1 A St", "X", "WI", zipcode, "C", None),
         (2, 2, "B", "2 B St", "Y", "WI", "53000", "C", None)], schemas.DIM_FACILITY_SCHEMA)


def test_full_address_keeps_blank_parts(spark):
    model = M.StarModel(None, _dim(spark), None)
    got = {r.FacilityName: r.FacilityFullAddress for r in model.facilities().collect()}
    assert got["A"] == "1 A St X, WI "


def test_days_recorded(spark):
    fact = _fact(spark, [dict(Score=Decimal("1"))])
    model = M.StarModel(fact, _dim(spark), None)
    assert model.scores().first().DaysRecorded == 1095


def test_rank_both_directions_ties_and_nulls(spark):
    scores = [Decimal("1"), Decimal("3"), Decimal("3"), None]
    for direction, expected in ((0, [3, 1, 1, None]), (1, [1, 2, 2, None])):
        fact = _fact(spark, [dict(Score=s, FacilityKey=i + 1, MeasureSortOrderNumber=direction)
                             for i, s in enumerate(scores)])
        ranked = R.rank_facilities(fact, num_partitions=3)
        got = [r.facility_rank for r in ranked.orderBy("MeasureKey").collect()]
        assert got == expected


def test_rank_hot_measure_spreads_over_partitions(spark):
    df = spark.range(0, 5000, 1, 4).select(
        F.lit(1).alias("MeasureID"), (F.col("id") % 997).cast("decimal(10,3)").alias("Score"),
        F.lit(1).alias("MeasureSortOrderNumber"), F.col("id"))
    ranked = R.rank_facilities(df, num_partitions=8)
    got = {r.id: r.facility_rank for r in ranked.collect()}
    # rank = 1 + rows with a smaller score; scores v occur 5 or 6 times each
    counts = [0] * 997
    for i in range(5000):
        counts[i % 997] += 1
    smaller = [0] * 997
    for v in range(1, 997):
        smaller[v] = smaller[v - 1] + counts[v - 1]
    assert all(got[i] == smaller[i % 997] + 1 for i in range(5000))


def test_rank_half_nulls_and_one_tie_keep_partitions_even(spark):
    hot = spark.range(0, 8000, 1, 4).select(
        F.lit(1).alias("MeasureID"),
        F.when(F.col("id") % 2 == 0, F.when(F.col("id") % 8 == 0, 5).otherwise(F.col("id")))
         .cast("decimal(10,3)").alias("Score"),
        F.lit(0).alias("MeasureSortOrderNumber"), F.col("id"))
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        ranked = R.rank_facilities(hot, num_partitions=4).withColumn("p", F.spark_partition_id())
        rows = ranked.collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    sizes = Counter(r.p for r in rows)
    assert len(rows) == 8000 and max(sizes.values()) <= 2 * 8000 / len(sizes)
    want = {}
    scores = sorted((r.Score for r in rows if r.Score is not None), reverse=True)
    for i, v in enumerate(scores):
        want.setdefault(v, i + 1)
    assert all(r.facility_rank == want.get(r.Score) for r in rows)


def test_measure_query_drops_all_blank_combinations(spark):
    fact = _fact(spark, [dict(FacilityKey=1, Score=Decimal("2")), dict(FacilityKey=2, Score=None)])
    model = M.StarModel(fact, _dim(spark), None)
    out = M.measure_query(model, ["FacilityName"], ["measure_score"])
    assert [r.FacilityName for r in out.collect()] == ["A"]
    everything = M.measure_query(model, ["FacilityName"])     # no slicer, all measures
    assert everything.count() == 2


def test_rollup_leaves_sum_to_total(spark):
    dates = calendar(spark, "2015-01-01", "2015-12-31")
    fact = _fact(spark, [dict(Score=Decimal("2"), StartDateKey=20150401),
                         dict(Score=Decimal("3"), StartDateKey=20150402),
                         dict(Score=Decimal("5"), StartDateKey=20150501)])
    model = M.StarModel(fact, _dim(spark), dates)
    r = M.calendar_rollup(model).collect()
    total = [x.measure_score for x in r if x.grouping_level == 15][0]
    leaves = sum(x.measure_score for x in r if x.grouping_level == 0)
    assert total == leaves == Decimal("10")


def test_measure_query_column_axis(spark):
    fact = _fact(spark, [dict(FacilityKey=1, MeasureName="M1", Score=Decimal("2")),
                         dict(FacilityKey=1, MeasureName="M2", Score=None),
                         dict(FacilityKey=2, MeasureName="M2", Score=Decimal("3"))])
    model = M.StarModel(fact, _dim(spark), None)
    out = M.measure_query(model, ["FacilityName"], ["measure_score"], cols="MeasureName",
                          col_members=["M1", "M2", "M3"])
    got = sorted(tuple(r) for r in out.collect())
    assert got == [("A", Decimal("2.000"), None, None), ("B", None, Decimal("3.000"), None)]
