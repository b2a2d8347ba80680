"""Plans and layout of the merge: skew, buckets, start-year folders, checks in the write."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from qualmart.operators import bitmaps, gate
from qualmart.operators.upsert import matched, unmatched, upsert
from qualmart.plans import model as M
from qualmart.plans import star
from qualmart.session import scratch_path
from qualmart.sources import schemas, tables

SKEWED = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
          "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
          "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.shuffle.partitions": "16"}


@pytest.fixture
def conf(spark):
    old = {}

    def put(values):
        for k, v in values.items():
            old.setdefault(k, spark.conf.get(k, None))
            spark.conf.set(k, v)
    yield put
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_is_split_in_both_joins_of_the_merge(spark, conf):
    conf(SKEWED)
    hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))
    target = spark.range(200_000).select(hot.alias("_k0"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    source = spark.range(50_000).select(F.col("id").alias("_k0"), F.lit(True).alias("_source"))
    kept = matched(target, source, ["_k0"])
    plan = final_plan(kept.select("v", "_source"))
    assert "SortMergeJoin(skew=true)" in plan and "LeftOuter" in plan
    # inserts: a hot source key is split as well, and the hot target key is one row
    rows = target.withColumnRenamed("v", "w")
    plan = final_plan(unmatched(rows, source, ["_k0"]))
    assert "SortMergeJoin(skew=true)" in plan and "LeftAnti" in plan


def test_merge_with_hot_and_null_keys(spark, conf):
    conf(SKEWED)
    hot = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id"))
    schema = "key long, k long, v string"
    target = spark.range(6000).select((F.col("id") + 1).alias("key"), hot.cast("long").alias("k"), F.lit("old").alias("v"))
    source = spark.createDataFrame([(7, "new"), (8, "new"), (None, "null"), (None, "null"), (100_000, "added")],
                                   "k long, v string")
    out = upsert(target, source, [("k", "k")], {"v": "v"}, {"k": "k", "v": "v"}, "key", ["k", "v"],
                 spark.createDataFrame([], schema).schema)
    assert out.count() == 6003
    assert out.where("k = 7 AND v = 'new'").count() == 2000 and out.where("k = 8").first().v == "new"
    assert sorted((r.key, r.v) for r in out.where("key > 6000").collect()) == [
        (6001, "null"), (6002, "null"), (6003, "added")]
    assert out.where("k IS NULL AND v = 'old'").count() == 2000


LAYOUT = tables.Layout(keys=("a", "b"), sort=("b",))


def test_bucketed_target_is_not_shuffled(spark, conf):
    conf({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    rows = spark.range(5000).select((F.col("id") % 50).alias("a"), F.col("id").alias("b"), F.lit("x").alias("v"))
    path = scratch_path(spark, "t-buckets")
    target = tables.save(LAYOUT.spread(rows, 6), path, LAYOUT, 6)
    t = target.select("*", F.col("a").alias("_k0"), F.col("b").alias("_k1"))
    source = spark.range(100).select((F.col("id") % 50).alias("_k0"), F.col("id").alias("_k1"), F.lit(1).alias("s"))
    for joined in (matched(t, source, ["_k0", "_k1"]), unmatched(source, t, ["_k0", "_k1"])):
        plan = final_plan(joined)
        final = plan.split("== Initial Plan ==")[0]
        assert "SortMergeJoin" in final and final.count("Exchange hashpartitioning") == 1, plan
    assert matched(t, source, ["_k0", "_k1"]).where("s = 1").count() == 100


def test_bucketed_table_is_found_again_by_another_session(spark, conf):
    conf({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    layout = tables.Layout(keys=("a",), partition=("y",))
    rows = spark.range(1000).select(F.col("id").alias("a"), F.lit("x").alias("v"), (F.col("id") % 3).cast("int").alias("y"))
    path = scratch_path(spark, "t-again")
    tables.save(layout.spread(rows, 4), path, layout, 4)
    spark.sql(f"DROP TABLE {tables._name(path)}")       # what a new session's catalog looks like
    back = tables.load(spark, path, layout, 4)
    assert back.count() == 1000 and back.where("y = 1").count() == 333
    plan = final_plan(back.groupBy("a").count())
    assert "Exchange" not in plan.split("== Initial Plan ==")[0]
    assert set(tables.bucket_bytes(back)) == {0, 1, 2, 3} and not tables.is_skewed(back)


def test_skewed_buckets_are_read_without_them(spark, monkeypatch):
    layout = tables.Layout(keys=("a",))
    rows = spark.range(60_000).select(F.when(F.col("id") < 500, F.col("id")).otherwise(-1).alias("a"),
                                      F.sha2(F.col("id").cast("string"), 256).alias("v"))
    path = scratch_path(spark, "t-skewed")
    table = tables.save(layout.spread(rows, 8), path, layout, 8)
    assert not tables.is_skewed(table)                  # small files are never worth it
    monkeypatch.setattr(tables, "SKEW_BYTES", 1000)
    assert tables.is_skewed(table)
    plain = tables.merge_target(table, path)
    assert "Bucketed: true" not in plain._jdf.queryExecution().executedPlan().toString() and plain.count() == 60_000


# ------------------------------------------------------------------ start-year folders

@pytest.fixture(scope="module")
def year_model(spark):
    from decimal import Decimal
    days = [dt.date(1994 + k % 8, 1 + k % 12, 1 + k % 28) for k in range(400)]
    number = lambda d: d.year * 10000 + d.month * 100 + d.day
    base = dict(MeasureID=1, FacilityKey=1, FacilityID=1, MeasureName="M", ScoreComparedToNational=None,
                Score=Decimal("1"), NationalScoreHigh=Decimal("1"), NationalScoreLow=Decimal("1"),
                NationalScoreAverage=Decimal("1"), MeasureSortOrderName="x", MeasureSortOrderNumber=0,
                MeasureTypeName="t")
    rows = [{**base, "MeasureKey": k + 1, "FacilityMeasureID": k + 1, "StartDate": d, "EndDate": d,
             "StartDateKey": number(d), "EndDateKey": number(d)} for k, d in enumerate(days)]
    fields = [f.name for f in schemas.FACT_MEASURE_SCHEMA.fields]
    fact = spark.createDataFrame([tuple(r[f] for f in fields) for r in rows], schemas.FACT_MEASURE_SCHEMA)
    layout = schemas.LAYOUTS["fact_measure"]
    path = scratch_path(spark, "t-years")
    table = tables.save(layout.spread(star.with_start_year(fact), 3), path, layout, 3)
    from qualmart.operators.calendar import calendar
    dates = scratch_path(spark, "t-dates")
    calendar(spark, "1994-01-01", "2001-12-31").write.parquet(dates)
    return M.StarModel(table, None, spark.read.parquet(dates)), days


def scan(df, table="fact"):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "FileScan" in line and "StartYear" in line]


def test_year_slicer_reads_its_folders(year_model):
    model, days = year_model
    q = M.measure_query(model, ["MeasureName"], ["measure_score"], filters={"Year": [1995, 1996]})
    assert q.first().measure_score == sum(d.year in (1995, 1996) for d in days)
    assert any("PartitionFilters: [" in s and "StartYear" in s.split("PartitionFilters:")[1].split("]")[0]
               for s in scan(q))


def test_any_calendar_slicer_prunes_at_run_time(year_model):
    model, days = year_model
    q = M.measure_query(model, ["MeasureName"], ["measure_score"], filters={"MonthName": ["march"]})
    assert q.first().measure_score == sum(d.month == 3 for d in days)
    assert any("dynamicpruning" in s for s in scan(q))


def test_end_date_role_needs_no_folder(year_model):
    model, days = year_model
    q = M.measure_query(model, ["Year"], ["measure_score"], date_role="end")
    assert {r.Year: int(r.measure_score) for r in q.collect()} == {
        y: sum(d.year == y for d in days) for y in {d.year for d in days}}


# ------------------------------------------------------------------ checks in the write

def observed(df, metrics):
    from pyspark.sql import Observation
    o = Observation()
    df.observe(o, *[m.alias(k) for k, m in metrics.items()]).write.format("noop").mode("overwrite").save()
    return o.get


@pytest.mark.parametrize("keys, ok", [
    ([3, 1, 2, 4], True), ([], True), ([1, 2, 2, 4], False), ([1, 2, 4], False), ([1, 3, 3, 1, 5], False), ([1, None], False)])
def test_dense_keys_by_sums_of_hashes(spark, keys, ok):
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    seen = {"t": observed(df, gate.key_metrics("k"))}
    assert gate.key_problems(spark, seen).isEmpty() is ok


def test_foreign_keys_by_their_ends(spark):
    child = observed(spark.createDataFrame([(1, 2), (2, 5)], "k long, p long"), gate.key_metrics("k", ["p"]))
    assert gate.foreign_problems(child, {"p": {"rows": 5, "first": 1, "last": 5}}) == []
    assert gate.foreign_problems(child, {"p": {"rows": 4, "first": 1, "last": 4}}) == ["value without a parent row in p"]
    assert gate.foreign_problems(child, {"p": {"rows": 0, "first": None, "last": None}})
    none = observed(spark.createDataFrame([(1, None)], "k long, p long"), gate.key_metrics("k", ["p"]))
    assert gate.foreign_problems(none, {"p": {"rows": 0, "first": None, "last": None}}) == []


def test_date_keys(spark):
    rows = [(20150101, dt.date(2015, 1, 1)), (20150102, dt.date(2015, 1, 3)), (19000101, dt.date(1900, 1, 1)),
            (20400101, dt.date(2040, 1, 1)), (None, dt.date(2015, 1, 1))]
    seen = observed(spark.createDataFrame(rows, "DKey int, D date"),
                    gate.date_metrics({"DKey": "D"}, "2015-01-01", "2030-01-01", ["1900-01-01"]))
    assert seen == {"date DKey": 3}
    assert gate.column_problems(seen) == ["key without a calendar day in DKey"]


# ------------------------------------------------------------------ bitmaps

def test_bitmaps_find_repeated_and_missing_keys(spark):
    n = 100_000
    keys = spark.range(1, n + 1).select(F.col("id").alias("k"))
    assert bitmaps.duplicate_keys(keys, "k").isEmpty()
    odd = keys.where("k <> 40000").union(spark.createDataFrame([(5,), (5,), (70_000,), (None,), (None,), (-3,)], "k long"))
    assert sorted(map(tuple, bitmaps.duplicate_keys(odd, "k").collect()), key=str) == [(5, 3), (70_000, 2), (None, 2)]
    child = spark.createDataFrame([(40_000,), (40_000,), (7,), (n + 9,), (None,), (-3,)], "f int")
    assert sorted(map(tuple, bitmaps.missing_parents(child, "f", odd, "k").collect())) == [(40_000, 2), (n + 9, 1)]
    assert bitmaps.missing_parents(child.where("f IS NULL"), "f", odd, "k").isEmpty()


def test_bitmaps_shuffle_no_rows(spark):
    """Rows of one bucket are folded before the exchange: it moves one row per task and bucket."""
    plan = bitmaps.key_bitmaps(spark.range(1000).select(F.col("id").alias("k")), "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("partial_bitmap_construct_agg")
