"""First load of the facility measures: one shuffle, same rows and keys as the merge; compressed landing; buckets by size."""

import datetime as dt
import glob
import os
import random
from decimal import Decimal

import pytest

from helpers import infections, outcomes
from qualmart.operators.keys import assign_keys_in_buckets
from qualmart.operators.setops import ci_distinct, ci_distinct_in_place
from qualmart.plans import staging
from qualmart.plans.refresh import RefreshConfig, published_tables, refresh
from qualmart.session import scratch_path
from qualmart.sources import schemas, store as store_module, tables
from qualmart.sources.landing import read_feed, write_landing
from qualmart.sources.store import TableStore

LAYOUT = schemas.LAYOUTS["us_facility_measures"]


def fm_rows(spark, n=600, seed=3):
    """Few facilities, many repeats, spellings and NULLs."""
    r = random.Random(seed)
    number = lambda: r.choice([None, Decimal("1.5"), Decimal("-2"), Decimal("10")])
    day = lambda: dt.date(2015, 1, r.randrange(1, 4))
    rows = [(r.choice([1, 1, 1, 2, 300, -7]), r.randrange(1, 4), r.choice(["Better", "BETTER ", "better", "Worse", None]),
             number(), number(), None, number(), r.choice([None, "1, 2", "1, 2 "]), day(), day()) for _ in range(n)]
    return spark.createDataFrame(rows, "FacilityID long, MeasureID short, ComparedToNational string, "
                                       "Denominator decimal(10,3), Score decimal(10,3), LowerEstimate decimal(10,3), "
                                       "HigherEstimate decimal(10,3), Footnote string, StartDate date, EndDate date")


@pytest.mark.parametrize("n", [0, 1, 600])
def test_first_load_has_the_rows_and_keys_of_the_merge(spark, n):
    rows = fm_rows(spark, n)
    empty = schemas.empty(spark, schemas.FACILITY_MEASURES_SCHEMA)
    want = staging.upsert_facility_measures(empty, ci_distinct(rows, mostly_distinct=True), True)
    got = staging.first_facility_measures(rows, LAYOUT, 5)
    assert got.schema.names == want.schema.names
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_first_load_shuffles_the_rows_once(spark, monkeypatch):
    from qualmart.operators import keys
    saved, plain = [], tables.save
    monkeypatch.setattr(keys.tables, "save", lambda df, *a: (saved.append(df), plain(df, *a))[1])
    monkeypatch.setattr("qualmart.sources.tables.save", keys.tables.save)
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = staging.first_facility_measures(fm_rows(spark), LAYOUT, 5)
        write = saved[0]._jdf.queryExecution().executedPlan().toString()
        assert write.count("Exchange") == 1 and "rangepartitioning" not in write and "SortAggregate" not in write
        got.collect()
        final = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        rows = next(line for line in final.splitlines() if "FileScan" in line and "Bucketed: true" in line)
        assert "ShuffledHashJoin" in final and "SortMergeJoin" not in final
        # between the scan of the rows and the join lies no exchange
        lines = final.splitlines()
        join = next(i for i, line in enumerate(lines) if "ShuffledHashJoin" in line)
        assert not any("Exchange" in line for line in lines[join:lines.index(rows)])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)


def test_distinct_in_place_keeps_the_first_spelling(spark):
    rows = fm_rows(spark)
    want = sorted(map(tuple, ci_distinct(rows).collect()), key=str)
    got = ci_distinct_in_place(LAYOUT.spread(rows, 5), LAYOUT.keys)
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_keys_in_buckets_need_an_order_by_the_buckets(spark):
    with pytest.raises(ValueError, match="bucket columns"):
        assign_keys_in_buckets(fm_rows(spark, 3), "k", ["FacilityID", "Score"], LAYOUT, 5)


def test_landing_files_are_compressed(spark, tmpdir_path):
    df = outcomes(spark, [dict(Footnote="1, 2", Score=str(k), City=" x ") for k in range(2000)])
    path = os.path.join(tmpdir_path, "packed")
    write_landing(df, path)
    files = glob.glob(f"{path}/part-*")
    text = sum(sum(len(v or "") + 1 for v in r) for r in df.collect())
    assert files and sum(map(os.path.getsize, files)) < text / 5
    assert sorted(map(tuple, read_feed(spark, path, "outcomes").collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_buckets_of_a_first_load_grow_with_its_rows_and_stay(spark, monkeypatch):
    monkeypatch.setattr(store_module, "ROWS_PER_BUCKET", 2)
    better, worse = "Better Than the National Rate", "Worse Than the National Rate"
    a = outcomes(spark, [dict(FacilityID=str(k), FacilityName=f"F{k}", Score=str(k), ComparedToNational=(better, worse)[k % 2])
                         for k in range(60)])
    b = infections(spark, [dict(MeasureID="H1", MeasureName="Infection", Score="3", FacilityID="0", FacilityName="F0",
                                ComparedToNational="Better than the National Benchmark")])
    config = RefreshConfig(region=staging.Region("WI", ("Milwaukee",)), calendar_start="2015-01-01", calendar_end="2030-01-01")
    root = scratch_path(spark, "t-fit")
    store = TableStore(spark, root)
    refresh(spark, store, a, b, config)
    assert store.buckets == 31 and store.path("fact_measure", 1).split("/")[-2].endswith("-b31")
    before = {n: sorted(map(tuple, df.collect()), key=str) for n, df in published_tables(store).items()}
    later = TableStore(spark, root)
    refresh(spark, later, a, b, config)
    assert later.path("fact_measure", 2).split("/")[-2].endswith("-b31")
    assert {n: sorted(map(tuple, df.collect()), key=str) for n, df in published_tables(later).items()} == before
    named = TableStore(spark, root, buckets=3)
    named.next_version()
    named.fit_buckets(3, 1000)
    assert named.buckets == 3
