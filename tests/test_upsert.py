"""Keyed upsert, surrogate keys, refresh publish / failure semantics."""

import pytest
from pyspark.sql import functions as F

from helpers import infections, outcomes
from qualmart.operators.keys import assign_keys
from qualmart.operators.upsert import MergeConflict
from qualmart.plans import staging
from qualmart.plans.refresh import RefreshConfig, published_tables, refresh
from qualmart.session import scratch_path
from qualmart.sources import schemas
from qualmart.sources.store import TableStore

REGION = staging.Region("WI", ("Milwaukee", "Waukesha", "Washington"))


def test_assign_keys_dense_ordered_across_partitions(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 7919 % 1000).alias("v"))
    keyed = assign_keys(df, "k", ["v"], start=11, num_partitions=5)
    got = sorted((r.v, r.k) for r in keyed.collect())
    assert got == [(v, v + 11) for v in range(1000)]


def _fac(spark, rows):
    src = [dict(FacilityCode=c, FacilityName=n, Address="a", City="c", State="WI", ZipCode="z",
                CountyName="MILWAUKEE", PhoneNumber=None) for c, n in rows]
    return spark.createDataFrame(src, "FacilityCode string, FacilityName string, Address string, "
                                      "City string, State string, ZipCode string, "
                                      "CountyName string, PhoneNumber string")


def test_facility_upsert_match_insert_keep(spark):
    empty = schemas.empty(spark, schemas.FACILITIES_SCHEMA)
    v1 = staging.upsert_facilities(empty, _fac(spark, [("1", "A"), ("2", "B")]))
    v2 = staging.upsert_facilities(v1, _fac(spark, [("9", "a "), ("3", "C")]))
    got = sorted((r.FacilityID, r.FacilityCode, r.FacilityName) for r in v2.collect())
    # "a " matches "A" (case and trailing blank), code refreshed, name kept; B kept; C inserted
    assert got == [(1, "9", "A"), (2, "2", "B"), (3, "3", "C")]


def test_duplicate_name_first_load_inserts_both_then_conflicts(spark):
    empty = schemas.empty(spark, schemas.FACILITIES_SCHEMA)
    v1 = staging.upsert_facilities(empty, _fac(spark, [("1", "A"), ("2", "A")]))
    assert v1.count() == 2
    with pytest.raises(MergeConflict):
        staging.upsert_facilities(v1, _fac(spark, [("1", "A"), ("2", "A")]))


def test_null_merge_key_never_matches(spark):
    empty = schemas.empty(spark, schemas.FACILITIES_SCHEMA)
    v1 = staging.upsert_facilities(empty, _fac(spark, [("1", None)]))
    v2 = staging.upsert_facilities(v1, _fac(spark, [("2", None)]))
    assert sorted(r.FacilityCode for r in v2.collect()) == ["1", "2"]


def _feeds(spark, score="5", ctn_b="Better Than the National Rate",
           ctn_w="Worse Than the National Rate", extra=()):
    a = outcomes(spark, [dict(ComparedToNational=ctn_b, Score=score),
                         dict(FacilityID="10002", FacilityName="SECOND", ComparedToNational=ctn_w,
                              Score="9", StartDate="04/01/2016"), *extra])
    b = infections(spark, [dict(MeasureID="H1", MeasureName="Infection",
                                ComparedToNational="Better than the National Benchmark",
                                Score="3"),
                           dict(MeasureID="H1", MeasureName="Infection", Score="--",
                                FacilityID="10002", FacilityName="SECOND")])
    return a, b


def _config():
    return RefreshConfig(region=REGION, calendar_start="2015-01-01", calendar_end="2030-01-01")


def test_refresh_twice_is_idempotent_and_stale_columns_stay(spark):
    store = TableStore(spark, scratch_path(spark, "t-refresh"))
    a, b = _feeds(spark)
    refresh(spark, store, a, b, _config())
    first = {n: sorted(map(tuple, df.collect())) for n, df in published_tables(store).items()}
    refresh(spark, store, a, b, _config())
    second = {n: sorted(map(tuple, df.collect())) for n, df in published_tables(store).items()}
    assert first == second
    one = "FacilityID = 1 AND MeasureName = 'Measure One'"
    fact = published_tables(store)["fact_measure"].where(one).collect()[0]
    assert fact.MeasureSortOrderNumber == 1     # better 5 < worse 9 -> ascending
    # third load flips the direction; the fact keeps the old sort order but takes the new score
    a3, b3 = _feeds(spark, score="20")
    refresh(spark, store, a3, b3, _config())
    t = published_tables(store)
    fact = t["fact_measure"].where(one).collect()[0]
    assert str(fact.Score) == "20.000" and fact.MeasureSortOrderNumber == 1
    assert t["regional_measures"].where("MeasureCode = 'M1'").collect()[0].SortOrderID == 0


def test_failed_refresh_keeps_previous_version(spark):
    store = TableStore(spark, scratch_path(spark, "t-fail"))
    a, b = _feeds(spark)
    v1 = refresh(spark, store, a, b, _config()).version
    bad_a = outcomes(spark, [dict(Score="--")])   # outcomes '--' fails the strict row-level cast
    with pytest.raises(Exception):
        refresh(spark, store, bad_a, b, _config())
    assert store.published_version() == v1
    assert published_tables(store)["us_facilities"].count() == 2


def test_rows_missing_from_later_feed_are_kept(spark):
    store = TableStore(spark, scratch_path(spark, "t-keep"))
    a, b = _feeds(spark)
    refresh(spark, store, a, b, _config())
    a2 = outcomes(spark, [dict(ComparedToNational="Better Than the National Rate", Score="5")])
    refresh(spark, store, a2, b, _config())
    assert published_tables(store)["us_facilities"].count() == 2


def test_fact_outside_calendar_is_dropped(spark):
    store = TableStore(spark, scratch_path(spark, "t-cal"))
    extra = [dict(FacilityID="10003", FacilityName="EARLY", StartDate="12/31/2014")]
    a, b = _feeds(spark, extra=extra)
    done = refresh(spark, store, a, b, _config())
    t = published_tables(store)
    assert t["regional_facility_measures"].count() == 5
    assert t["fact_measure"].count() == 4
    assert done.dropped_facts == 1 and done.rows["fact_measure"] == 4
    again = refresh(spark, store, a, b, _config())
    assert again.dropped_facts == 1 and again.rows == done.rows


def test_measure_without_numeric_score_fails_the_load(spark):
    store = TableStore(spark, scratch_path(spark, "t-notnull"))
    a = outcomes(spark, [dict(Score="Not Available"), dict(Score="Not Available")])
    _, b = _feeds(spark)
    with pytest.raises(ValueError, match="NationalScoreMax"):
        refresh(spark, store, a, b, _config())
    assert store.published_version() is None


def test_text_longer_than_declared_fails_the_load(spark):
    store = TableStore(spark, scratch_path(spark, "t-length"))
    a, b = _feeds(spark, extra=[dict(FacilityID="10009", FacilityName="X" * 101)])
    with pytest.raises(ValueError, match="text longer than declared in FacilityName"):
        refresh(spark, store, a, b, _config())
    assert store.published_version() is None


def test_a_refresh_leaves_only_published_tables(spark, monkeypatch):
    import os

    from qualmart import session
    from qualmart.plans import refresh as R
    made = []
    plain = session.scratch_path
    for module in (session, R):
        monkeypatch.setattr(module, "scratch_path", lambda *a: (made.append(plain(*a)), made[-1])[1])
    local = lambda path: path.removeprefix("file:").replace("///", "/")
    store = TableStore(spark, plain(spark, "t-clean"))
    a, b = _feeds(spark)
    refresh(spark, store, a, b, _config())
    refresh(spark, store, a, b, _config())
    assert len(made) > 20 and not any(os.path.exists(local(path)) for path in made)
    assert published_tables(store)["fact_measure"].count() == 4
    made.clear()
    with pytest.raises(RuntimeError), session.scratch_scope(spark):
        session.materialize(spark.range(3), "t-inner")
        assert os.path.exists(local(made[0]))
        raise RuntimeError
    assert not os.path.exists(local(made[0]))
