"""CSV landing round trip, quarantine, versioned store and announced loads."""

import csv
import json
import os

from helpers import infections, outcomes
from qualmart.operators.feeds import typed_feed
from qualmart.plans.refresh import RefreshConfig, published_tables
from qualmart.plans.staging import Region
from qualmart.session import scratch_path
from qualmart.sources.landing import land_with_quarantine, read_feed, write_landing
from qualmart.sources.store import TableStore
from qualmart.streaming.refresh_stream import start_refresh_stream


def test_csv_landing_round_trip_with_quoted_commas(spark, tmpdir_path):
    df = outcomes(spark, [dict(Footnote="1, 2", Score="4.5"), dict(Footnote=None)])
    path = os.path.join(tmpdir_path, "cd")
    write_landing(df, path)
    back = read_feed(spark, path, "outcomes")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_store_publishes_only_complete_versions(spark):
    store = TableStore(spark, scratch_path(spark, "t-store"))
    assert store.published_version() is None
    v = store.next_version()
    store.write("t", spark.range(3), v)
    assert store.published_version() is None       # written but not published
    store.publish(v)
    assert store.published_version() == v and store.read("t").count() == 3
    assert store.next_version() == v + 1


def test_announced_loads_are_refreshed_whole_and_in_order(spark, tmpdir_path):
    announcements = os.path.join(tmpdir_path, "announced")
    os.makedirs(announcements)
    store = TableStore(spark, scratch_path(spark, "t-stream"))
    config = RefreshConfig(region=Region("WI", ("Milwaukee",)))
    checkpoint = scratch_path(spark, "t-stream-ckpt")
    better, worse = "Better Than the National Rate", "Worse Than the National Rate"
    loads = [[dict(FacilityName="FIRST", ComparedToNational=better, Score="5")],
             [dict(FacilityName="FIRST", ComparedToNational=better, Score="7"),
              dict(FacilityID="10002", FacilityName="SECOND", Score="8", ComparedToNational=worse)],
             [dict(FacilityName="FIRST", Score="n/a")]]
    for i, rows in enumerate(loads):
        a, b = os.path.join(tmpdir_path, f"a{i}"), os.path.join(tmpdir_path, f"b{i}")
        write_landing(outcomes(spark, rows), a)
        write_landing(infections(spark, [dict(FacilityName="FIRST", MeasureID="H1", MeasureName="Infection",
                                              Score="3")]), b)
        if i < 2:       # the third load lies there, but nobody has announced it
            with open(os.path.join(announcements, f"{i}.json"), "w") as fh:
                fh.write(json.dumps(dict(load=str(i), outcomes=a, infections=b)))
        q = start_refresh_stream(spark, announcements, store, config, checkpoint, available_now=True)
        assert q.awaitTermination(600) and q.exception() is None
        assert store.published_version() == min(i + 1, 2)
    t = published_tables(store)
    assert sorted(r.FacilityName for r in t["us_facilities"].collect()) == ["FIRST", "SECOND"]
    scores = {(r.FacilityID, str(r.Score)) for r in t["us_facility_measures"].collect()}
    assert (1, "7.000") in scores          # the second load updated the first facility's score


def test_quarantine_keeps_every_line(spark, tmpdir_path):
    from helpers import BASE, OUT_COLS
    path = os.path.join(tmpdir_path, "feed.csv")
    rows = [dict(Score="4.5", Footnote="1, 2"), dict(Score="--"), dict(Score="x", StartDate="2015-04-01"),
            dict(FacilityName=""), dict(State="WIS"), dict(Score="Not Available"), dict(Denominator="many")]
    with open(path, "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(OUT_COLS)
        for r in rows:
            w.writerow(["" if v is None else v for v in ({**BASE, **r}[c] for c in OUT_COLS)])
        fh.write("10001,cut off\n")
        w.writerow([BASE[c] or "" for c in OUT_COLS] + ["more"])
    good, bad = land_with_quarantine(spark, path, "outcomes", scratch_path(spark, "t-quarantine"))
    assert sorted(r.Score for r in good.collect()) == ["4.5", "Not Available"]
    assert good.columns == OUT_COLS and typed_feed(good, "outcomes").count() == 2
    got = sorted((r.line or "", r.FacilityID or "", "; ".join(r.reasons)) for r in bad.collect())
    assert [g[2] for g in got] == ["Denominator is not a number", "FacilityName is missing", "Score is not a number",
                                   "Score is not a number; StartDate is not a date", "State is longer than 2",
                                   "wrong number of fields", "wrong number of fields"]
    assert got[5][0].endswith(",more") and got[6][0] == "10001,cut off" and got[5][1] == got[6][1] == ""
