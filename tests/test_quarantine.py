"""Bytes that the quarantine leaves on disk: compressed lines, no sort of the rows, no lines kept once they have landed."""

import datetime as dt
import glob
import os

import pytest

from helpers import BASE, OUT_COLS
from qualmart import catalog
from qualmart.session import ensure_checkpoint_dir, scratch_path
from qualmart.sources import landing

WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
GOOD, CUT, MORE = dt.datetime(1996, 10, 20), dt.datetime(1996, 8, 10), dt.datetime(1996, 7, 15)
TABLES = {
    "region": ("r_regionkey int, r_name string", [(0, "AFRICA")]),
    "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "NATION_0", 0)]),
    "supplier": ("s_suppkey long, s_name string, s_nationkey int", [(0, "S0", 0)]),
    "part": ("p_partkey long, p_brand string", [(0, "Brand#11"), (None, "Brand#12")]),
    "lineitem": ("l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                 "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
                 [(p, 0, 7, 5.0, price, 0.1, 0.2, "A", "F", day) for p, price, day in
                  [(0, 2.0, GOOD), (0, 2.0, GOOD), (0, 2.03, GOOD), (0, 2.0, CUT), (0, 2.0, MORE), (None, 2.0, GOOD)]]),
    "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
               "o_orderpriority string", [(k, 0, "F", price, GOOD, "1-URGENT") for k, price in [(1, 3.0), (2, 4.03), (11, 5.0)]]),
}


@pytest.fixture
def sf(spark, tmpdir_path):
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).write.parquet(os.path.join(tmpdir_path, f"{name}.parquet"))
    return tmpdir_path


def lines(spark, n):
    """Lines that load and lines that are cut off, in turn."""
    row = ",".join(f'"{BASE[c]}"' if BASE[c] else "" for c in OUT_COLS)
    return spark.createDataFrame([(f"{k},cut off" if k % 2 else row,) for k in range(n)], "value string").coalesce(1)


def test_lines_are_compressed_and_bounded_in_each_file(spark, tmpdir_path, monkeypatch):
    monkeypatch.setattr(landing, "LINES_PER_FILE", 1000)
    path = os.path.join(tmpdir_path, "lines")
    landing.write_lines(lines(spark, 4000), path)
    files, text = glob.glob(f"{path}/part-*"), sum(len(r.value) + 1 for r in lines(spark, 4000).collect())
    assert len(files) == 4 and sum(map(os.path.getsize, files)) < text / 5
    assert sorted(spark.read.text(path).collect()) == sorted(lines(spark, 4000).collect())


@pytest.mark.parametrize("writers", [None, "7"])
def test_landing_does_not_sort_its_rows(spark, tmpdir_path, writers):
    path, out, sc = os.path.join(tmpdir_path, "lines"), scratch_path(spark, "t-unsorted"), spark.sparkContext
    landing.write_lines(lines(spark, 2000), path)
    forced, key = sc._jvm.org.apache.spark.SparkEnv.get().conf(), "spark.shuffle.spill.numElementsForceSpillThreshold"
    was = spark.conf.get(WRITERS)
    if writers:
        spark.conf.set(WRITERS, writers)
    forced.set(key, "100")      # a sort of more rows spills
    sc.setJobGroup(out, "landing")
    try:
        good, bad = landing.land_with_quarantine(spark, path, "outcomes", out, header=False)
        assert spark.conf.get(WRITERS) == (writers or was)
    finally:
        forced.remove(key)
        sc._jsc.sc().clearJobGroup()
        spark.conf.unset(WRITERS)
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    tracker = sc.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup(out) for s in tracker.getJobInfo(j).stageIds]
    assert stages and [sc._jsc.sc().statusStore().lastStageAttempt(s).memoryBytesSpilled() for s in stages] == [0] * len(stages)
    assert good.count() == bad.count() == 1000
    assert sorted(os.path.basename(f) for f in glob.glob(f"{out.removeprefix('file:')}/_rejected=*")) == [
        "_rejected=false", "_rejected=true"]


def test_landing_of_no_lines(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "none")
    landing.write_lines(lines(spark, 0), path)
    good, bad = landing.land_with_quarantine(spark, path, "outcomes", scratch_path(spark, "t-none"), header=False)
    assert good.count() == bad.count() == 0


def test_setting_is_put_back_after_a_failed_landing(spark, tmpdir_path):
    path, was = os.path.join(tmpdir_path, "lines"), spark.conf.get(WRITERS)
    landing.write_lines(lines(spark, 4), path)
    with pytest.raises(Exception, match="already exists"):
        landing.land_with_quarantine(spark, path, "outcomes", path, header=False)
    assert spark.conf.get(WRITERS) == was


def test_queries_keep_landed_rows_only(spark, sf, monkeypatch):
    seen, land = [], landing.land_with_quarantine
    monkeypatch.setattr(catalog, "land_with_quarantine", lambda s, path, *a, **k: (
        seen.extend(glob.glob(f"{path.removeprefix('file:')}/part-*")), land(s, path, *a, **k))[1])
    kept = f"{ensure_checkpoint_dir(spark).removeprefix('file:')}/qualmart"
    before = set(os.listdir(kept)) if os.path.isdir(kept) else set()
    bad, accepted = catalog.q_landing_quarantine(spark, sf), catalog.q_landing_accepted(spark, sf)
    assert seen and all(f.endswith(".gz") for f in seen)
    assert sorted(n.rsplit("-", 1)[0] for n in set(os.listdir(kept)) - before) == sorted(["landed-outcomes", "landed-infections"] * 2)
    assert sorted((r.feed, r.FacilityID or "", r.Score or "", r.reasons, (r.line or "")[-8:]) for r in bad.collect()) == [
        ("infections", "0", "n/a", "Score is not a number", ""),
        ("outcomes", "", "", "wrong number of fields", "Brand#11"),
        ("outcomes", "", "", "wrong number of fields", "and more"),
        ("outcomes", "0", "--", "Score is not a number", "")]
    assert sorted((r.feed, r.MeasureCode, r.row_count, str(r.score_sum)) for r in accepted.collect()) == [
        ("infections", "B_1", 2, "3.000"), ("outcomes", "A_11", 2, "4.000")]
