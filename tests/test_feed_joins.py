"""The joins that make the landing feeds: both sides dealt by the key, the small one hashed, no sort of the feed's rows."""

import datetime as dt
import os

import pytest

from qualmart.sources import fixtures as X

DAY = dt.datetime(1996, 3, 5)
TABLES = {
    "region": ("r_regionkey int, r_name string", [(0, "AFRICA")]),
    "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "NATION_0", 0)]),
    "supplier": ("s_suppkey long, s_name string, s_nationkey int",
                 [(0, "S0", 0), (1, "S1", 0), (1, "S1 again", 0), (2, "S2", None), (None, "none", 0)]),
    "part": ("p_partkey long, p_brand string", [(0, "Brand#11"), (1, "Brand#12"), (1, "Brand#13"), (None, "Brand#14")]),
    "lineitem": ("l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                 "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
                 [(p, s, 1, 1.0, 2.0, 0.1, 0.2, "A", "F", DAY) for p, s in
                  [(0, 0), (0, 1), (1, 1), (1, 0), (0, 2), (9, 0), (None, 0), (0, None)]]),
    "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
               "o_orderpriority string", [(k, c, "F", 3.0, DAY, "1-URGENT") for k, c in enumerate([0, 1, 1, None, 4, 5])]),
}


@pytest.fixture
def sf(spark, tmpdir_path):
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).write.parquet(os.path.join(tmpdir_path, f"{name}.parquet"))
    return tmpdir_path


@pytest.fixture(params=["10485760", "-1"])
def threshold(spark, request):
    """Tables that are small enough to broadcast, and tables that aren't."""
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield request.param
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


@pytest.mark.parametrize("feed, key, joins", [(X.outcomes_feed, "l_", 2), (X.infections_feed, "fac_key", 1)])
def test_feed_rows_are_not_sorted_for_their_joins(spark, sf, threshold, feed, key, joins):
    plan = feed(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert f"SortMergeJoin [{key}" not in plan
    assert plan.count(f"ShuffledHashJoin [{key}") == joins


def test_feed_rows_of_repeated_and_missing_keys(spark, sf, threshold):
    got = sorted((r.FacilityName, r.MeasureID) for r in X.outcomes_feed(spark, sf).collect())
    assert got == [("S0", "A_11"), ("S0", "A_12"), ("S0", "A_13"), ("S1", "A_11"), ("S1", "A_12"), ("S1", "A_13"),
                   ("S1 again", "A_11"), ("S1 again", "A_12"), ("S1 again", "A_13")]
    # five suppliers: customers 0, 1, 1, none, 4 and 5 (the same facility as 0)
    got = sorted(r.FacilityName for r in X.infections_feed(spark, sf).collect())
    assert got == ["S0", "S0", "S1", "S1", "S1 again", "S1 again"]
