"""Property checks: dense ordered keys for any input; exact vs approximate cardinality."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from qualmart.operators.keys import assign_keys
from qualmart.operators.setops import ci_distinct
from qualmart.plans.reports import layer_reconciliation


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(st.tuples(st.text(alphabet="abAB ", max_size=3),
                                 st.integers(-5, 5)), min_size=0, max_size=40, unique=True),
       parts=st.integers(1, 5), start=st.integers(1, 100))
def test_assign_keys_is_dense_and_follows_order(spark, values, parts, start):
    df = spark.createDataFrame(values, "s string, i int").repartition(3)
    keyed = assign_keys(df, "k", ["s", "i"], start=start, num_partitions=parts)
    got = sorted((r.k, r.s, r.i) for r in keyed.collect())
    expected = sorted(values, key=lambda t: (t[0].encode(), t[1]))
    assert [(s, i) for _, s, i in got] == expected
    assert [k for k, _, _ in got] == list(range(start, start + len(values)))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(st.sampled_from(["Milwaukee", "MILWAUKEE", "milwaukee ", "Dane", None]),
                       max_size=20))
def test_ci_distinct_collapses_case_and_trailing_blanks(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    got = sorted((r.c is None, (r.c or "").rstrip().lower()) for r in ci_distinct(df).collect())
    expected = sorted({(v is None, (v or "").rstrip().lower()) for v in values})
    assert got == expected


def test_approximate_cardinality_close_to_exact(spark):
    from qualmart.plans.model import StarModel, dimension_cardinality
    from qualmart.sources import schemas
    rows = [(i, i, f"F{i}", "a", f"city{i % 37}", "WI", f"{i % 101:05d}", f"c{i % 3}", None)
            for i in range(1, 2001)]
    dim = spark.createDataFrame(rows, schemas.DIM_FACILITY_SCHEMA)
    model = StarModel(None, dim, None)
    attrs = ["FacilityCity", "FacilityZipCode", "FacilityCountyName"]
    exact = {r.attribute: r.member_count for r in dimension_cardinality(model, attrs).collect()}
    approx = {r.attribute: r.member_count
              for r in dimension_cardinality(model, attrs, exact=False).collect()}
    assert exact == {"FacilityCity": 37, "FacilityZipCode": 101, "FacilityCountyName": 3}
    assert all(abs(approx[a] - exact[a]) <= 0.1 * exact[a] for a in attrs)
    assert dim.select(F.countDistinct("FacilityState")).first()[0] == 1


def test_ci_distinct_returns_rows_of_the_input(spark):
    df = spark.createDataFrame([("Abc", "xyz"), ("abc", "XYZ"), ("abc", "XYZ")], "a string, b string")
    assert [tuple(r) for r in ci_distinct(df).collect()] == [("Abc", "xyz")]


def test_reconciliation_tells_lost_rows_and_changed_scores(spark):
    schema = "FacilityName string, MeasureName string, Score int"
    landing = [("F", "gone", 1), ("F", "fewer", 1), ("F", "fewer", 3), ("F", "other", 1),
               ("F", "other", 2), ("F", "other", 5), ("F", "same", None), ("F", "same", 4)]
    star = [("f ", "FEWER", 3), ("F", "other", 1), ("F", "other", 4), ("F", "other", 5),
            ("F", "same", 4), ("F", "same", None)]
    got = layer_reconciliation({"landing": spark.createDataFrame(landing, schema),
                                "star": spark.createDataFrame(star, schema)}).collect()
    assert {r.measure_key: r.status for r in got} == {
        "gone": "missing", "fewer": "count", "other": "value", "same": "match"}
