"""Spelling-blind axes, totals from one scan, sketches, checksums, one-exchange DISTINCT."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from qualmart.operators import checksums
from qualmart.operators.setops import ci_distinct
from qualmart.plans import model as M
from qualmart.plans import reports as R
from qualmart.sources import schemas


def fact_rows(rows):
    """Facts from (measure name, facility key, score, start date) rows."""
    out = []
    for k, (name, fac, score, day) in enumerate(rows, 1):
        number = day.year * 10000 + day.month * 100 + day.day
        out.append(dict(MeasureKey=k, MeasureID=1, FacilityKey=fac, FacilityID=fac, FacilityMeasureID=k, MeasureName=name,
                        ScoreComparedToNational=None, Score=None if score is None else Decimal(score),
                        NationalScoreHigh=Decimal(9), NationalScoreLow=Decimal(1), NationalScoreAverage=Decimal(k),
                        MeasureSortOrderName="x", MeasureSortOrderNumber=k % 2, MeasureTypeName="t", StartDate=day,
                        EndDate=day, StartDateKey=number, EndDateKey=number))
    fields = [f.name for f in schemas.FACT_MEASURE_SCHEMA.fields]
    return [tuple(r[f] for f in fields) for r in out]


def facilities(spark, rows):
    data = [(k, k, f"F{k}", None, city, "WI", None, county, None) for k, city, county in rows]
    return spark.createDataFrame(data, schemas.DIM_FACILITY_SCHEMA)


D = dt.date(2015, 4, 5)


@pytest.fixture(scope="module")
def model(spark):
    from qualmart.operators.calendar import calendar
    fact = spark.createDataFrame(fact_rows([
        ("Deaths", 1, "1", D), ("DEATHS ", 2, "4", D), ("deaths", 3, "7.5", dt.date(2016, 1, 1)), ("Falls", 1, None, D),
        ("falls", 2, "2", D)]), schemas.FACT_MEASURE_SCHEMA)
    dims = facilities(spark, [(1, "Lodi", "DANE"), (2, "LODI ", "Dane"), (3, "Ripon", "Fond du Lac")])
    return M.StarModel(fact, dims, calendar(spark, "2015-01-01", "2016-12-31"))


def test_spellings_are_one_member(model):
    got = {r.MeasureName: r for r in R.measure_summary(model).collect()}
    assert set(got) == {"DEATHS ", "Falls"}         # the first spelling in binary order
    d = got["DEATHS "]
    assert (d.wi_high_score, d.wi_low_score, d.measure_score) == (Decimal("7.5"), Decimal(1), Decimal("12.5"))
    assert d.wi_average_score == Decimal("4.1666667") and d.us_average_score == Decimal(2)
    assert got["Falls"].wi_average_score == 2 and got["Falls"].us_average_score == Decimal("4.5")


def test_spelling_blind_types_are_those_of_the_plain_measures(model):
    plain = model.fact.agg(*[c.alias(n) for n, c in M._measures().items()]).schema
    merged = R.measure_summary(model).schema
    assert [merged[n].dataType for n in M.MEASURE_NAMES] == [plain[n].dataType for n in M.MEASURE_NAMES]


def test_crosstab_joins_spellings_on_both_axes(model):
    out = M.measure_query(model, ["FacilityCountyName"], ["measure_score"], cols="MeasureName",
                          col_members=["Deaths", "Falls"])
    assert sorted(map(tuple, out.collect())) == [("DANE", Decimal(5), Decimal(2)), ("Fond du Lac", Decimal("7.5"), None)]
    found = M.measure_query(model, ["FacilityCountyName"], ["measure_score"], cols="MeasureName")
    assert found.columns == ["FacilityCountyName", "DEATHS ", "Falls"] and found.count() == 2


def test_a_column_axis_has_a_bound(model, monkeypatch):
    monkeypatch.setattr(M, "MAX_MEMBERS", 1)
    for members in (["a", "b"], None):
        with pytest.raises(ValueError, match="over 1 members"):
            M.measure_query(model, ["FacilityCountyName"], ["measure_score"], cols="MeasureName", col_members=members)


def test_totals_agree_with_single_queries(model):
    rows = M.attribute_totals(model).collect()
    assert {r.attribute for r in rows} == {*M.TOTALLED, "(All)"} and len(M.TOTALLED) == 26
    by = {(r.attribute, r.member): r for r in rows}
    assert by["(All)", None].is_total and by["(All)", None].measure_score == Decimal("14.5")
    assert by["FacilityCountyName", "DANE"].measure_score == 7 and by["IsWeekend", "true"].measure_score == 7
    assert by["FacilityPhoneNumber", None].measure_score == Decimal("14.5") and not by["FacilityPhoneNumber", None].is_total
    for a in ("FacilityCity", "Year", "MeasureName", "DayLongDescription"):
        single = M.measure_query(model, [a], ["measure_score"], keep_blank=True)
        assert {str(r[0]): r.measure_score for r in single.collect()} == {
            r.member: r.measure_score for r in rows if r.attribute == a}


def test_totals_scan_the_facts_once(model, spark, capsys):
    from qualmart.session import materialize
    fact = materialize(model.fact, "t-totals")
    M.attribute_totals(M.StarModel(fact, model.dim_facility, model.dim_date)).explain()
    plan = capsys.readouterr().out
    assert plan.count("StartDateKey#") and plan.count("FileScan parquet") == 1 and plan.count("Expand") == 1
    # below the exchange of the facts' aggregates there is a partial aggregate
    assert plan.index("Exchange hashpartitioning(a0#") < plan.index("partial_sum(Score")


def test_sketches_of_loads_merge(spark):
    from qualmart.operators.calendar import calendar
    days = [dt.date(2015, 1, 1), dt.date(2016, 1, 1)]
    fact = spark.createDataFrame(fact_rows([("M", 1 + k % 6000, "1", days[k >= 8000]) for k in range(12_000)]),
                                 schemas.FACT_MEASURE_SCHEMA)
    dims = facilities(spark, [(k, f"City {k % 3000}", f"{'COUNTY' if k % 2 else 'County'} {k % 7}") for k in range(1, 6001)])
    dates = calendar(spark, "2015-01-01", "2016-12-31")
    loads = [M.StarModel(fact.where(F.col("FacilityKey") % 2 == i), dims, dates) for i in (0, 1)]
    attributes = ["FacilityName", "FacilityCity", "FacilityCountyName"]
    merged = M.merged_cardinality(M.member_sketches(loads[0], attributes).union(M.member_sketches(loads[1], attributes)))
    got = {(r.attribute, r.StartYear): r.member_count for r in merged.collect()}
    for attribute, year, exact in (("FacilityName", None, 6000), ("FacilityName", 2016, 4000), ("FacilityCity", None, 3000),
                                   ("FacilityCountyName", None, 7)):
        assert got[attribute, year] == pytest.approx(exact, rel=0.05)


# ------------------------------------------------------------------ checksums

def test_equal_layers_move_no_rows_and_lost_rows_are_found(spark):
    r = random.Random(4)
    rows = [(f"F{k % 97}", f"M{k % 13}", Decimal(r.randrange(1000))) for k in range(5000)]
    schema = "FacilityName string, MeasureName string, Score decimal(10,3)"
    a = spark.createDataFrame(rows, schema)
    r.shuffle(rows)
    b = spark.createDataFrame([(f.lower() + " ", m, s) for f, m, s in rows], schema)
    keys, values = ["FacilityName", "MeasureName"], ["Score"]
    assert checksums.only_unequal({"a": a, "b": b}, keys, values) is None
    assert R.differing_pairs({"a": a, "b": b}).count() == 0
    lost, changed, twice = rows[10], rows[20], rows[30]
    odd = [x for i, x in enumerate(rows) if i not in (10, 20)] + [(*changed[:2], changed[2] + 1), twice]
    c = spark.createDataFrame(odd, schema)
    some = checksums.only_unequal({"a": a, "c": c}, keys, values)
    assert 0 < some["a"].count() < 600          # a few buckets of 4096, not the layer
    got = {(x.facility_key, x.measure_key): x.status for x in R.differing_pairs({"a": a, "c": c}).collect()}
    want = {(x[0].lower(), x[1].lower()): s for x, s in ((lost, "count"), (twice, "count"), (changed, "value"))}
    assert got == want


# ------------------------------------------------------------------ DISTINCT

def test_mostly_distinct_gives_the_same_rows_with_one_exchange(spark, capsys):
    r = random.Random(6)
    rows = [(r.choice(["ab", "AB", "Ab ", None]), r.choice(["x", "X "]), r.randrange(5), r.choice([None, "z", "Z"]))
            for _ in range(400)]
    df = spark.createDataFrame(rows, "a string, b string, n int, c string")
    want = sorted(map(tuple, ci_distinct(df).collect()), key=str)
    assert sorted(map(tuple, ci_distinct(df, mostly_distinct=True).collect()), key=str) == want
    ci_distinct(df, mostly_distinct=True).explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_min" in plan
