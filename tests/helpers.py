"""Small builders for hand-written feed rows."""

from qualmart.sources.schemas import INFECTIONS_SCHEMA, OUTCOMES_SCHEMA

OUT_COLS = [f.name for f in OUTCOMES_SCHEMA.fields]
INF_COLS = [f.name for f in INFECTIONS_SCHEMA.fields]

BASE = dict(FacilityID="10001", FacilityName="GENERAL HOSPITAL", Address="1 A St",
            City="MILWAUKEE", State="WI", ZipCode="53201", CountyName="MILWAUKEE",
            PhoneNumber="4145550000", MeasureID="M1", MeasureName="Measure One",
            ComparedToNational="Not Available", Denominator="Not Available",
            Score="Not Available", LowerEstimate="Not Available", HigherEstimate="Not Available",
            Footnote=None, StartDate="04/01/2015", EndDate="03/31/2018")


def outcomes(spark, rows):
    data = [tuple({**BASE, **r}[c] for c in OUT_COLS) for r in rows]
    return spark.createDataFrame(data, OUTCOMES_SCHEMA)


def infections(spark, rows):
    data = [tuple({**BASE, **r}[c] for c in INF_COLS) for r in rows]
    return spark.createDataFrame(data, INFECTIONS_SCHEMA)
