"""The refresh pipeline: landing feeds → staging (national, regional) → star, published at once.

Order: national facilities, measures, facility measures; regional facilities, measures, facility
measures; facility dimension; fact. Every table of the new version is written to the store and read
back before the next step uses it, which cuts lineage (an executor loss recomputes one step, not
the pipeline) and keeps surrogate keys stable. Keys, foreign keys, NOT NULL columns and text lengths
are checked in the writes themselves (``operators.gate``). Nothing is published unless every step and
the checks succeed; a failure surfaces as an exception and the previous version stays current.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qualmart.functions.clean import DEFAULT_DATE_FORMAT, STRICT
from qualmart.operators import gate
from qualmart.operators.calendar import BEGINNING_OF_TIME, DEFAULT_END, DEFAULT_START, END_OF_TIME, calendar
from qualmart.operators.feeds import INFECTIONS, OUTCOMES, typed_feed
from qualmart.plans import model, staging, star
from qualmart.session import scratch_path, scratch_scope
from qualmart.sources import schemas
from qualmart.sources.store import TableStore

STAGED_TABLES = {
    "us_facilities": schemas.FACILITIES_SCHEMA,
    "us_measures": schemas.MEASURES_SCHEMA,
    "us_facility_measures": schemas.FACILITY_MEASURES_SCHEMA,
    "regional_facilities": schemas.FACILITIES_SCHEMA,
    "regional_measures": schemas.MEASURES_SCHEMA,
    "regional_facility_measures": schemas.FACILITY_MEASURES_SCHEMA,
    "dim_facility": schemas.DIM_FACILITY_SCHEMA,
    "fact_measure": schemas.FACT_MEASURE_SCHEMA,
}
STATIC_TABLES = ("dim_date", "measure_types", "sort_orders")
#: Sketches of the members that each version's facts have, per start year (``model.member_sketches``).
SKETCHES = "member_sketches"
SKETCHED = ("FacilityName", "FacilityCity", "FacilityCountyName", "FacilityState", "FacilityZipCode", "MeasureName")
SENTINELS = (BEGINNING_OF_TIME, END_OF_TIME)


@dataclass
class RefreshConfig:
    region: staging.Region
    calendar_start: str = DEFAULT_START
    calendar_end: str = DEFAULT_END
    mode: str = STRICT
    date_format: str = DEFAULT_DATE_FORMAT


@dataclass(frozen=True)
class Refreshed:
    """What a refresh published: ``rows`` per table, and how many regional facility measures have a
    date outside the calendar and so no fact."""
    version: int
    rows: dict[str, int]
    dropped_facts: int


def _previous(store: TableStore, version: int | None) -> dict[str, DataFrame]:
    spark = store.spark
    if version is None:
        prev = {n: schemas.empty(spark, s) for n, s in STAGED_TABLES.items()}
        prev["dim_date"] = None
        prev["measure_types"] = schemas.measure_types(spark)
        prev["sort_orders"] = schemas.sort_orders(spark)
        return prev
    return {n: store.merge_target(n, version) for n in (*STAGED_TABLES, *STATIC_TABLES)}


class _Attempt:
    """One refresh attempt: writes its tables and checks them while they are written."""

    def __init__(self, store: TableStore):
        self.store, self.version = store, store.next_version()
        self.seen: dict[str, dict] = {}

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """A table of the new version, or an intermediate one that goes when the refresh ends."""
        stays = name in STAGED_TABLES or name in STATIC_TABLES or name == SKETCHES
        path = None if stays else scratch_path(df.sparkSession, name)
        back, seen = self.store.write(name, df, self.version, self._metrics(name), path)
        if seen:
            self.seen[name] = seen
            problems = gate.column_problems(seen) + gate.foreign_problems(seen, self._parents(name))
            self.refuse([f"{name}: {p}" for p in problems])
        return back

    def _metrics(self, name: str) -> dict:
        if name == "dim_date":
            real = F.when(~F.col("Date").isin([F.lit(s).cast("date") for s in SENTINELS]), F.col("Date"))
            return {"rows": F.count(F.lit(1)), "first": F.min(real), "last": F.max(real)}
        if name not in STAGED_TABLES:
            return {"rows": F.count(F.lit(1))}
        schema, shape = STAGED_TABLES[name], schemas.shape_of(name)
        days = self.seen["dim_date"]
        keys = {fk: pk for fk, parent, pk in schemas.FOREIGN_KEYS.get(shape, ()) if parent == "dim_date"}
        dates = {fk: fk.removesuffix("Key") for fk in keys}
        return (gate.column_metrics(schemas.not_null_columns(schema), schemas.TEXT_LIMITS[shape])
                | gate.key_metrics(schemas.TABLES[shape][1][0], self._parents(name))
                | gate.date_metrics(dates, str(days["first"]), str(days["last"]), SENTINELS))

    def _parents(self, name: str) -> dict[str, dict]:
        """Foreign key columns of a table and the metrics of the parent tables, lookups apart."""
        layer = name.split("_")[0] + "_" if name.startswith(("us_", "regional_")) else ""
        out = {}
        for fk, parent, _ in schemas.FOREIGN_KEYS.get(schemas.shape_of(name), ()):
            if parent == "measure_types":
                ids = [i for i, _ in schemas.MEASURE_TYPES]
                out[fk] = {"rows": len(ids), "first": min(ids), "last": max(ids)}
            elif parent != "dim_date":
                out[fk] = self.seen.get(layer + parent) or self.seen[parent]
        return out

    def refuse(self, problems: list[str]) -> None:
        if problems:
            raise ValueError(f"integrity checks failed, version {self.version} not published: {problems[:10]}")

    def publish(self) -> None:
        keys = gate.key_problems(self.store.spark, {n: self.seen[n] for n in STAGED_TABLES})
        self.refuse([f"{r.table_name}: {r.problem}" for r in keys.limit(10).collect()])
        self.store.publish(self.version)


def refresh(spark: SparkSession, store: TableStore, outcomes: DataFrame, infections: DataFrame,
            config: RefreshConfig) -> Refreshed:
    """Run one refresh from two landing feeds and publish it. Nothing but the published tables stays."""
    with scratch_scope(spark):
        return _refresh(spark, store, outcomes, infections, config)


def _refresh(spark: SparkSession, store: TableStore, outcomes: DataFrame, infections: DataFrame,
             config: RefreshConfig) -> Refreshed:
    prev_version = store.published_version()
    prev = _previous(store, prev_version)
    attempt = _Attempt(store)
    w = attempt.write

    # landing → typed, written once and scanned by every later step (column-pruned)
    typed_a = w("typed_outcomes", typed_feed(outcomes, OUTCOMES, config.mode, config.date_format))
    typed_b = w("typed_infections",
                typed_feed(infections, INFECTIONS, config.mode, config.date_format))
    sum_a, sum_b = staging.feed_summaries(typed_a, typed_b, config.region, materialize=False)
    sum_a, sum_b = w("summary_outcomes", sum_a), w("summary_infections", sum_b)

    first = prev_version is None
    if first:
        store.fit_buckets(attempt.version, sum(attempt.seen[n]["rows"] for n in ("typed_outcomes", "typed_infections")))

    # static tables: calendar (sentinels guarded) and lookups
    if prev["dim_date"] is None:
        dim_date = w("dim_date", calendar(spark, config.calendar_start, config.calendar_end))
    else:
        dim_date = w("dim_date", prev["dim_date"])
    types = w("measure_types", prev["measure_types"])
    sorts = w("sort_orders", prev["sort_orders"])

    def src(name: str, df: DataFrame) -> DataFrame:
        """A MERGE reads its source several times: write it once."""
        return df if first else w(f"src_{name}", df)

    def spread(name: str):
        return lambda df: schemas.LAYOUTS[name].spread(df, store.buckets)

    out = {}
    for layer, region in (("us_", None), ("regional_", config.region)):
        fac, mea, fm = layer + "facilities", layer + "measures", layer + "facility_measures"
        benchmarks = staging.measures_source if region is None else staging.regional_measures_source
        out[fac] = w(fac, staging.upsert_facilities(
            prev[fac], src(fac, staging.facility_source(typed_a, typed_b, region)), first))
        out[mea] = w(mea, staging.upsert_measures(prev[mea], src(mea, benchmarks(sum_a, sum_b)), first))
        parts = (typed_a, typed_b, out[fac], out[mea], region)
        if first:
            out[fm] = w(fm, staging.first_facility_measures(
                staging.facility_measure_rows(*parts), schemas.LAYOUTS[fm], store.buckets))
        else:
            out[fm] = w(fm, staging.upsert_facility_measures(
                prev[fm], src(fm, staging.facility_measures_source(*parts)), False, spread(fm)))

    out["dim_facility"] = w("dim_facility", star.upsert_dim_facility(
        prev["dim_facility"], out["regional_facilities"], first))
    # bucketed by its merge keys, in folders by start year, sorted by measure and start date: slicer
    # filters skip folders and row groups
    out["fact_measure"] = w("fact_measure", star.with_start_year(star.upsert_fact(
        prev["fact_measure"], src("fact_measure", star.fact_source(
            out["regional_facility_measures"], out["regional_measures"], types, sorts, out["dim_facility"],
            dim_date)), first, spread("fact_measure"))))
    w(SKETCHES, model.member_sketches(model.StarModel(out["fact_measure"], out["dim_facility"], dim_date), SKETCHED))
    attempt.publish()

    rows = {n: attempt.seen[n]["rows"] for n in (*STAGED_TABLES, *STATIC_TABLES)}
    joined = attempt.seen["fact_measure" if first else "src_fact_measure"]["rows"]
    return Refreshed(attempt.version, rows, rows["regional_facility_measures"] - joined)


def published_sketches(store: TableStore) -> DataFrame:
    """The member sketches of all published versions, one under the other: merged, they estimate the
    members that any version has had, without reading a fact."""
    versions = range(1, (store.published_version() or 0) + 1)
    parts = [store.read(SKETCHES, v).withColumn("version", F.lit(v)) for v in versions]
    return reduce(DataFrame.unionByName, parts)


def published_tables(store: TableStore, version: int | None = None) -> dict[str, DataFrame]:
    v = store.published_version() if version is None else version
    return {n: store.read(n, v) for n in (*STAGED_TABLES, *STATIC_TABLES)}
