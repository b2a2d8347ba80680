"""The measure layer over the star: model views, eight named measures, ``measure_query``.

Relationships: fact → facility dimension on ``FacilityKey`` and fact → date dimension on
``StartDateKey`` (active) or ``EndDateKey`` (the inactive role, selectable). Dimension attributes
filter the facts; measures are evaluated per combination of the row axes; combinations whose
measures are all blank are dropped. The dimensions are joined only when an axis or filter needs
them, so Catalyst prunes the rest.

Text axes group regardless of case and trailing blanks, and show the first of a member's spellings in
binary order. The facts are first aggregated by the stored spellings, with numeric buffers only and
map-side combine; the few rows left are then merged by canonical key.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from qualmart.functions.calendar import described_columns
from qualmart.functions.textkeys import ci_isin, ci_key, ci_literal
from qualmart.operators.benchmark import decimal_avg
from qualmart.operators.calendar import model_dates

FACILITY_ATTRS = ("FacilityKey", "FacilityID", "FacilityName", "FacilityAddress", "FacilityCity",
                  "FacilityState", "FacilityZipCode", "FacilityCountyName", "FacilityPhoneNumber",
                  "FacilityFullAddress")
DATE_ATTRS = ("DateKey", "Date", "DayOfMonth", "MonthNumber", "MonthName", "Year",
              "DayOfWeekName", "DayOfWeekNumber", "IsWeekend", "MonthDescription",
              "DayOfWeekDescription", "DayLongDescription", "IsWeekendLabel")
CALENDAR_HIERARCHY = ("Year", "MonthName", "DayOfWeekName", "DayOfMonth")

#: A column axis with more members than this is refused.
MAX_MEMBERS = 1000

# --- fixed values: the eight named measures (name → aggregate over fact columns) ----------------
def _measures() -> dict[str, Column]:
    return {
        "wi_high_score": F.max("Score"),
        "wi_low_score": F.min("Score"),
        "wi_average_score": F.avg("Score"),
        "measure_score": F.sum("Score"),
        "measure_sort_number": F.max("MeasureSortOrderNumber"),
        "us_high_score": F.max("NationalScoreHigh"),
        "us_low_score": F.min("NationalScoreLow"),
        "us_average_score": F.avg("NationalScoreAverage"),  # average of averages over fact rows
    }


MEASURE_NAMES = ("wi_high_score", "wi_low_score", "wi_average_score", "measure_score",
                 "measure_sort_number", "us_high_score", "us_low_score", "us_average_score")
# ------------------------------------------------------------------------------------------------


def _text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def full_address(address: str = "FacilityAddress", city: str = "FacilityCity",
                 state: str = "FacilityState", zipcode: str = "FacilityZipCode") -> Column:
    """``Address City, State Zip``; a blank part stays empty, it does not blank the whole."""
    return F.concat(_text(address), F.lit(" "), _text(city), F.lit(", "), _text(state), F.lit(" "),
                    _text(zipcode))


def days_recorded(start: str = "StartDate", end: str = "EndDate") -> Column:
    return F.datediff(F.col(end), F.col(start)).cast("long")


@dataclass
class StarModel:
    fact: DataFrame
    dim_facility: DataFrame
    dim_date: DataFrame
    today: str | None = None
    measures: DataFrame | None = None     # one row per measure; resolves MeasureName slicers

    def facilities(self) -> DataFrame:
        return self.dim_facility.withColumn("FacilityFullAddress", full_address())

    def dates(self) -> DataFrame:
        if self.today is None:
            return self.dim_date.withColumns(described_columns())
        return model_dates(self.dim_date, self.today)

    def scores(self) -> DataFrame:
        return self.fact.withColumn("DaysRecorded", days_recorded())

    def joined(self, needed: Iterable[str], date_role: str = "start") -> DataFrame:
        """Fact rows with the dimension attributes in ``needed`` (left joins: an unmatched key
        lands in a blank member)."""
        needed = set(needed)
        df = self.scores()
        if needed & set(FACILITY_ATTRS) - {"FacilityKey", "FacilityID"}:
            fac = self.facilities().drop("FacilityID")
            df = df.join(fac, "FacilityKey", "left")
        if needed & set(DATE_ATTRS):
            key = "StartDateKey" if date_role == "start" else "EndDateKey"
            dates = self.dates().withColumnRenamed("DateKey", key)
            on = [key]
            if date_role == "start" and "StartYear" in self.fact.columns:
                # the fact's folders: a filter on any calendar attribute prunes them, at planning for
                # years and at run time for the rest
                dates = dates.withColumn("StartYear", F.col("Year").cast("int"))
                on.append("StartYear")
            df = df.join(dates, on, "left")
        return df


def _spellings(model: StarModel, df: DataFrame, col: str, values: Sequence[str]) -> list[str]:
    """Stored spellings of the slicer's members: one small job over the smallest table that holds
    the column. The result has a few spellings per asked member, whatever the number of facts."""
    source = df
    for dim in (model.measures, model.dim_facility):
        if dim is not None and col in dim.columns:
            source = dim
            break
    found = source.where(ci_isin(col, values)).select(col).distinct().collect()
    return sorted(r[0] for r in found)


def _filter(model: StarModel, df: DataFrame, filters: Mapping[str, Sequence] | None) -> DataFrame:
    """Slicers. Text members match regardless of case and trailing blanks; the filter itself names
    the stored spellings, so that it still reaches the parquet scan."""
    for col, values in (filters or {}).items():
        members = list(values)
        if isinstance(df.schema[col].dataType, StringType):
            members = _spellings(model, df, col, members)
        df = df.where(F.col(col).isin(members)) if members else df.where(F.lit(False))
    return df


def partial_measures(measures: Sequence[str]) -> list[Column]:
    """Aggregates over the facts from which ``merged_measures`` gives the measures of coarser groups:
    averages as sum and count, the others as they are."""
    averages = {"wi_average_score": "Score", "us_average_score": "NationalScoreAverage"}
    defs, out = _measures(), []
    for m in measures:
        if m in averages:
            out += [F.sum(averages[m]).alias(f"{m} sum"), F.count(averages[m]).alias(f"{m} n")]
        else:
            out.append(defs[m].alias(m))
    return out


def merged_measures(measures: Sequence[str]) -> list[Column]:
    how = {"wi_high_score": F.max, "us_high_score": F.max, "measure_sort_number": F.max,
           "wi_low_score": F.min, "us_low_score": F.min,
           "measure_score": lambda m: F.sum(m).cast("decimal(20,3)")}
    return [(how[m](m) if m in how else decimal_avg(F.sum(f"{m} sum"), F.sum(f"{m} n"))).alias(m)
            for m in measures]


def _is_text(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, StringType)


def axis_keys(df: DataFrame, axes: Sequence[str]) -> list[Column]:
    """What the axes group by: the canonical key of a text, else the value."""
    return [(ci_key(c) if _is_text(df, c) else F.col(c)).alias(f"_key {c}") for c in axes]


def _by_axes(df: DataFrame, rows: Sequence[str], measures: Sequence[str]) -> DataFrame:
    if not any(_is_text(df, c) for c in rows):
        return df.groupBy(*rows).agg(*[_measures()[m].alias(m) for m in measures])
    stored = df.groupBy(*rows).agg(*partial_measures(measures))
    return (stored.groupBy(*axis_keys(df, rows)).agg(*[F.min(c).alias(c) for c in rows], *merged_measures(measures))
                  .select(*rows, *measures))


def _pivoted(df: DataFrame, rows: Sequence[str], measure: str, cols: str, members: Sequence | None) -> DataFrame:
    """One column per member of ``cols``; spellings of a member share its column."""
    cells = _by_axes(df, [*rows, cols], [measure])
    if members is None:
        found = cells.groupBy(*axis_keys(df, [cols])).agg(F.min(cols).alias("member")).select("member")
        members = sorted(r[0] for r in found.limit(MAX_MEMBERS + 1).collect())
    if len(members) > MAX_MEMBERS:
        raise ValueError(f"a column axis of over {MAX_MEMBERS} members")
    named = {ci_literal(m) if isinstance(m, str) else m: m for m in members}
    key = ci_key(cols) if _is_text(df, cols) else F.col(cols)
    # a row's spelling is that of its first cell; every cell of the row must show the same one
    wide = cells.withColumn("_col", key).groupBy(*axis_keys(df, rows)).agg(
        *[F.min(c).alias(c) for c in rows],
        *[F.max(F.when(F.col("_col") == F.lit(k), F.col(measure))).alias(m) for k, m in named.items()])
    return wide.select(*rows, *[F.col(f"`{m}`") for m in named.values()])


def measure_query(model: StarModel, rows: Sequence[str], measures: Sequence[str] = MEASURE_NAMES,
                  filters: Mapping[str, Sequence] | None = None, date_role: str = "start",
                  keep_blank: bool = False, cols: str | None = None,
                  col_members: Sequence | None = None) -> DataFrame:
    """Evaluate named measures per combination of the ``rows`` attributes.

    filters:     attribute → allowed members (a slicer); no entry = all members.
    cols:        optional column axis: one output column per member of this attribute (a pivot
                 of the single measure in ``measures``); ``col_members`` lists the members, so no
                 extra job is needed to discover them. Empty cells are NULL.
    """
    needed = set(rows) | set(filters or {}) | ({cols} if cols else set())
    df = _filter(model, model.joined(needed, date_role), filters)
    if cols:
        if len(measures) != 1:
            raise ValueError("a column axis takes exactly one measure")
        out = _pivoted(df, rows, measures[0], cols, col_members)
        value_cols = [c for c in out.columns if c not in rows]
        return out if keep_blank else out.dropna(how="all", subset=value_cols)
    out = _by_axes(df, rows, measures)
    if not keep_blank:
        out = out.dropna(how="all", subset=list(measures))
    return out


def calendar_rollup(model: StarModel, measure: str = "measure_score",
                    filters: Mapping[str, Sequence] | None = None) -> DataFrame:
    """Drill Year > Month > Day-of-week > Day with subtotals and a grand total."""
    defs = _measures()
    df = _filter(model, model.joined(set(CALENDAR_HIERARCHY) | set(filters or {})), filters)
    out = (df.rollup(*CALENDAR_HIERARCHY)
             .agg(defs[measure].alias(measure),
                  F.grouping_id(*CALENDAR_HIERARCHY).alias("grouping_level")))
    return out.where(F.col(measure).isNotNull())


def attribute_total(model: StarModel, attribute: str, measure: str = "wi_average_score"
                    ) -> DataFrame:
    """One attribute with an ``(All)`` total row."""
    df = model.joined({attribute})
    stored = df.groupBy(attribute).agg(*partial_measures([measure]))
    key = ci_key(attribute) if _is_text(df, attribute) else F.col(attribute)
    out = (stored.withColumn("_key", key).rollup("_key")
                 .agg(F.when(F.grouping_id("_key") == 0, F.min(attribute)).alias(attribute),
                      *merged_measures([measure]), (F.grouping_id("_key") == 1).alias("is_total")))
    return out.where(F.col(measure).isNotNull()).drop("_key")


#: The attributes that reports total one by one: of the facility, the calendar and the fact itself.
TOTALLED = ("FacilityID", "FacilityName", "FacilityAddress", "FacilityCity", "FacilityState", "FacilityZipCode",
            "FacilityCountyName", "FacilityPhoneNumber", "FacilityFullAddress",
            "Date", "DayOfMonth", "MonthNumber", "MonthName", "Year", "DayOfWeekName", "DayOfWeekNumber",
            "IsWeekend", "MonthDescription", "DayOfWeekDescription", "DayLongDescription", "IsWeekendLabel",
            "MeasureName", "MeasureSortOrderName", "MeasureTypeName", "ScoreComparedToNational", "DaysRecorded")


def attribute_totals(model: StarModel, attributes: Sequence[str] = TOTALLED,
                     measures: Sequence[str] = ("measure_score", "wi_average_score")) -> DataFrame:
    """(attribute, member, is_total, measures) for every attribute's members and the ``(All)`` total.

    One scan: each fact is expanded to one grouping set per attribute and folded with it before the
    only exchange of facts' aggregates, which so has a few rows per member and task, and none per fact. A
    member is shown as text; spellings of a text member are then merged."""
    df = model.joined(set(attributes))
    text = {a for a in attributes if _is_text(df, a)}
    df = df.select(*[F.col(a).cast("string").alias(f"a{i}") for i, a in enumerate(attributes)],
                   *{"Score", "NationalScoreAverage", "NationalScoreHigh", "NationalScoreLow",
                     "MeasureSortOrderNumber"})
    cols = [F.col(f"a{i}") for i in range(len(attributes))]
    sets = df.groupingSets([[c] for c in cols] + [[]], *cols).agg(
        F.grouping_id(*cols).alias("_set"), *partial_measures(measures))
    # bit i from the left of the grouping id is 0 where attribute i is the one grouped by
    n = len(attributes)
    every = (1 << n) - 1
    which = F.create_map(*[F.lit(v) for i, a in enumerate(attributes) for v in (every ^ 1 << n - 1 - i, a)])
    long = sets.select(which[F.col("_set").cast("int")].alias("attribute"), F.coalesce(*cols).alias("member"),
                       (F.col("_set") == every).alias("is_total"),
                       *[c for c in sets.columns if c.split(" ")[0] in measures])
    key = F.when(F.col("attribute").isin(sorted(text)), ci_key("member")).otherwise(F.col("member"))
    return (long.groupBy("attribute", "is_total", key.alias("_key"))
                .agg(F.min("member").alias("member"), *merged_measures(measures))
                .select(F.coalesce("attribute", F.lit("(All)")).alias("attribute"), "member", "is_total", *measures))


def member_sketches(model: StarModel, attributes: Sequence[str]) -> DataFrame:
    """(StartYear, attribute, sketch): a HyperLogLog sketch of the members that each year's facts have.
    Sketches of any set of folders, loads or versions merge into that of their union."""
    df = model.joined(set(attributes))
    year = "StartYear" if "StartYear" in df.columns else F.year("StartDate").alias("StartYear")
    wide = df.groupBy(year).agg(*[F.hll_sketch_agg(ci_key(F.col(a).cast("string"))).alias(a) for a in attributes])
    return wide.unpivot(["StartYear"], list(attributes), "attribute", "sketch")


def merged_cardinality(sketches: DataFrame) -> DataFrame:
    """(attribute, StartYear, member_count): estimates per year, and over all (``StartYear`` NULL)."""
    return (sketches.groupingSets([["attribute", "StartYear"], ["attribute"]], "attribute", "StartYear")
                    .agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("member_count"))
                    .select("attribute", "StartYear", "member_count"))


def dimension_cardinality(model: StarModel, attributes: Sequence[str], exact: bool = True
                          ) -> DataFrame:
    """Distinct members per facility attribute of the facts' facilities, in one pass."""
    fac = model.facilities()
    agg = [(F.countDistinct(k) if exact else F.approx_count_distinct(k)).alias(a)
           for a, k in zip(attributes, axis_keys(fac, attributes), strict=True)]
    wide = fac.agg(*agg)
    return wide.unpivot([], list(attributes), "attribute", "member_count")
