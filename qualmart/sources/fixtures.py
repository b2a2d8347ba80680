"""Landing feeds derived from the driver's TPC-H-style test tables.

The warehouse ingests two public all-text feeds that are not shipped with it, so the tests derive
feeds of the same shape from the test tables (recipes in ``FIXTURES.md`` §2):

* outcomes feed  = lineitem ⋈ part ⋈ supplier ⋈ nation ⋈ region, one row per line item
* infections feed = orders ⋈ supplier ⋈ nation ⋈ region, one row per order

Both are plain DataFrame plans over the parquet tables, so their size grows with the data. Numbers
become text through ``decimal(10,2)`` and dates through ``MM/dd/yyyy``, exactly like a CSV landing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qualmart.functions.clean import LENIENT, STAT_SENTINELS, to_decimal, to_feed_date
from qualmart.operators.feeds import OUTCOMES

# --- fixed values: test recipe ------------------------------------------------------------------
OUTCOME_LABELS = {
    "A": "Better Than the National Rate",
    "R": "Worse Than the National Rate",
    "N": "No Different Than the National Rate",
}
INFECTION_LABELS = {
    "F": "Better than the National Benchmark",
    "O": "Worse than the National Benchmark",
    "P": "No Different than the National Benchmark",
}
FOOTNOTE = "1, 2"
TEST_REGION_STATE = "AF"
TEST_REGION_COUNTIES = ("Nation_0", "Nation_5", "Nation_10")  # mixed case on purpose
TEST_CALENDAR = ("1994-01-01", "2002-12-31")
SPLIT_DATE = "1999-01-01"
OLD_LOAD_WITHOUT_COUNTY = "NATION_10"   # facilities first seen in the second load
NEW_LOAD_WITHOUT_COUNTY = "NATION_5"    # facilities absent from the second load
# ------------------------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _money_text(c: str) -> Column:
    return F.col(c).cast("decimal(10,2)").cast("string")


def _date_text(c: Column) -> Column:
    return F.date_format(c, "MM/dd/yyyy")


def _lookup(df: DataFrame) -> DataFrame:
    """The small side of a join with a feed's rows. Both sides are dealt by the key and the small one is
    hashed; a merge join would sort the feed's rows, which spill once a task has some millions of them."""
    return df.hint("shuffle_hash")


def facility_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facility attributes (as feed text) keyed by supplier key.

    Nation and region are resolved on the supplier side, once per supplier, before the join with
    the line items / orders (``_lookup``)."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (s.join(n, s.s_nationkey == n.n_nationkey)
             .join(r, n.n_regionkey == r.r_regionkey)
             .select(
                 F.col("s_suppkey").alias("fac_key"),
                 F.col("s_suppkey").cast("string").alias("FacilityID"),
                 F.col("s_name").alias("FacilityName"),
                 F.concat(F.lit("Dock "), F.col("s_suppkey").cast("string")).alias("Address"),
                 # every third facility spells its county, every fourth its city, in another way
                 F.when(F.col("s_suppkey") % 4 == 2, F.concat("n_name", F.lit(" "))).otherwise(F.col("n_name"))
                 .alias("City"),
                 F.substring("r_name", 1, 2).alias("State"),
                 F.lpad(F.col("s_nationkey").cast("string"), 5, "0").alias("ZipCode"),
                 F.when(F.col("s_suppkey") % 3 == 1, F.initcap("n_name")).otherwise(F.col("n_name"))
                 .alias("CountyName"),
                 F.lit(None).cast("string").alias("PhoneNumber")))


def outcomes_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed A: one all-text row per line item."""
    l = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    fac = facility_text(spark, sf_dir)
    not_available = (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O")
    label = (F.when(F.col("l_returnflag") == "A", OUTCOME_LABELS["A"])
              .when(F.col("l_returnflag") == "R", OUTCOME_LABELS["R"])
              .when(not_available, "Not Available")
              .when(F.col("l_returnflag") == "N", OUTCOME_LABELS["N"]))

    def num(c: str) -> Column:
        return F.when(not_available, F.lit("Not Available")).otherwise(_money_text(c))

    ship = F.to_date("l_shipdate")
    j = l.join(_lookup(p), l.l_partkey == p.p_partkey).join(_lookup(fac), l.l_suppkey == fac.fac_key)
    return j.select(
        "FacilityID", "FacilityName", "Address", "City", "State", "ZipCode", "CountyName",
        "PhoneNumber",
        F.concat(F.lit("A_"), F.regexp_extract("p_brand", r"(\d+)", 1)).alias("MeasureID"),
        F.concat(F.lit("Outcome "), F.col("p_brand")).alias("MeasureName"),
        label.alias("ComparedToNational"),
        num("l_quantity").alias("Denominator"),
        num("l_extendedprice").alias("Score"),
        num("l_discount").alias("LowerEstimate"),
        num("l_tax").alias("HigherEstimate"),
        F.when(F.col("l_linenumber") == 7, F.lit(FOOTNOTE)).alias("Footnote"),
        _date_text(F.date_sub(ship, 90)).alias("StartDate"),
        _date_text(ship).alias("EndDate"),
    )


def infections_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed B: one all-text row per order; the facility is ``o_custkey mod #suppliers``."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        "o_orderpriority")
    n_suppliers = table(spark, sf_dir, "supplier").select(F.count(F.lit(1))).scalar()
    fac = facility_text(spark, sf_dir)
    o = o.withColumn("fac_key", F.col("o_custkey") % n_suppliers)
    status = F.col("o_orderstatus")
    label = (F.when(status == "F", INFECTION_LABELS["F"])
              .when(status == "O", INFECTION_LABELS["O"])
              .when(status == "P", INFECTION_LABELS["P"]))
    score = (F.when(F.col("o_orderkey") % 11 == 0, F.lit("--"))
              .when(F.col("o_orderkey") % 13 == 0, F.lit("Not Available"))
              .otherwise(_money_text("o_totalprice")))
    day = F.to_date("o_orderdate")
    j = o.join(_lookup(fac), "fac_key")
    return j.select(
        "FacilityID", "FacilityName", "Address", "City", "State", "ZipCode", "CountyName",
        "PhoneNumber",
        F.concat(F.lit("B_"), F.substring("o_orderpriority", 1, 1)).alias("MeasureID"),
        F.col("o_orderpriority").alias("MeasureName"),
        label.alias("ComparedToNational"),
        score.alias("Score"),
        F.lit(None).cast("string").alias("Footnote"),
        _date_text(day).alias("StartDate"),
        _date_text(F.date_add(day, 90)).alias("EndDate"),
    )


def keyed_grain(feed: DataFrame) -> DataFrame:
    """One row per (facility, measure), aggregated from all its feed rows, for the scenarios that
    merge a second load (a keyed merge needs that grain): average score, row count as denominator,
    least lower and greatest higher estimate, the most frequent label, earliest start and latest
    end. Only numeric and date buffers, so a hash aggregate with map-side combine."""
    outcomes = "Denominator" in feed.columns
    labels = (OUTCOME_LABELS if outcomes else INFECTION_LABELS).values()

    def text(c: Column) -> Column:
        return F.coalesce(c.cast("decimal(10,2)").cast("string"), F.lit("Not Available"))

    def number(c: str) -> Column:
        return to_decimal(c, STAT_SENTINELS, LENIENT)

    keys = ["FacilityID", "FacilityName", "Address", "City", "State", "ZipCode", "CountyName",
            "PhoneNumber", "MeasureID", "MeasureName"]
    agg = [F.count_if(F.col("ComparedToNational") == label).alias(f"_n{i}")
           for i, label in enumerate(labels)]
    agg += [text(F.avg(number("Score"))).alias("Score"), F.count("Footnote").alias("_footnotes"),
            F.min(to_feed_date("StartDate", mode=LENIENT)).alias("_start"),
            F.max(to_feed_date("EndDate", mode=LENIENT)).alias("_end")]
    if outcomes:
        agg += [F.count(F.lit(1)).cast("string").alias("Denominator"),
                text(F.min(number("LowerEstimate"))).alias("LowerEstimate"),
                text(F.max(number("HigherEstimate"))).alias("HigherEstimate")]
    most = F.greatest("_n0", "_n1", "_n2")
    label = F.when(most == 0, F.lit("Not Available"))
    for i, text_label in enumerate(labels):     # equal counts: the first of better, worse, same
        label = label.when(F.col(f"_n{i}") == most, F.lit(text_label))
    return (feed.groupBy(*keys).agg(*agg)
                .withColumns({
                    "ComparedToNational": label,
                    "Footnote": F.when(F.col("_footnotes") > 0, F.lit(FOOTNOTE)),
                    "StartDate": _date_text(F.col("_start")),
                    "EndDate": _date_text(F.col("_end"))})
                .select(*feed.columns))


def damaged(feed: DataFrame, kind: str) -> DataFrame:
    """The feed with unreadable numbers and dates in some rows, for the reject counts."""
    def where(c: str, test: Column, bad: Column) -> Column:
        return F.when(test, bad).otherwise(F.col(c))

    bad = {
        "Score": where("Score", F.col("Score").endswith("3"),
                       F.lit("--" if kind == OUTCOMES else "n/a")),
        "StartDate": where("StartDate", F.col("StartDate").startswith("02/"),
                           F.concat(F.lit("30"), F.substring("StartDate", 3, 8))),
        "EndDate": where("EndDate", F.col("EndDate").startswith("03/"), F.lit("2018-03-31")),
    }
    if kind == OUTCOMES:
        bad |= {
            "Denominator": where("Denominator", F.col("Denominator").startswith("1"),
                                 F.concat(F.lit("about "), F.col("Denominator"))),
            "LowerEstimate": where("LowerEstimate", F.col("LowerEstimate").endswith("7"), F.lit("low")),
            "HigherEstimate": where("HigherEstimate", F.col("HigherEstimate").endswith("7"), F.lit("high")),
        }
    return feed.withColumns(bad)


def damaged_lines(feed: DataFrame, kind: str) -> DataFrame:
    """The damaged feed as CSV lines, some of them cut off or with fields too many."""
    cells = [F.coalesce(F.concat(F.lit('"'), F.col(c), F.lit('"')) if c == "Footnote" else F.col(c), F.lit(""))
             for c in feed.columns]
    cut = F.col("StartDate").startswith("05/1")
    more = F.col("EndDate").startswith("07/1")
    line = F.when(cut, F.concat_ws(",", *cells[:10])).otherwise(F.concat_ws(",", *cells))
    return damaged(feed, kind).select(F.when(more & ~cut, F.concat(line, F.lit(",and more"))).otherwise(line)
                                      .alias("value"))


def damaged_copy(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Published tables with repeated, missing and dangling keys and lacking values."""
    def put(df: DataFrame, key: str, column: str, every: int, value: Column) -> DataFrame:
        kind = df.schema[column].dataType
        return df.withColumn(column, F.when(F.col(key) % every == 0, value.cast(kind)).otherwise(F.col(column)))

    fm, fact = tables["us_facility_measures"], tables["fact_measure"]
    twice = fm.where("FacilityMeasureID % 97 = 0")
    fm = put(fm, "FacilityMeasureID", "FacilityID", 89, F.col("FacilityID") + 1_000_000)
    fm = put(fm, "FacilityMeasureID", "StartDate", 83, F.lit(None)).unionByName(twice)
    fact = put(fact, "FacilityMeasureID", "EndDateKey", 79, F.lit(20201231))
    fact = put(fact, "FacilityMeasureID", "NationalScoreLow", 73, F.lit(None))
    fact = put(fact, "FacilityMeasureID", "MeasureKey", 61, F.lit(None))
    return {**tables, "us_facility_measures": fm, "fact_measure": fact}


def split_loads(feed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two successive loads of one feed at ``keyed_grain``: an older one and a newer one that has
    changed values, new facilities and lacks some old ones (matched / inserted / target-only).
    What each load lacks is the scenario: ``SPLIT_DATE`` and the two counties above."""
    end = to_feed_date("EndDate", mode=LENIENT)
    old = feed.where((end < F.lit(SPLIT_DATE).cast("date"))
                     & (F.upper(F.rtrim("CountyName")) != OLD_LOAD_WITHOUT_COUNTY))
    new = feed.where((end >= F.lit(SPLIT_DATE).cast("date"))
                     & (F.upper(F.rtrim("CountyName")) != NEW_LOAD_WITHOUT_COUNTY))
    return keyed_grain(old), keyed_grain(new)
