"""National benchmarks per measure and inference of the score direction.

Everything here derives from one compact *measure × label summary* built in a single pass over the
typed feed: ``(measure code, measure name, comparison label[, in region]) → sum, count, max, min``.
The big feed is therefore scanned once and shuffled only after map-side partial aggregation (a few
rows per measure and label per task); national statistics, class averages and the direction are
small follow-up aggregates of that summary, joined by the adaptive planner as broadcasts.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from qualmart.functions.textkeys import ci_isin, ci_key
from qualmart.operators.feeds import region_predicate
from qualmart.session import ensure_checkpoint_dir
from qualmart.session import materialize as write_back

# --- fixed values: comparison labels per class --------------------------------------------------
BETTER_LABELS = (
    "Better than the National Benchmark",
    "Better Than the National Rate",
    "Better Than the National Value",
)
WORSE_LABELS = (
    "Worse than the National Benchmark",
    "Worse Than the National Rate",
    "Worse Than the National Value",
)
NO_DIFFERENT_LABELS = (
    "No Different than the National Benchmark",
    "No Different Than the National Rate",
    "No Different Than the National Value",
)
# Direction codes (sort-order ids): 0 = a larger score ranks higher, 1 = lower, 2 = unknown.
DESCENDING, ASCENDING, UNKNOWN = 0, 1, 2
# ------------------------------------------------------------------------------------------------

BETTER, WORSE, SAME = "better", "worse", "no_different"
AVG_TYPE = DecimalType(14, 7)      # type of avg(decimal(10,3))
SCORE_TYPE = DecimalType(10, 3)


def label_class(c: str | Column) -> Column:
    return (F.when(ci_isin(c, BETTER_LABELS), F.lit(BETTER))
             .when(ci_isin(c, WORSE_LABELS), F.lit(WORSE))
             .when(ci_isin(c, NO_DIFFERENT_LABELS), F.lit(SAME)))


def decimal_avg(total: Column, count: Column) -> Column:
    """``avg`` of decimal(10,3) values rebuilt from a partial sum and count, with the same type and
    rounding as Spark's own ``avg`` (sum as decimal(20,3) / count as decimal(20,0) → decimal(14,7));
    NULL when there is no value."""
    return F.when(count > 0, (total.cast("decimal(20,3)") / count.cast("decimal(20,0)"))
                  .cast(AVG_TYPE))


def measure_label_summary(typed: DataFrame, region: tuple[str, Iterable[str]] | None = None,
                          materialize: bool = True) -> DataFrame:
    """The single scan of a typed feed that all benchmark operators use.

    Grouped on the original spellings (so the feed-sized aggregation keeps only fixed-width numeric
    buffers and runs as a hash aggregate with map-side combine); the case-insensitive keys are added
    after the aggregation, on the few summary rows. ``materialize`` writes the summary (one row
    per measure × label × region flag) once to the shared checkpoint folder, so the several small
    aggregates built on it read it instead of re-scanning the feed; pass ``False`` when the caller
    writes it out itself."""
    flag = (region_predicate(region[0], region[1]) if region else F.lit(False))
    summary = (typed
               .select(F.coalesce(flag, F.lit(False)).alias("in_region"),
                       "MeasureCode", "MeasureName", "ComparedToNational", "StatScore")
               .groupBy("MeasureCode", "MeasureName", "ComparedToNational", "in_region")
               .agg(F.sum("StatScore").alias("s"),
                    F.count("StatScore").alias("n"),
                    F.max("StatScore").alias("hi"),
                    F.min("StatScore").alias("lo")))
    out = summary.select(ci_key("MeasureCode").alias("code_key"),
                         ci_key("MeasureName").alias("name_key"),
                         ci_key("ComparedToNational").alias("label_key"), "*")
    if materialize:
        ensure_checkpoint_dir(typed.sparkSession)
        out = write_back(out, "summary")
    return out


def national_stats(summary: DataFrame, by_name: bool = True) -> DataFrame:
    """Max, min and average (cast back to decimal(10,3)) of the cleaned score per measure.

    ``by_name=True`` groups by (code, name) as the national staging does; ``False`` groups by code
    only, as the regional staging does over the unfiltered feed.
    """
    keys = ["code_key", "name_key"] if by_name else ["code_key"]
    out = summary.groupBy(*keys).agg(
        F.min("MeasureCode").alias("MeasureCode"),
        *( [F.min("MeasureName").alias("MeasureName")] if by_name else [] ),
        F.max("hi").alias("NationalScoreMax"),
        F.min("lo").alias("NationalScoreMin"),
        decimal_avg(F.sum("s"), F.sum("n")).cast(SCORE_TYPE).alias("NationalScoreAverage"))
    return out


def class_averages(summary: DataFrame) -> DataFrame:
    """Average cleaned score per (measure name, comparison label) for the three label classes.

    Grouped per label *variant* (e.g. "... Rate" and "... Value" stay apart), like the source."""
    return (summary.withColumn("label_class", label_class("ComparedToNational"))
                   .where(F.col("label_class").isNotNull())
                   .groupBy("name_key", "label_key")
                   .agg(F.min("MeasureName").alias("MeasureName"),
                        F.min("ComparedToNational").alias("ComparedToNational"),
                        F.first("label_class").alias("label_class"),
                        decimal_avg(F.sum("s"), F.sum("n")).alias("average_score")))


def infer_direction(better: Column, worse: Column, same: Column) -> Column:
    """Direction code from the three class averages.

    A NULL comparison falls to the "ascending" arm, and the "unknown" arm is unreachable (the
    innermost branch only runs with ``better`` set and ``worse`` NULL); both are kept as is.
    """
    def cmp(a: Column, b: Column) -> Column:
        return F.when(a > b, F.lit(DESCENDING)).otherwise(F.lit(ASCENDING))

    return (F.when(better.isNotNull() & worse.isNotNull(), cmp(better, worse))
             .when(better.isNull(), cmp(same, worse))
             .when(worse.isNull(), cmp(better, same))
             .otherwise(F.lit(UNKNOWN))).cast("short")


def score_direction(summary: DataFrame) -> DataFrame:
    """Per measure name, every combination of better / worse / no-different variant averages and
    the direction each implies (a measure with two variants of one class yields two rows).

    One aggregation chain, no self-joins: averages per (name, label variant), then per name the
    lists of variant averages of each class (structs, so a variant whose average is NULL still
    counts), and ``explode_outer`` of the three lists forms the combinations. The lists hold at
    most the few label variants of a class.
    """
    per_label = (summary.groupBy("name_key", "label_key")
                        .agg(F.min("MeasureName").alias("MeasureName"),
                             F.min("ComparedToNational").alias("label"),
                             decimal_avg(F.sum("s"), F.sum("n")).alias("v"))
                        .withColumn("label_class", label_class("label")))

    def variants(cls: str) -> Column:
        return F.collect_list(F.when(F.col("label_class") == cls, F.struct("v")))

    per_name = per_label.groupBy("name_key").agg(
        F.min("MeasureName").alias("MeasureName"), variants(BETTER).alias("_b"),
        variants(WORSE).alias("_w"), variants(SAME).alias("_n"))
    combos = (per_name.withColumn("_b", F.explode_outer("_b"))
                      .withColumn("_w", F.explode_outer("_w"))
                      .withColumn("_n", F.explode_outer("_n"))
                      .select("name_key", "MeasureName",
                              F.col("_b.v").alias("AverageScoreBetter"),
                              F.col("_w.v").alias("AverageScoreWorse"),
                              F.col("_n.v").alias("AverageScoreNoDifferent")))
    return (combos.withColumn("SortOrderID", infer_direction(
                F.col("AverageScoreBetter"), F.col("AverageScoreWorse"),
                F.col("AverageScoreNoDifferent")))
                  .distinct())


def measure_benchmarks(summary: DataFrame, type_id: int) -> DataFrame:
    """Measure rows of the national staging: code, name, type, direction and national stats,
    one row per (code, name, direction). A measure without a name stays, without a direction; the
    publish gate then refuses the load, as the NOT NULL column demands."""
    stats = national_stats(summary, by_name=True)
    dirs = score_direction(summary).select("name_key", "SortOrderID").distinct()
    return stats.join(dirs, "name_key", "left").select(
        "MeasureCode", "MeasureName", F.lit(type_id).cast("short").alias("MeasureTypeID"),
        "SortOrderID", "NationalScoreMax", "NationalScoreMin", "NationalScoreAverage")


def regional_measure_benchmarks(summary: DataFrame, type_id: int) -> DataFrame:
    """Measure rows of the regional staging: the measures seen in the region, with statistics and
    direction taken from the whole (unfiltered) feed, statistics grouped by code only."""
    regional = (summary.where("in_region")
                       .groupBy("code_key", "name_key")
                       .agg(F.min("MeasureCode").alias("MeasureCode"),
                            F.min("MeasureName").alias("MeasureName")))
    us = national_stats(summary, by_name=False).drop("MeasureCode")
    dirs = score_direction(summary).select("name_key", "SortOrderID").distinct()
    return (regional.join(us, "code_key", "left").join(dirs, "name_key", "left")
                    .select("MeasureCode", "MeasureName",
                            F.lit(type_id).cast("short").alias("MeasureTypeID"),
                            "SortOrderID", "NationalScoreMax", "NationalScoreMin",
                            "NationalScoreAverage")
                    .distinct())
