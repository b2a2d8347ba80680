"""Declared constraints re-expressed as data jobs.

Each check is one aggregation pass whose result is consumed (an unused ``raise_error`` column would
simply be pruned by the optimizer). Results are small: one row per column or per offending key.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualmart.functions.clean import (DEFAULT_DATE_FORMAT, STAT_SENTINELS, is_date_reject,
                                      is_reject)
from qualmart.operators.feeds import ROW_RULES


def _long(wide: DataFrame, cols: Sequence[str], value: str) -> DataFrame:
    return wide.unpivot([], list(cols), "column_name", value)


def pk_violations(df: DataFrame, pk: Sequence[str], table: str = "") -> DataFrame:
    """Primary-key values that are NULL or occur more than once."""
    any_null = F.lit(False)
    for c in pk:
        any_null = any_null | F.col(c).isNull()
    return (df.groupBy(*pk).agg(F.count(F.lit(1)).alias("row_count"))
              .where((F.col("row_count") > 1) | any_null)
              .withColumn("table_name", F.lit(table)))


def fk_violations(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose (non-NULL) foreign key has no parent row."""
    keys = parent.select(F.col(pk).alias("_pk"))
    return child.where(F.col(fk).isNotNull()).join(keys, F.col(fk) == F.col("_pk"), "left_anti")


def null_violations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL count per declared NOT NULL column (one pass)."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return _long(wide, cols, "null_count")


def length_violations(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Per text column: longest value, declared limit and number of values over the limit."""
    cols = list(limits)
    agg = []
    for c in cols:
        agg += [F.max(F.length(c)).alias(f"{c}__max"),
                F.count_if(F.length(c) > limits[c]).alias(f"{c}__over")]
    wide = df.agg(*agg)
    rows = [F.struct(F.lit(c).alias("column_name"), F.lit(limits[c]).alias("max_allowed"),
                     F.col(f"{c}__max").alias("max_length"),
                     F.col(f"{c}__over").alias("over_limit")) for c in cols]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def column_checks(df: DataFrame, not_null: Sequence[str], limits: Mapping[str, int]) -> DataFrame:
    """(column_name, rule, violations) for the declared NOT NULL columns (rule ``null``) and text
    lengths (rule ``length``) of one table, all in one aggregate."""
    tests = {("null", c): F.col(c).isNull() for c in not_null}
    tests |= {("length", c): F.length(c) > n for c, n in limits.items()}
    wide = df.agg(*[F.count_if(t).alias(f"{rule}_{c}") for (rule, c), t in tests.items()])
    rows = [F.struct(F.lit(c).alias("column_name"), F.lit(rule).alias("rule"),
                     F.col(f"{rule}_{c}").alias("violations")) for rule, c in tests]
    return wide.select(F.inline(F.array(*rows)))


def reject_profile(feed: DataFrame, cols: Iterable[str],
                   sentinels: Sequence[str] = STAT_SENTINELS, dates: Iterable[str] = (),
                   date_format: str = DEFAULT_DATE_FORMAT) -> DataFrame:
    """Values that are present, not a sentinel of the row-level rule (``sentinels``), and still
    fail the decimal conversion, or for ``dates`` the date conversion."""
    tests = {c: is_reject(c, sentinels) for c in cols}
    tests |= {c: is_date_reject(c, date_format) for c in dates}
    wide = feed.agg(*[F.count_if(t).alias(c) for c, t in tests.items()])
    return _long(wide, list(tests), "reject_count")


def feed_rejects(feed: DataFrame, kind: str, date_format: str = DEFAULT_DATE_FORMAT) -> DataFrame:
    """Reject counts of one landing feed under the row-level rule that ``typed_feed`` applies."""
    numbers, sentinels = ROW_RULES[kind]
    return reject_profile(feed, numbers, sentinels, ["StartDate", "EndDate"], date_format)
