"""Integrity checks taken while a table is written (``Observation``), without a second scan.

For each table one set of aggregates runs over the rows on their way to the files: NULLs in NOT NULL
columns, texts beyond their declared length, and what proves the keys:

* Surrogate keys are handed out densely, so a table's keys must be the numbers from the smallest to
  the largest, each once. Row count, smallest and largest key must fit, and the sum of the keys' 64-bit
  hashes must equal that of the numbers themselves, which are generated, not read.
* With the parent's keys dense, a foreign key is present exactly if it lies between the parent's
  smallest and largest key, so its own smallest and largest value decide.
* A date key is the date written as a number; the date must lie in the calendar or be a sentinel.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qualmart.functions.calendar import date_key

_SUM = "decimal(38,0)"


def _hash(key: Column) -> Column:
    return F.xxhash64(key.cast("long")).cast("decimal(20,0)")


def column_metrics(not_null: Iterable[str], limits: Mapping[str, int]) -> dict[str, Column]:
    out = {f"null {c}": F.count_if(F.col(c).isNull()) for c in not_null}
    return out | {f"long {c}": F.count_if(F.length(c) > n) for c, n in limits.items()}


def key_metrics(key: str, foreign: Iterable[str] = ()) -> dict[str, Column]:
    out = {"rows": F.count(F.lit(1)), "first": F.min(F.col(key).cast("long")),
           "last": F.max(F.col(key).cast("long")), "hashes": F.sum(_hash(F.col(key))).cast(_SUM)}
    for c in foreign:
        out |= {f"least {c}": F.min(F.col(c).cast("long")), f"greatest {c}": F.max(F.col(c).cast("long"))}
    return out


def date_metrics(pairs: Mapping[str, str], first: str, last: str, sentinels: Sequence[str]) -> dict[str, Column]:
    """Rows whose date key (key column → date column) isn't that of a calendar day or sentinel."""
    out = {}
    for key, date in pairs.items():
        day = F.col(date).between(F.lit(first).cast("date"), F.lit(last).cast("date"))
        known = day | F.col(date).isin([F.lit(s).cast("date") for s in sentinels])
        out[f"date {key}"] = F.count_if(~F.coalesce(known & (F.col(key) == date_key(date)), F.lit(False)))
    return out


def column_problems(seen: Mapping[str, object]) -> list[str]:
    words = {"null": "NULL in NOT NULL column", "long": "text longer than declared in",
             "date": "key without a calendar day in"}
    return [f"{words[kind]} {c}" for kind, _, c in (k.partition(" ") for k, v in seen.items()
            if k.partition(" ")[0] in words and v)]


def foreign_problems(seen: Mapping[str, object], parents: Mapping[str, Mapping[str, object]]) -> list[str]:
    """Foreign key columns (column → metrics of its parent) with a value that the parent hasn't."""
    out = []
    for c, parent in parents.items():
        least, greatest = seen[f"least {c}"], seen[f"greatest {c}"]
        if least is None:
            continue
        if not parent["rows"] or least < parent["first"] or greatest > parent["last"]:
            out.append(f"value without a parent row in {c}")
    return out


def key_problems(spark: SparkSession, seen: Mapping[str, Mapping[str, object]]) -> DataFrame:
    """(table_name, problem) of the tables whose keys aren't the numbers from the first to the last, each
    once. Tables whose counts don't fit need no job; the others' numbers are generated and hashed in
    one, which reads no table."""
    problem = "duplicate or missing key"
    bad = [(n, problem) for n, m in seen.items()
           if m["rows"] and (m["first"] is None or m["last"] - m["first"] + 1 != m["rows"])]
    known = {n for n, _ in bad}
    parts = [spark.createDataFrame(bad, "table_name string, problem string")]
    for n, m in seen.items():
        if m["rows"] and n not in known:
            numbers = spark.range(m["first"], m["last"] + 1).agg(F.sum(_hash(F.col("id"))).cast(_SUM).alias("s"))
            parts.append(numbers.where(F.col("s") != F.lit(m["hashes"]).cast(_SUM)).select(
                F.lit(n).alias("table_name"), F.lit(problem).alias("problem")))
    return reduce(DataFrame.unionByName, parts)
