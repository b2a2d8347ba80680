"""DISTINCT / UNION under case-insensitive text comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from qualmart.functions.textkeys import ci_key


def ci_distinct(df: DataFrame, subset: Sequence[str] | None = None, mostly_distinct: bool = False) -> DataFrame:
    """Rows that differ only in letter case or trailing blanks collapse to one of them.

    Two steps: an exact ``DISTINCT`` (hash aggregate, map-side combine: this is where a large feed
    shrinks), then one whole row per canonical key, the first by the binary order of its text
    columns. The result holds only rows of the input. Non-text columns group on their value.

    ``mostly_distinct`` is for feeds that hardly repeat, where the exact step shrinks nothing: the
    first row per canonical key is a minimum, so each task sorts and combines its own rows and they are
    shuffled once. Both forms give the same rows.
    """
    cols = list(subset or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    text = [c for c in cols if isinstance(types[c], StringType)]
    keys = [ci_key(c) if c in text else F.col(c) for c in cols]
    if mostly_distinct and text:
        named = [k.alias(f"_k{i}") for i, k in enumerate(keys)]
        least = F.min(F.struct(*text, *[c for c in cols if c not in text])).alias("_row")
        return df.groupBy(*named).agg(least).select("_row.*").select(*cols)
    exact = df.select(*cols).distinct()
    if not text:
        return exact
    first = Window.partitionBy(*keys).orderBy(*text)
    return exact.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").select(*cols)


def ci_distinct_in_place(df: DataFrame, within: Sequence[str]) -> DataFrame:
    """``ci_distinct`` of rows that have been dealt to tasks by ``within`` (not text): equal rows lie in one
    task already, so the first of them is found by one sort there, without an exchange."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType) and f.name not in within]
    keys = [*within, *[ci_key(c) if c in text else F.col(c) for c in df.columns if c not in within]]
    first = Window.partitionBy(*keys).orderBy(*(text or within))
    return df.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")


def ci_union(*dfs: DataFrame, mostly_distinct: bool = False) -> DataFrame:
    """SQL ``UNION`` (distinct) by column name."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return ci_distinct(out, mostly_distinct=mostly_distinct)
