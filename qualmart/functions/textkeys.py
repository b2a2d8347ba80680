"""Case- and trailing-blank-insensitive text comparison.

The source warehouse compares text under a case-insensitive collation that also ignores trailing
blanks: ``'Milwaukee'`` matches ``'MILWAUKEE '``. Every comparison of feed text (filters, joins,
merges, DISTINCT, UNION, GROUP BY) goes through one canonical key, ``lower(rtrim(x))``, while the
original value is kept for display. A plain binary key keeps hash joins and aggregations on the fast
path (no collation-aware hashing) and is expressible in any SQL engine.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ci_key(c: str | Column) -> Column:
    """Canonical comparison key of a text column (NULL stays NULL)."""
    return F.lower(F.rtrim(_col(c)))


def ci_literal(value: str | None) -> str | None:
    """The same canonicalisation applied to a Python literal."""
    return None if value is None else value.rstrip(" ").lower()


def ci_eq(c: str | Column, value: str) -> Column:
    return ci_key(c) == F.lit(ci_literal(value))


def ci_isin(c: str | Column, values: Iterable[str]) -> Column:
    return ci_key(c).isin([ci_literal(v) for v in values])
