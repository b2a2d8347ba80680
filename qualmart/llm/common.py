"""Small helpers shared by the text operators."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

_A_TO_Z = bytes(range(65, 91))
#: For ``bytes.translate``: lower-cases A-Z and leaves every other byte.
LOWER_AZ = bytes.maketrans(_A_TO_Z, _A_TO_Z.lower())
#: For ``bytes.translate``: lower-cases A-Z and turns ASCII other than letters and digits into spaces.
ALNUM_WORDS = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in LOWER_AZ)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_words(text: Column) -> Column:
    """Number of words of a text as a long; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fresh(columns: list[str], base: str) -> str:
    """A column name that none of ``columns`` has, in any case."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base += "_"
    return base


def utf8(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """A text column of an Arrow batch as UTF-8 bytes; null is empty."""
    values = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
    return [v or b"" for v in values.to_pylist()]


#: A key is hot if it holds at least one in this many rows; so there are at most this many hot keys.
HOT_SHARE = 1000


def join_counted(rows: DataFrame, keyed: DataFrame, key: str, n_rows: str, how: str = "inner") -> DataFrame:
    """Join ``rows`` to ``keyed``, which has one row per key with its number of rows ``n_rows``.

    A key that a third of all rows hold would meet in one task. The keys that hold at least 1/1000
    of all counted rows are at most 1000, so they are broadcast; any other key is small. ``how`` is
    inner or left.
    """
    keyed_n = keyed.agg(F.sum(n_rows).alias("total")).first()[0] or 0
    is_hot = F.col(n_rows) * HOT_SHARE >= keyed_n
    hot, cold = keyed.where(is_hot).drop(n_rows), keyed.where(~is_hot).drop(n_rows)
    spread = rows.join(F.broadcast(hot), key, "inner")
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key, how)
    return spread.unionByName(rest)
