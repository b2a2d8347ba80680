"""Uniqueness and containment of integer keys by bitmaps.

A key is a bit: bucket ``bitmap_bucket_number`` holds 32,768 neighbouring keys, ``bitmap_bit_position``
is the place in it. A task folds its rows into one bitmap of 4 kB per bucket it meets, so a shuffle moves
bitmaps and not rows, whatever the number of rows per key. Where a bucket's rows outnumber its bits, a
key repeats; where the union of child and parent has more bits than the parent, a child's key is missing
there. Only such buckets are looked at row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _bucket(key: str) -> Column:
    return F.bitmap_bucket_number(F.col(key).cast("long"))


def key_bitmaps(df: DataFrame, key: str) -> DataFrame:
    """(bucket, rows, bits) of the non-NULL keys."""
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(F.col(key).cast("long")))
    return df.where(F.col(key).isNotNull()).groupBy(_bucket(key).alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"), bits.alias("bits"))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """(key_value, row_count) of the keys that occur more than once, and of NULL if it occurs."""
    crowded = key_bitmaps(df, key).where(F.col("rows") > F.bitmap_count("bits")).select("bucket")
    keys = df.select(F.col(key).cast("long").alias("key_value"), _bucket(key).alias("bucket"))
    repeated = (keys.join(crowded, "bucket", "left_semi").groupBy("key_value")
                    .agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1"))
    nulls = df.where(F.col(key).isNull()).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 0")
    return repeated.unionByName(nulls.select(F.lit(None).cast("long").alias("key_value"), "row_count"))


def missing_parents(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """(key_value, row_count) of the child's non-NULL foreign keys without a parent row."""
    own, there = key_bitmaps(child, fk), key_bitmaps(parent, pk)
    sides = own.select("bucket", "bits", F.lit(False).alias("is_parent")).unionByName(
        there.select("bucket", "bits", F.lit(True).alias("is_parent")))
    held = F.sum(F.when(F.col("is_parent"), F.bitmap_count("bits")).otherwise(F.lit(0)))
    wanting = sides.groupBy("bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("all"), held.alias("held"))
    wanting = wanting.where(F.col("all") > F.col("held")).select("bucket")
    keys = child.where(F.col(fk).isNotNull()).select(F.col(fk).cast("long").alias("key_value"),
                                                     _bucket(fk).alias("bucket"))
    keys = keys.join(wanting, "bucket", "left_semi").groupBy("key_value").agg(F.count(F.lit(1)).alias("row_count"))
    known = parent.select(F.col(pk).cast("long").alias("key_value"), _bucket(pk).alias("bucket"))
    known = known.join(wanting, "bucket", "left_semi").select("key_value")
    return keys.join(known, "key_value", "left_anti")
