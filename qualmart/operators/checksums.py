"""Reconciling layers by order-free checksums, row by row only where they differ.

Rows are dealt to buckets by a hash of their canonical keys. A layer's bucket is described by its number
of rows and the sum of its rows' 64-bit hashes: the same for every order, and different for a lost,
added, repeated or changed row. So a layer sends one small row per task and bucket, and only rows of
unequal buckets are compared.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualmart.functions.textkeys import ci_key
from qualmart.session import materialize

#: Buckets by default; the list of unequal ones, which is broadcast, has no more rows than this.
BUCKETS = 4096


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[ci_key(k) for k in keys]), F.lit(buckets)).cast("int")


def bucket_sums(df: DataFrame, keys: Sequence[str], values: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """(bucket, rows, hashes): one row per bucket that has rows."""
    row = F.xxhash64(*[ci_key(k) for k in keys], *[F.col(v) for v in values])
    return df.groupBy(_bucket(keys, buckets).alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(row.cast("decimal(20,0)")).alias("hashes"))


def unequal_buckets(layers: Mapping[str, DataFrame], keys: Sequence[str], values: Sequence[str],
                    buckets: int = BUCKETS) -> DataFrame:
    """The buckets in which some layer differs from the first."""
    names = list(layers)
    sums = reduce(DataFrame.unionByName, [
        bucket_sums(df, keys, values, buckets).withColumn("layer", F.lit(n)) for n, df in layers.items()])
    per = [F.max(F.when(F.col("layer") == n, F.struct("rows", "hashes"))).alias(n) for n in names]
    differs = reduce(or_, [~F.col(names[0]).eqNullSafe(F.col(n)) for n in names[1:]], F.lit(False))
    return sums.groupBy("bucket").agg(*per).where(differs).select("bucket")


def only_unequal(layers: Mapping[str, DataFrame], keys: Sequence[str], values: Sequence[str],
                 buckets: int = BUCKETS) -> dict[str, DataFrame] | None:
    """The layers' rows in unequal buckets; None if the layers are equal as multisets."""
    found = materialize(unequal_buckets(layers, keys, values, buckets), "unequal")
    if found.isEmpty():
        return None
    return {n: df.withColumn("_bucket", _bucket(keys, buckets)).join(
        F.broadcast(found.withColumnRenamed("bucket", "_bucket")), "_bucket", "left_semi").select(df.columns)
        for n, df in layers.items()}
