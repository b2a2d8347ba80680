"""Dense surrogate keys in a defined total order, without a single-partition window.

``row_number()`` over an un-partitioned window funnels every row through one task. Instead:

1. range-partition on the order columns and sort inside each partition (one shuffle, balanced by
   the sampled range bounds, so a hot value cannot pile up beyond one range),
2. tag each row with its partition id and position (``monotonically_increasing_id``) and cut the
   lineage by writing the tagged rows once to the shared checkpoint folder, so recomputation after
   an executor loss cannot renumber,
3. count rows per partition (one row per partition), turn the counts into offsets, and
4. join the offsets back (broadcast: its size is the partition count, not the data size).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qualmart.session import ensure_checkpoint_dir, materialize, scratch_path
from qualmart.sources import tables

_PID, _POS = "_qm_pid", "_qm_pos"


def assign_keys(df: DataFrame, key_col: str, order: Sequence[Column | str], start: int = 1,
                num_partitions: int | None = None, key_type: str = "long") -> DataFrame:
    """Add ``key_col`` = start, start+1, … following ``order`` (which must be a total order for
    the numbering to be reproducible)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    # Without an explicit count the adaptive planner sizes the range partitions from the data.
    ranged = (df.repartitionByRange(*order_cols) if num_partitions is None
              else df.repartitionByRange(num_partitions, *order_cols))
    ranged = materialize(ranged
                         .sortWithinPartitions(*order_cols)
                         .withColumn(_PID, F.spark_partition_id())
                         .withColumn(_POS, F.monotonically_increasing_id()), "keys")
    counts = ranged.groupBy(_PID).agg(F.count(F.lit(1)).alias("_n"), F.min(_POS).alias("_first"))
    w = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PID, "_first",
                            F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_offset"))
    key = (F.lit(start) + F.col("_offset") + (F.col(_POS) - F.col("_first"))).cast(key_type)
    return (ranged.join(F.broadcast(offsets), _PID)
                  .withColumn(key_col, key)
                  .drop(_PID, _POS, "_first", "_offset"))


def assign_keys_in_buckets(df: DataFrame, key_col: str, order: Sequence[str], layout: tables.Layout,
                           buckets: int, start: int = 1, key_type: str = "long") -> DataFrame:
    """``assign_keys`` of rows that ``layout.spread`` has dealt to buckets; they stay there.

    ``order`` begins with the bucket columns, in any order and never NULL, and NULLs come first in the rest
    of it. Then all rows of a group (equal bucket columns) lie in one bucket and get consecutive keys:
    a row's key is its place in its group plus the rows of the groups before. The rows are sorted and
    written once, bucketed; only one (group, count) pair per group is range-partitioned and dealt back."""
    spark, group = df.sparkSession, list(order[:len(layout.keys)])
    if set(group) != set(layout.keys):
        raise ValueError(f"order must begin with the bucket columns {layout.keys}")
    placed = (df.sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order])
                .withColumn(_POS, F.monotonically_increasing_id()))
    rows = tables.save(placed, scratch_path(spark, "keys"), tables.Layout(layout.keys), buckets)
    counts = rows.groupBy(*layout.keys).agg(F.count(F.lit(1)).alias("_n"), F.min(_POS).alias("_first"))
    ranged = materialize(counts.repartitionByRange(*group).withColumn(_PID, F.spark_partition_id()), "key-groups")
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(_PID).orderBy(*group).rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy(_PID).agg(F.sum("_n").alias("_rows")).select(
        _PID, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    offsets = (ranged.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
                     .join(F.broadcast(parts), _PID)
                     .select(*layout.keys, (F.col("_before") + F.col("_inside") - F.col("_first")).alias("_offset")))
    key = (F.lit(start) + F.col("_offset") + F.col(_POS)).cast(key_type)
    return (rows.join(offsets.hint("shuffle_hash"), list(layout.keys))
                .withColumn(key_col, key).drop(_POS, "_offset"))
