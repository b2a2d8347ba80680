"""Tables laid out by their merge keys: bucketed, and partitioned where a slicer can prune.

A bucketed table is known to the session's catalog, so a join on its bucket columns reads it without
a shuffle. The files alone don't say how many buckets there are; the caller keeps that number with
the table's path (``TableStore`` has it in the version's folder name).
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

#: A bucket this many times the median (and at least so many bytes) makes a join prefer the shuffle,
#: whose partitions the adaptive planner can split.
SKEW_FACTOR, SKEW_BYTES = 5, 256 << 20
_BUCKET = re.compile(r"_(\d+)(?:\.[^/]*)?$")


@dataclass(frozen=True)
class Layout:
    """keys: bucket columns, the merge keys in order · sort: order inside a bucket · partition: columns
    that become folders"""
    keys: tuple[str, ...]
    sort: tuple[str, ...] = ()
    partition: tuple[str, ...] = ()

    def spread(self, df: DataFrame, buckets: int) -> DataFrame:
        """One task per bucket, so that each writes files of its own bucket only."""
        return df.repartition(buckets, *self.keys)


def _name(path: str) -> str:
    return f"qualmart_{hashlib.md5(path.encode()).hexdigest()}"


def save(df: DataFrame, path: str, layout: Layout, buckets: int) -> DataFrame:
    """Write ``df`` bucketed to ``path`` and return the table. Rows should come one bucket a task
    (``Layout.spread``), else each task writes a file for each of its buckets."""
    out = df.write.mode("errorifexists").option("path", path).bucketBy(buckets, *layout.keys)
    out = out.sortBy(*layout.sort) if layout.sort else out
    out = out.partitionBy(*layout.partition) if layout.partition else out
    out.saveAsTable(_name(path))
    return df.sparkSession.table(_name(path))


def load(spark: SparkSession, path: str, layout: Layout, buckets: int) -> DataFrame:
    """The table at ``path``; a session that doesn't know it yet is told of its layout."""
    name = _name(path)
    if not spark.catalog.tableExists(name):
        fields = spark.read.parquet(path).schema.fields
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        keys, sort = ", ".join(layout.keys), ", ".join(layout.sort)
        folders = f"PARTITIONED BY ({', '.join(layout.partition)})" if layout.partition else ""
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {folders} CLUSTERED BY ({keys}) "
                  f"{f'SORTED BY ({sort})' if sort else ''} INTO {buckets} BUCKETS LOCATION '{path}'")
        if layout.partition:
            spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def bucket_bytes(df: DataFrame) -> dict[int, int]:
    """Bytes of each bucket that ``df`` reads; a bucket may have a file in each partition folder."""
    sc = df.sparkSession.sparkContext
    path_of, conf = sc._jvm.org.apache.hadoop.fs.Path, sc._jsc.hadoopConfiguration()
    out = Counter()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        at = path_of(folder)
        for status in at.getFileSystem(conf).listStatus(at):
            found = _BUCKET.search(status.getPath().getName())
            if found:
                out[int(found[1])] += status.getLen()
    return dict(out)


def is_skewed(df: DataFrame) -> bool:
    sizes = sorted(bucket_bytes(df).values())
    return bool(sizes) and sizes[-1] > max(SKEW_BYTES, SKEW_FACTOR * sizes[len(sizes) // 2])


def merge_target(df: DataFrame, path: str) -> DataFrame:
    """A bucketed table as the target of a merge: as it is, or without its buckets where one of them is
    far larger than the others."""
    return df.sparkSession.read.parquet(path) if is_skewed(df) else df
