"""Versioned table store with an all-or-nothing publish.

Layout under ``root`` (any Hadoop-compatible shared folder)::

    root/v<N>-<run id>-b<B>/<table>/   parquet files written by one refresh attempt, B buckets
    root/_published/              append-only parquet log: (version, folder, published_at)

A refresh writes every table of its attempt folder, verifies it, and only then appends one row
to the log. Readers take the folder of the largest published version, so a failed or abandoned
attempt (its folder has a unique run id) is never read and never collides with a retry.
One ``TableStore`` object is one writer; it remembers the version it last saw or published.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from qualmart.sources import tables
from qualmart.sources.schemas import LAYOUTS

LOG_SCHEMA = "version int, folder string, published_at timestamp"
#: Rows of both feeds per bucket, at most, of a first load: few enough for a task to sort in memory.
ROWS_PER_BUCKET = 1_000_000


class TableStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark = spark
        self._given = buckets is not None
        self.buckets = buckets or min(int(spark.conf.get("spark.sql.shuffle.partitions")),
                                      4 * spark.sparkContext.defaultParallelism)
        self.root = root.rstrip("/")
        self._folders: dict[int, str] = {}
        self._published: int | None = None   # last version this writer saw or published

    def _log_path(self) -> str:
        return f"{self.root}/_published"

    def _log(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(LOG_SCHEMA).parquet(self._log_path())
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def published_version(self) -> int | None:
        if self._published is not None:
            return self._published
        log = self._log()
        if log is None:
            return None
        v = log.agg(F.max("version")).first()[0]
        self._published = None if v is None else int(v)
        return self._published

    def next_version(self) -> int:
        """Next version number; its folder gets a fresh run id. Buckets are as many as in the version before,
        unless the caller named their number, so that merges find the rows where they are."""
        last = self.published_version()
        if last and not self._given:
            self.buckets = self._buckets_of(last)
        v = (last or 0) + 1
        self._folders[v] = f"v{v}-{uuid.uuid4().hex[:12]}-b{self.buckets}"
        return v

    def _buckets_of(self, version: int) -> int:
        return int(self._folder(version).rsplit("-b", 1)[1])

    def fit_buckets(self, version: int, rows: int) -> None:
        """More buckets for a version of which nothing is written yet, if it will have many rows."""
        if not self._given and rows > self.buckets * ROWS_PER_BUCKET:
            self.buckets = -(-rows // ROWS_PER_BUCKET)
            self._folders[version] = f"{self._folder(version).rsplit('-b', 1)[0]}-b{self.buckets}"

    def _folder(self, version: int) -> str:
        if version in self._folders:
            return self._folders[version]
        log = self._log()
        row = None if log is None else log.where(F.col("version") == version).first()
        if row is None:
            raise FileNotFoundError(f"version {version} is not published under {self.root}")
        self._folders[version] = row.folder
        return row.folder

    def path(self, name: str, version: int) -> str:
        return f"{self.root}/{self._folder(version)}/{name}"

    def write(self, name: str, df: DataFrame, version: int, metrics: dict[str, Column] | None = None,
              path: str | None = None) -> tuple[DataFrame, dict]:
        """Write one table of a version, or an intermediate one to ``path``; returns it read back (lineage
        cut here) and the values of the aggregates in ``metrics``, taken from the rows as they are written."""
        path, seen = path or self.path(name, version), Observation()
        if metrics:
            df = df.observe(seen, *[m.alias(k) for k, m in metrics.items()])
        if name in LAYOUTS:
            back = tables.save(df, path, LAYOUTS[name], self.buckets)
        else:
            df.write.mode("errorifexists").parquet(path)
            back = self.spark.read.parquet(path)
        return back, seen.get if metrics else {}

    def read(self, name: str, version: int | None = None) -> DataFrame:
        v = self.published_version() if version is None else version
        if v is None:
            raise FileNotFoundError(f"no published version under {self.root}")
        path = self.path(name, v)
        if name in LAYOUTS:
            return tables.load(self.spark, path, LAYOUTS[name], self._buckets_of(v))
        return self.spark.read.parquet(path)

    def merge_target(self, name: str, version: int) -> DataFrame:
        """A table as the target of a merge (``tables.merge_target``)."""
        df = self.read(name, version)
        return tables.merge_target(df, self.path(name, version)) if name in LAYOUTS else df

    def publish(self, version: int) -> None:
        row = [(version, self._folder(version),
                dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))]
        (self.spark.createDataFrame(row, LOG_SCHEMA)
             .coalesce(1).write.mode("append").parquet(self._log_path()))
        self._published = version
