"""Spark session helpers.

Library code never builds its own cluster session; it only reads settings from the session it is
given. ``build_session`` is for tests, the bench and local runs.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# private checkpoint folder of a single-JVM session, by application
_PRIVATE: dict[str, str] = {}
# scratch folders of the open scopes, innermost last
_SCOPES: list[list[str]] = []


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "qualmart",
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, taken from ``spark.checkpoint.dir``.

    Only a single-JVM session (``local``, ``local[n]``) without that setting gets a private folder,
    as in tests. Any session with separate executors must name a shared folder, because a
    machine-local one is not seen by the other executors and is lost with its machine.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or _PRIVATE.get(sc.applicationId)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = _PRIVATE[sc.applicationId] = tempfile.mkdtemp(prefix="qualmart-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for written intermediate tables. The
    folder's URI scheme is kept, so the tables land on the file system that the setting names."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/qualmart/{name}-{uuid.uuid4().hex[:12]}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables written inside are deleted at the end, also after an error. Only for work
    whose results lie elsewhere by then: a lazy DataFrame over such a table can't be read any more."""
    _SCOPES.append([])
    try:
        yield
    finally:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in _SCOPES.pop():
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(conf).delete(at, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` once as parquet to a fresh folder under the shared checkpoint
    folder and read it back. One pass (an eager ``checkpoint()`` computes the plan, then computes
    it again to write the files); survives executor loss like a checkpoint does."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)
