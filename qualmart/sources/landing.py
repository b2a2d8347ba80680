"""Landing feeds: CSV in, all-text columns out (no schema inference)."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from qualmart.functions.clean import DEFAULT_DATE_FORMAT, is_date_reject, is_reject
from qualmart.operators.feeds import ROW_RULES
from qualmart.sources.schemas import (INFECTIONS_COLUMNS, INFECTIONS_SCHEMA, OUTCOMES_COLUMNS,
                                      OUTCOMES_SCHEMA)

SCHEMAS = {"outcomes": OUTCOMES_SCHEMA, "infections": INFECTIONS_SCHEMA}


def read_feed(spark: SparkSession, path: str, kind: str, header: bool = True,
              mode: str = "FAILFAST") -> DataFrame:
    """Read one feed's CSV file(s) with its declared all-string schema. Quoted fields may contain
    commas (footnotes such as ``"1, 2"``). ``FAILFAST`` stops on a malformed row."""
    return (spark.read.schema(SCHEMAS[kind])
                 .option("header", header).option("quote", '"').option("escape", '"')
                 .option("mode", mode).option("multiLine", False)
                 .csv(path))


#: Columns without which a row can't be placed.
REQUIRED = ("FacilityName", "State", "CountyName", "MeasureID", "MeasureName", "StartDate", "EndDate")
_LINE, _WHY = "_line", "_reasons"
#: Most lines in one file of raw lines: a compressed file is read by a single task.
LINES_PER_FILE = 1_000_000
#: Writers a task may have open at once. It sorts its rows by folder once it has as many open, so two folders
#: need a limit of three.
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def reject_reasons(kind: str, date_format: str = DEFAULT_DATE_FORMAT) -> Column:
    """Why a row can't be loaded, as an array of texts (empty: it can): values that are missing, beyond
    their declared length, or neither a number nor the feed's own mark, and texts that are no date."""
    numbers, sentinels = ROW_RULES[kind]
    limits = dict(OUTCOMES_COLUMNS if kind == "outcomes" else INFECTIONS_COLUMNS)
    tests = [(F.col(c).isNull(), f"{c} is missing") for c in REQUIRED]
    tests += [(is_reject(c, sentinels), f"{c} is not a number") for c in numbers]
    tests += [(is_date_reject(c, date_format), f"{c} is not a date") for c in ("StartDate", "EndDate")]
    tests += [(F.length(c) > n, f"{c} is longer than {n}") for c, n in limits.items()]
    return F.filter(F.array(*[F.when(test, F.lit(why)) for test, why in tests]), lambda why: why.isNotNull())


def land_with_quarantine(spark: SparkSession, path: str, kind: str, out: str, header: bool = True,
                         date_format: str = DEFAULT_DATE_FORMAT) -> tuple[DataFrame, DataFrame]:
    """Read one feed's CSV files once and write every line to one of two folders under ``out``.

    Returns (rows that load, quarantine). The quarantine has the feed's columns, the reasons, and for a
    line with too few or too many fields the line itself; its columns are then NULL, because nobody
    knows which values were lost. Nothing is dropped: the two have as many rows as there are lines. Each
    task fills both folders side by side; a sort of its rows by folder would spill, since a compressed
    file can't be split."""
    schema = SCHEMAS[kind]
    read = (spark.read.schema(StructType([*schema.fields]).add(_LINE, "string"))
                 .option("header", header).option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE")
                 .option("columnNameOfCorruptRecord", _LINE).option("columnPruning", False).csv(path))
    broken = F.col(_LINE).isNotNull()
    why = F.when(broken, F.array(F.lit("wrong number of fields"))).otherwise(reject_reasons(kind, date_format))
    columns = [F.when(~broken, F.col(c)).alias(c) for c in schema.names]
    rows = read.withColumn(_WHY, why).select(*columns, _LINE, _WHY, (F.size(_WHY) > 0).alias("_rejected"))
    with _setting(spark, _WRITERS, "3"):
        rows.write.mode("errorifexists").partitionBy("_rejected").parquet(out)
    landed = spark.read.schema(rows.schema).parquet(out)
    return (landed.where("NOT _rejected").select(*schema.names),
            landed.where("_rejected").select(*schema.names, F.col(_LINE).alias("line"), F.col(_WHY).alias("reasons")))


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session that holds inside only, also after an error."""
    was = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if was is None else spark.conf.set(key, was)


def write_lines(lines: DataFrame, path: str) -> None:
    """Write a feed's raw lines (one text column), damaged ones included. Compressed like ``write_landing``."""
    lines.write.option("compression", "gzip").option("maxRecordsPerFile", LINES_PER_FILE).text(path)


def write_landing(df: DataFrame, path: str) -> None:
    """Replace the landing copy of a feed (drop-and-recreate semantics). Text columns only; blanks at
    either end of a value are kept. One compressed file per task: a feed repeats its long texts in every
    line, and its lines would outweigh all later steps together."""
    (df.select(*[F.col(c).cast("string") for c in df.columns])
       .write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .option("compression", "gzip").csv(path))
