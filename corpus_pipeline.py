"""Corpus pipeline: quality rules, near-duplicates, decontamination, personal data, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qualmart.llm import decontam, mixing, pii, rules, simhash
from qualmart.llm.common import fresh, table
from qualmart.session import materialize


#: Key of the pseudonyms where the session sets none: good enough for made-up documents only.
TEST_KEY = "pseudonym-key"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned decision list keeps."""
    return rules.kept_documents(docs, table(spark, sf_dir, "labels"))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component: the one with the smallest (id, fingerprint).

    A row without an id comes after those with one. Rows of equal id and fingerprint are one document;
    one of them stays. The fingerprint is computed again only for rows whose id doesn't name one row."""
    rows = materialize(simhash.members(docs).select("doc_id", "fp", "root"), "dedup-rows")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "fp"))
    first = rows.groupBy("root").agg(least.alias("first")).select("first.doc_id", "first.fp")
    n = rows.groupBy("doc_id").agg(F.count("*").alias("n"))
    # sorted merge at any size: the lists of ids grow with the documents, so they aren't broadcast
    chosen = materialize(first.where("doc_id IS NOT NULL").join(n.hint("merge"), "doc_id").unionByName(
        first.where("doc_id IS NULL").withColumn("n", F.lit(None).cast("long"))), "dedup-first")
    whole = docs.join(chosen.where("n = 1").select("doc_id").hint("merge"), "doc_id", "left_semi").select(docs.columns)
    unsure = chosen.where("n IS NULL OR n > 1").select("doc_id", "fp")
    if unsure.isEmpty():
        return whole
    d = docs.where("doc_id IS NULL").unionByName(docs.join(
        unsure.where("doc_id IS NOT NULL").select("doc_id").distinct().hint("merge"), "doc_id", "left_semi").select(docs.columns))
    fp = fresh(docs.columns, "fp")
    d = simhash.with_fingerprint(d, fp).dropDuplicates(["doc_id", fp]).alias("d")
    u = unsure.hint("merge").alias("u")
    same = F.col("d.doc_id").eqNullSafe(F.col("u.doc_id")) & (F.col(f"d.{fp}") == F.col("u.fp"))
    return whole.unionByName(d.join(u, same, "left_semi").select(docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of benchmark passages."""
    return decontam.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms for personal data."""
    return pii.redacted(docs, key=pii.session_key(spark, TEST_KEY))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents at the sources' target weights, once per epoch that takes words of them."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("mixture", mixture),
]

#: The learned list, the fingerprints and the pseudonyms have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written to the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
