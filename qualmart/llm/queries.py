"""Registered queries of the operators: each applies one to its whole table."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from qualmart.llm import decontam, merkle, mixing, sketch, spelling, warc
from qualmart.llm.common import table


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix of all documents at the sources' target weights."""
    m = mixing.mix(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return m.select("row.doc_id", "size", "source_size", "target", "taken")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents by the public byte-level vocabulary."""
    import public_tokenizers

    from qualmart.llm.tokens import token_counts
    return token_counts(table(spark, sf_dir, "documents"),
                        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of the learned decision list on all documents."""
    from qualmart.llm.rules import judged
    return judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives with revisit records, and read back."""
    records, _ = warc.archived(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents by the factorisation machine."""
    from qualmart.llm.fm import quality
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masked pseudo-likelihood of all documents by a network fitted on all of them."""
    from qualmart.llm.lm import pseudo_likelihood
    return pseudo_likelihood(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of all documents."""
    from qualmart.llm.simhash import near_duplicates
    d = near_duplicates(table(spark, sf_dir, "documents"))
    return d.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    "component_id")


def _is(name: str, value: Column) -> Column:
    return value == name


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with pseudonyms for personal data, and how many of each kind."""
    from qualmart.llm import pii
    out = pii.pseudonymised(table(spark, sf_dir, "documents").select("doc_id", "text"),
                            key=pii.session_key(spark, corpus_pipeline.TEST_KEY))
    kinds = [F.size(F.filter("kinds", partial(_is, name))).alias(f"n_{name}")
             for name in pii.KINDS]
    return out.select("row.doc_id", "text", F.size("kinds").alias("n_found"), *kinds)


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of all documents."""
    from qualmart.llm.licenses import scanned
    return scanned(table(spark, sf_dir, "documents")).drop("detections")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in all documents."""
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("spans")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents against the manifest's root, some of them tampered with."""
    changed = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return merkle.verified(table(spark, sf_dir, "documents"), changed,
                           tampered={"text": merkle.lowered(F.col("text"))})


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants of the words of all documents."""
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return sketch.edited(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline over all documents."""
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_mixing, op2_token_counts, op3_quality_rules, op4_warc,
                                    op5_quality_classifier, op6_lm_scoring, op7_simhash, op8_pii,
                                    op9_licenses, op10_decontamination, op11_merkle,
                                    op12_spelling, op13_sketch, pipeline)}
ORACLE_SQL = {"op1_mixing": mixing.SQL, "op4_warc": warc.SQL, "op10_decontamination": decontam.SQL,
              "op11_merkle": merkle.SQL, "op12_spelling": spelling.SQL, "op13_sketch": sketch.SQL}
