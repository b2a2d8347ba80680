"""Mixing sources to target weights by hash-random order, prefix sums and an exact cut.

Every document gets a hash-random key, of its id and text. The key space is cut into ``CHUNKS`` equal
key ranges; the sums of words per source and chunk are a small table, and their running sums tell in which
chunk a source's cut lies. Documents in front of that chunk are taken whole, those behind it not at all;
only the chunk of the cut, 1/65,536 of a source, is put in order, and its running sums give the exact cut.
So whole documents are never sorted or shuffled, and a source that holds most rows stays spread. A source's
budget is its target rounded down: whole epochs take every document, the last, partial epoch takes the
words in front of the cut.

Nothing depends on how rows are partitioned: the order is (key, id, size), so reruns agree.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qualmart.llm.common import fresh, n_words
from qualmart.session import materialize

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: No document is taken more often than this.
MAX_EPOCHS = 3
SEED = "mix:"
#: Leading hexadecimal digits of a key that number its chunk, and so the number of chunks.
CHUNK_DIGITS = 4
CHUNKS = 16 ** CHUNK_DIGITS


def repeating_weight(rank: Column) -> Column:
    """Weight of the source with this rank (from 0)."""
    return F.element_at(F.array(*map(F.lit, WEIGHTS)), (rank % len(WEIGHTS) + 1).cast("int"))


def targets(sources: DataFrame, weight: Callable[[Column], Column] = repeating_weight,
            max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(src, source, source_size) -> the same with ``target``.

    Targets share the words of all sources by weight, stop at ``max_epochs`` times the source, and
    the excess is shared again by weight. The fixed point: sorted by cap / weight, a first part of
    the sources is capped, the others get weight x (rest of words) / (rest of weights). The input
    has one row per source (pre-aggregated), so the unpartitioned windows see the list of sources,
    not documents.
    """
    every = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), F.col("rank"))
    upto = by_ratio.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = (sources.withColumn("rank", F.row_number().over(by_name) - 1)
                .withColumn("w", weight(F.col("rank")).cast("double"))
                .withColumn("cap", F.col("source_size").cast("double") * max_epochs)
                .withColumn("words", F.sum("source_size").over(every).cast("double")))
    s = (s.withColumn("cap_before", F.sum("cap").over(upto) - F.col("cap"))
          .withColumn("w_rest", F.sum("w").over(every) - F.sum("w").over(upto) + F.col("w"))
          .withColumn("capped", F.col("cap") * F.col("w_rest")
                      <= F.col("w") * (F.col("words") - F.col("cap_before"))))
    free = F.col("words") - F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0.0)).over(every)
    weights = F.sum(F.when(F.col("capped"), 0.0).otherwise(F.col("w"))).over(every)
    return s.select("src", "source_size",
                    F.when(F.col("capped"), F.col("cap"))
                     .otherwise(F.col("w") * free / weights).alias("target"))


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", keep: list[str] | None = None,
        weight: Callable[[Column], Column] = repeating_weight,
        max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """One row per document: ``row`` (a struct of the columns ``keep``, by default all), ``size``
    (words), ``source_size``, ``target`` (its source's) and ``taken`` (words the mix takes, repeats
    counted).

    Null texts and empty texts have size 0 and are taken 0 words. The null source is a source, last
    in order. Rows without an id, or with a repeated one, are told apart by their texts; rows equal in
    both are interchangeable. An empty table gives an empty result. Other columns ride along in ``row``,
    so their names can't clash.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), text))
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row"),
        F.col(id_col).alias("id"), text.alias("text"),
        F.when(F.col(source_col).isNull(), F.lit("-"))
         .otherwise(F.concat(F.lit("+"), F.col(source_col))).alias("src"), key.alias("key")).withColumn(
        "chunk", F.conv(F.substring("key", 1, CHUNK_DIGITS), 16, 10).cast("int"))
    size = n_words(F.col("text")).alias("size")

    sums = materialize(keyed.select("src", "chunk", size).groupBy("src", "chunk").agg(
        F.sum("size").alias("chunk_size")), "mix-chunks")
    per_source = (sums.groupBy("src").agg(F.sum("chunk_size").alias("source_size"))
                      .withColumn("source", F.when(F.col("src") == "-", None)
                                  .otherwise(F.expr("substring(src, 2)"))))
    wanted = targets(per_source, weight, max_epochs).withColumn("whole", F.when(
        F.col("source_size") > 0, F.expr("floor(target) div source_size")).otherwise(0).cast("long"))
    wanted = wanted.withColumn("rest", F.floor("target").cast("long") - F.col("whole") * F.col("source_size"))
    # a source has at most CHUNKS sums
    before = F.sum("chunk_size").over(Window.partitionBy("src").orderBy("chunk")) - F.col("chunk_size")
    cut = (sums.withColumn("before", before).join(wanted.select("src", "rest"), "src")
               .where(F.col("before") + F.col("chunk_size") > F.col("rest"))
               .groupBy("src").agg(F.min(F.struct("chunk", "before")).alias("cut")))
    # one row per source; read by both parts below
    wanted = materialize(wanted.join(cut, "src", "left").select(
        "src", "source_size", "target", "whole", "rest", F.col("cut.chunk").alias("cut"), "cut.before"), "mix-cuts")

    d = keyed.join(wanted, "src")
    at_cut = F.coalesce(F.col("chunk") == F.col("cut"), F.lit(False))
    outside = d.where(~at_cut).withColumn("size", size).withColumn(
        "partial", F.when(F.col("chunk") < F.col("cut"), F.col("size")).otherwise(0))
    order = (Window.partitionBy("src").orderBy("key", "id", "size")
                   .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inside = d.where(at_cut).withColumn("size", size).withColumn(
        "front", F.col("before") + F.sum("size").over(order) - F.col("size")).withColumn(
        "partial", F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("front")))).drop("front")
    return outside.unionByName(inside).select(
        "row", "size", "source_size", "target",
        (F.col("whole") * F.col("size") + F.col("partial")).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as training rows: each document once per epoch that takes words of it, with the
    columns of ``docs`` plus a struct ``mix`` (``mix_`` and so on if that name is taken):
    ``epoch`` from 1, ``taken`` (words of this copy; fewer than ``size`` only at a source's cut),
    ``size``, ``source_size`` and ``target``. Documents of which nothing is taken are left out."""
    m = mix(docs, **options).where("taken > 0")
    epochs = F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int"))
    m = m.withColumn("epoch", F.explode(epochs))
    left = F.col("taken") - (F.col("epoch") - 1) * F.col("size")
    return m.select("row.*", F.struct(
        "epoch", F.least("size", left).alias("taken"), "size", "source_size", "target",
    ).alias(fresh(docs.columns, "mix")))


#: DuckDB SQL of ``mix`` over ``documents``.
SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS k
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (
  SELECT *, [5.0::DOUBLE, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w,
         3.0::DOUBLE * source_size AS cap, (sum(source_size) OVER ())::DOUBLE AS words
  FROM s),
p AS (
  SELECT *, sum(cap) OVER o - cap AS cap_before, sum(w) OVER () - sum(w) OVER o + w AS w_rest
  FROM r WINDOW o AS (ORDER BY cap / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
c AS (SELECT *, cap * w_rest <= w * (words - cap_before) AS capped FROM p),
t AS (
  SELECT source, source_size, CASE WHEN capped THEN cap ELSE
           w * (words - sum(CASE WHEN capped THEN cap ELSE 0.0::DOUBLE END) OVER ())
           / sum(CASE WHEN capped THEN 0.0::DOUBLE ELSE w END) OVER () END AS target
  FROM c),
x AS (
  SELECT doc_id, size, source_size, target,
         sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id NULLS FIRST, size
                         ROWS UNBOUNDED PRECEDING) - size AS before,
         CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS whole
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (whole * size + greatest(0, least(size, floor(target)::BIGINT - whole * source_size - before)))::BIGINT
         AS taken
FROM x
"""
