"""Report shapes: county benchmark, facility comparison, crosstab, measure summary, ranking,
cross-layer reconciliation and the composite-key outer-join chain."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qualmart.functions.textkeys import ci_eq, ci_key
from qualmart.operators.checksums import only_unequal
from qualmart.plans.model import MEASURE_NAMES, StarModel, measure_query
from qualmart.session import materialize


def county_report(model: StarModel, measure_name: str) -> DataFrame:
    """State, county → regional average score for one measure (slicer with one member)."""
    return measure_query(model, ["FacilityState", "FacilityCountyName"], ["wi_average_score"],
                         filters={"MeasureName": [measure_name]})


def facility_comparison(model: StarModel, measure_name: str) -> DataFrame:
    """Facility / county / city (+ measure, sort-order name) → highest score for one measure,
    ascending by that score."""
    rows = ["FacilityName", "FacilityCountyName", "FacilityCity", "MeasureName",
            "MeasureSortOrderName"]
    return (measure_query(model, rows, ["wi_high_score"], filters={"MeasureName": [measure_name]})
            .orderBy(F.col("wi_high_score").asc_nulls_first(), *rows))


def crosstab(model: StarModel, measure_names: Sequence[str]) -> DataFrame:
    """Facility × measure of the summed score; empty cells stay NULL. The member list is passed
    in, so the pivot needs no extra job to discover it."""
    return measure_query(model, ["FacilityName"], ["measure_score"], cols="MeasureName",
                         col_members=measure_names)


def measure_summary(model: StarModel) -> DataFrame:
    """Measure name × all eight measures (measures as columns)."""
    return measure_query(model, ["MeasureName"], MEASURE_NAMES)


def measure_summary_long(model: StarModel, value_type: str = "decimal(24,7)") -> DataFrame:
    """The same as (measure name, measure, value) rows."""
    wide = measure_summary(model)
    cast = wide.select("MeasureName", *[F.col(m).cast(value_type).alias(m) for m in MEASURE_NAMES])
    return cast.unpivot(["MeasureName"], list(MEASURE_NAMES), "measure", "value")


def rank_facilities(fact: DataFrame, partition: str = "MeasureID", score: str = "Score",
                    direction: str = "MeasureSortOrderNumber", out: str = "facility_rank",
                    num_partitions: int | None = None) -> DataFrame:
    """Rank rows inside each measure by score, honouring the measure's direction (0: a larger
    score ranks first, otherwise a smaller one). Ties share a rank (``RANK``); NULL scores get
    no rank.

    No group is ever handled whole by one task. Rows are first counted per (measure,
    direction-adjusted score) with map-side combine, so any number of equal scores becomes one
    row. Those counts are range-partitioned on (measure, score); a score's rank is one plus the
    counts before it: inside its (partition, measure) slice by a running sum, in earlier partitions
    by an offset (one row per measure and partition). The ranks are then joined back. Rows without
    a score take no part in it and are added as they are.
    """
    sk = F.when(F.col(direction) == 0, -F.col(score)).otherwise(F.col(score))
    keyed = fact.withColumn("_sk", sk)
    scored = keyed.where(F.col("_sk").isNotNull())
    counts = (scored.groupBy(F.col(partition).alias("_rp"), F.col("_sk").alias("_rs"))
                    .agg(F.count(F.lit(1)).alias("_n")))
    # Without an explicit count the adaptive planner sizes the range partitions from the data.
    ranged = (counts.repartitionByRange("_rp", "_rs") if num_partitions is None
              else counts.repartitionByRange(num_partitions, "_rp", "_rs"))
    # Written once: running sums and offsets must come from one range assignment (a recomputed
    # range exchange may sample different bounds).
    local = materialize(ranged.withColumn("_pid", F.spark_partition_id()), "rank")

    def before(*keys: str, order: str) -> Column:
        w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_n").over(w), F.lit(0))

    slices = local.groupBy("_rp", "_pid").agg(F.sum("_n").alias("_n"))
    offsets = slices.select(F.col("_rp").alias("_op"), F.col("_pid").alias("_opid"),
                            before("_rp", order="_pid").alias("_offset"))
    inside = local.withColumn("_local", before("_pid", "_rp", order="_rs"))
    ranks = (inside.join(offsets, F.col("_rp").eqNullSafe(F.col("_op"))
                         & (F.col("_pid") == F.col("_opid")))
                   .select("_rp", "_rs", (F.col("_offset") + F.col("_local") + 1).alias(out)))
    ranked = (scored.join(ranks, F.col(partition).eqNullSafe(F.col("_rp"))
                          & (F.col("_sk") == F.col("_rs"))).drop("_rp", "_rs"))
    unranked = keyed.where(F.col("_sk").isNull()).withColumn(out, F.lit(None).cast("long"))
    return ranked.unionByName(unranked).drop("_sk")


def facility_rank(model: StarModel) -> DataFrame:
    ranked = rank_facilities(model.fact)
    fac = model.dim_facility.select("FacilityKey", "FacilityName")
    return ranked.join(fac, "FacilityKey", "left").select(
        "MeasureName", "FacilityName", "Score", "MeasureSortOrderNumber", "facility_rank")


def point_lookup(outcomes: DataFrame, infections: DataFrame, facility_name: str) -> DataFrame:
    """One facility across both raw feeds: name, measure, score (UNION, case-insensitive)."""
    from qualmart.operators.setops import ci_union
    cols = ["FacilityName", "MeasureName", "Score"]
    return ci_union(outcomes.where(ci_eq("FacilityName", facility_name)).select(*cols),
                    infections.where(ci_eq("FacilityName", facility_name)).select(*cols))


def layer_reconciliation(layers: dict[str, DataFrame]) -> DataFrame:
    """The same (facility, measure) read at several layers, compared with the first one.

    ``layers`` maps a layer name to a DataFrame of (FacilityName, MeasureName, Score); rows are
    keyed case-insensitively. All layers go through one count per (pair, score) with map-side
    combine, then one per pair, so scores are compared as multisets and nothing is joined.
    ``differing_scores`` counts the scores that some layer holds in another number. ``status``:
    ``missing`` (a layer lacks the pair), ``count`` (another number of rows), ``value`` (as many
    rows, other scores) or ``match``."""
    names = list(layers)
    rows = None
    for n in names:
        part = layers[n].select(F.lit(n).alias("_layer"), ci_key("FacilityName").alias("facility_key"),
                                ci_key("MeasureName").alias("measure_key"), "Score")
        rows = part if rows is None else rows.unionByName(part)
    per_score = rows.groupBy("facility_key", "measure_key", "Score").agg(
        *[F.count_if(F.col("_layer") == n).alias(f"{n}_rows") for n in names])

    def differs() -> Column:
        return reduce(or_, [F.col(f"{n}_rows") != F.col(f"{names[0]}_rows") for n in names[1:]], F.lit(False))

    per_layer = [a for n in names for a in (
        F.sum(f"{n}_rows").alias(f"{n}_rows"),
        F.max(F.when(F.col(f"{n}_rows") > 0, F.col("Score"))).alias(f"{n}_score"))]
    pairs = per_score.groupBy("facility_key", "measure_key").agg(
        *per_layer, F.count_if(differs()).alias("differing_scores"))
    missing = reduce(or_, [F.col(f"{n}_rows") == 0 for n in names])
    return pairs.withColumn("status", F.when(missing, "missing").when(differs(), "count")
                            .when(F.col("differing_scores") > 0, "value").otherwise("match"))


def differing_pairs(layers: dict[str, DataFrame]) -> DataFrame:
    """The pairs that ``layer_reconciliation`` doesn't find to match, looked for only in buckets whose
    checksums differ. Equal layers cost one checksum pass and move no rows."""
    keys, values = ["FacilityName", "MeasureName"], ["Score"]
    layers = {n: df.select(*keys, *values) for n, df in layers.items()}
    some = only_unequal(layers, keys, values)
    compared = layer_reconciliation(some if some else {n: df.limit(0) for n, df in layers.items()})
    return compared.where("status <> 'match'")


def composite_key_outer_chain(orders: DataFrame, lineitem: DataFrame, part: DataFrame,
                              supplier: DataFrame) -> DataFrame:
    """``A left (K inner N left R) left K2`` with multi-column keys including an ordinal:

    orders ⟕ lineitem on the order key, ⟕ (lineitem ⋈ part ⟕ supplier) on (order, line number,
    part), ⟕ the order's next line (line number + 1 on the same order), restricted to finished
    orders."""
    a = orders.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_orderdate")
    c = lineitem.select(F.col("l_orderkey").alias("c_orderkey"),
                        F.col("l_linenumber").alias("c_linenumber"),
                        F.col("l_partkey").alias("c_partkey"))
    k = lineitem.select(F.col("l_orderkey").alias("k_orderkey"),
                        F.col("l_linenumber").alias("k_linenumber"),
                        F.col("l_partkey").alias("k_partkey"), F.col("l_suppkey").alias("k_suppkey"))
    n = part.select("p_partkey", "p_brand")
    r = supplier.select("s_suppkey", "s_name")
    inner = (k.join(n, k.k_partkey == n.p_partkey, "inner")
              .join(r, F.col("k_suppkey") == r.s_suppkey, "left"))
    k2 = lineitem.select(F.col("l_orderkey").alias("k2_orderkey"),
                         F.col("l_linenumber").alias("k2_linenumber"),
                         F.col("l_suppkey").alias("k2_suppkey"))
    out = (a.join(c, a.o_orderkey == c.c_orderkey, "left")
            .join(inner, (F.col("c_orderkey") == F.col("k_orderkey"))
                  & (F.col("c_linenumber") == F.col("k_linenumber"))
                  & (F.col("c_partkey") == F.col("k_partkey")), "left")
            .join(k2, (F.col("k_orderkey") == F.col("k2_orderkey"))
                  & (F.col("k2_linenumber") == F.col("k_linenumber") + 1), "left"))
    return out.select("o_orderkey", "o_orderdate", "c_linenumber", "c_partkey", "p_brand",
                      "s_name", "k2_linenumber", "k2_suppkey")
