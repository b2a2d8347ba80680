"""Keyed upsert (MERGE without a row-level-operation catalog).

``upsert`` returns the new version of a target table:

* target rows matched by a source row get the listed columns from the source (others stay, even if
  stale),
* source rows without a match are inserted with new dense surrogate keys after the current maximum,
* target rows without a match are kept (rows never disappear),
* a target row matched by more than one source row is an error (MERGE semantics),
* NULL keys never match; text keys compare case-insensitively.

Plan shape. Rows with a NULL key are set aside: they would all meet in one task and can't match. The
kept rows are the target left-joined to the source, a join whose target side the adaptive planner
splits where a key is hot. (It can't split a full outer join.) The inserts are the source anti-joined
to the target's distinct keys, which are combined map-side, so a hot key is one row there. Conflicts
are looked for before the join, among the source's repeated keys. A target that is bucketed by the
merge keys takes part in all of this without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from qualmart.functions.textkeys import ci_key
from qualmart.operators.keys import assign_keys
from qualmart.session import materialize
from qualmart.sources.schemas import conform


class MergeConflict(RuntimeError):
    """A target row is matched by more than one source row."""


def _key_exprs(df: DataFrame, cols: Sequence[str], prefix: str) -> list[Column]:
    types = {f.name: f.dataType for f in df.schema.fields}
    return [(ci_key(c) if isinstance(types[c], StringType) else F.col(c)).alias(f"{prefix}{i}")
            for i, c in enumerate(cols)]


def _probe(target: DataFrame, repeated: DataFrame | None, names: Sequence[str], key_col: str) -> int | None:
    """One job before the join: the target's largest key (None: no rows). Raises ``MergeConflict``
    with up to five of the source's repeated merge keys that the target has."""
    top = target.agg(F.max(F.col(key_col)).cast("long").alias("v")).select(
        "v", F.lit(None).cast("string").alias("keys"))
    if repeated is not None:
        bad = repeated.join(target.select(*names), list(names), "left_semi").limit(5).select(
            F.lit(None).cast("long").alias("v"),
            F.concat_ws("|", *[F.col(n).cast("string") for n in names]).alias("keys"))
        top = top.unionByName(bad)
    rows = top.collect()
    conflicts = sorted({r.keys for r in rows if r.keys is not None})
    if conflicts:
        raise MergeConflict(f"target rows matched by several source rows, keys {conflicts}")
    return next((r.v for r in rows if r.v is not None), None)


def merge_keys(df: DataFrame, cols: Sequence[str]) -> tuple[list[Column], Column]:
    """The merge keys ``_k0``, ``_k1``, ... of ``df``'s columns, and whether none of them is NULL."""
    names = [f"_k{i}" for i in range(len(cols))]
    return _key_exprs(df, cols, "_k"), reduce(and_, [F.col(n).isNotNull() for n in names])


def matched(target: DataFrame, source: DataFrame, names: Sequence[str]) -> DataFrame:
    """Target rows with the source row of their key, if there is one. Both sides have keys without
    NULL, and the source has one row for each."""
    return target.join(source, list(names), "left")


def unmatched(source: DataFrame, target: DataFrame, names: Sequence[str]) -> DataFrame:
    """Source rows whose key the target hasn't."""
    return source.join(target.select(*names).distinct(), list(names), "left_anti")


def upsert(target: DataFrame, source: DataFrame, on: Sequence[tuple[str, str]],
           update: Mapping[str, str | Column], insert: Mapping[str, str | Column], key_col: str,
           order: Sequence[str], schema: StructType, seed: int = 1, check: bool = True,
           target_empty: bool = False, spread: Callable[[DataFrame], DataFrame] = lambda df: df
           ) -> DataFrame:
    """New target version.

    on:     (target column, source column) pairs of the match condition
    update: target column → source column / expression, applied on match
    insert: target column → source column / expression for new rows (the key is generated)
    order:  target columns giving the order in which new keys are handed out
    schema: declared target schema (types and column order of the result)
    target_empty: the caller knows the target has no rows (first load): no join, conflict check
                  or key lookup is needed, every source row is inserted
    spread: how new rows are laid out before they join the kept ones (a bucketed target)

    ``source`` is read several times; a caller that computes it at some cost writes it first.
    """
    names = [f"_k{i}" for i in range(len(on))]
    keys, filled = merge_keys(source, [c for _, c in on])
    s = source.select(*[F.col(c).alias(f"_s_{c}") for c in source.columns], *keys)

    def src(expr: str | Column) -> Column:
        return F.col(f"_s_{expr}") if isinstance(expr, str) else expr

    def inserts(rows: DataFrame, start: int) -> DataFrame:
        new = rows.select(*[src(insert[f.name]).cast(f.dataType).alias(f.name)
                            for f in schema.fields if f.name != key_col])
        keyed = assign_keys(new, key_col, [F.col(c).asc_nulls_first() for c in order], start=start)
        return spread(conform(keyed, schema))

    if target_empty:
        return inserts(s, seed)
    keyed = s.where(filled)
    t = target.select("*", *merge_keys(target, [c for c, _ in on])[0])
    t_keyed = t.where(filled)
    # repeated source keys, by an aggregate rather than a window: a hot key combines map-side
    repeated = (keyed.groupBy(*names).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*names)
                if check else None)
    top = _probe(t, repeated, names, key_col)
    hit = matched(t_keyed, keyed.withColumn("_source", F.lit(True)), names)
    kept = hit.select(*[
        (F.when(F.col("_source"), src(update[f.name])).otherwise(F.col(f.name))
         if f.name in update else F.col(f.name)).cast(f.dataType).alias(f.name)
        for f in schema.fields]).unionByName(conform(t.where(~filled), schema))
    # written once: handing out keys reads the new rows twice
    new = materialize(unmatched(keyed, t_keyed, names).select(s.columns).unionByName(s.where(~filled)), "merge-new")
    return kept.unionByName(inserts(new, seed if top is None else top + 1))
