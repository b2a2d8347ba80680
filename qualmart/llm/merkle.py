"""Merkle manifest of a dataset, and proofs by content-addressed descent.

Every row is a leaf; the leaves of a group (a source) in order of their ids form a tree of fan-out
16, and the groups' subroots, in order of the groups' names, form the tree above them.

1. Leaves are digested in one scan and ranked within their group by range partitions and
   per-partition counts, so a group that holds a third of all rows is spread over many tasks.
2. The store holds one record per inner node: its digest and its children's digests, end to end.
   Each level is built from the one below by grouping ranks // 16 (at most 16 rows a group).
3. A request names a leaf by (group, rank). Requests descend from the root, level by level: the
   frontier's digest is looked up in the store, the rank's next base-16 digit selects the child, and
   the unselected children before and after it are kept as a path segment. Requests that share a
   prefix share a frontier row, so a level has no more rows than the tree has nodes there.
4. The segments, gathered from root to leaf, are reversed: the proof runs from leaf to root.

Everything is made of DataFrame functions; digests travel as 32 bytes and are hexadecimal only
inside the hash and in results.

Defined cases: a null column is encoded as ``-``; a null text is a leaf like any other. Null ids come
first within their group and null groups before all others. Rows of equal id are ordered by digest, so
repeated rows (equal digests) are interchangeable. A group of one leaf has that leaf as subroot; one
group alone has its subroot as root. An empty table gives no rows.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qualmart.llm.common import fresh
from qualmart.session import materialize

#: Children of a node; a power of two, so that a digit of a rank is a shift of it.
FANOUT = 16
_BITS = FANOUT.bit_length() - 1
#: Bytes of a digest.
SIZE = 32
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def encoded(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    """Digest of one row's values, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[encoded(v) for v in values]), 256))


def node_digest(children: Column) -> Column:
    """Digest of a node from its children's digests, end to end."""
    return F.unhex(F.sha2(to_hex(children), 256))


def to_hex(digests: Column) -> Column:
    return F.lower(F.hex(digests))


@dataclass
class Manifest:
    """leaves:  (group, rank, digest, payload) for each row; ``payload`` is what the caller kept
    groups:  (group, n, height, has, name, digest): number of leaves, levels above them, subroot
    levels:  for each level from 1 on, (group, idx, digest, children) of the groups' trees
    top:     the same for the tree over the groups (group is 0)
    top_height: number of levels in ``top``
    """
    leaves: DataFrame
    groups: DataFrame
    levels: list[DataFrame]
    top: list[DataFrame]
    top_height: int

    def store(self) -> DataFrame:
        """(digest, children): every inner node's record, each once."""
        out = None
        for level in (*self.levels, *self.top):
            out = _records(level) if out is None else out.union(_records(level))
        return out.dropDuplicates(["digest"])


def _records(level: DataFrame) -> DataFrame:
    return level.select("digest", "children").dropDuplicates(["digest"])


def _ranked(df: DataFrame, group: Sequence[str], order: Sequence[Column], rank: str, name: str
            ) -> DataFrame:
    """``df`` with each row's position from 0 within its ``group``, and ``n``, the group's rows.

    Range partitions over (group, order) are written once with their number and each row's place;
    a row's rank is its place within its slice plus the rows of the group's earlier slices. There is
    one slice per group and partition that meet, at most partitions + groups."""
    keys = [*group, "_part"]
    at = materialize(df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
                       .withColumn("_part", F.spark_partition_id())
                       .withColumn("_place", F.monotonically_increasing_id()), name)
    slices = at.groupBy(*keys).agg(F.min("_place").alias("_first"), F.count("*").alias("_rows"))
    whole = Window.partitionBy(*group)
    before = F.sum("_rows").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    slices = slices.select(*keys, "_first", F.coalesce(before, F.lit(0)).alias("_before"),
                           F.sum("_rows").over(whole).alias("n"))
    place = F.col("_before") + F.col("_place") - F.col("_first")
    return at.join(slices, keys).withColumn(rank, place).drop("_part", "_place", "_first", "_before")


def height(n: Column) -> Column:
    """Levels above ``n`` leaves: the least h with 16 ** h >= n."""
    return sum(((n > FANOUT ** k).cast("int") for k in range(1, 16)), (n > 1).cast("int"))


def _levels(nodes: DataFrame, top: int, name: str) -> list[DataFrame]:
    """(group, idx, digest, children, height) of each level above ``nodes`` (group, idx, digest,
    height); a group leaves off when it has one node."""
    out = []
    for level in range(1, top + 1):
        runs = nodes.where(F.col("height") >= level).groupBy(
            "group", F.shiftright("idx", _BITS).alias("idx"), "height").agg(
            F.sort_array(F.collect_list(F.struct("idx", "digest"))).alias("run"))
        joined = F.array_join(F.transform("run", lambda c: F.hex(c.digest)), "")
        nodes = materialize(runs.withColumn("children", F.unhex(joined)).select(
            "group", "idx", node_digest(F.col("children")).alias("digest"), "children", "height"), name)
        out.append(nodes)
    return out


def manifest(rows: DataFrame, *, group: Column, order: Column, digest: Column,
             payload: Column) -> Manifest:
    """The manifest of ``rows``: ``group`` and ``order`` place a leaf, ``digest`` is its 32 bytes and
    ``payload`` a struct that stays with it."""
    leaf = rows.select(group.isNotNull().alias("has"), F.coalesce(group.cast("string"), F.lit("")).alias("name"),
                       order.alias("order"), digest.alias("digest"), payload.alias("payload"))
    leaf = materialize(leaf, "merkle-digests")  # the rows are read once; ranking reads digests
    leaves = _ranked(leaf, ["has", "name"], [F.col("order").asc_nulls_first(), F.col("digest")], "rank",
                     "merkle-leaves")
    groups = leaves.groupBy("has", "name").agg(F.max("n").alias("n"))
    groups = materialize(_ranked(groups.withColumnRenamed("n", "leaves"), [], [F.col("has"), F.col("name")],
                                 "group", "merkle-groups").select(
        "has", "name", "group", F.col("leaves").alias("n"), height(F.col("leaves")).alias("height"),
        F.col("n").alias("groups")), "merkle-groups")
    sizes = groups.agg(F.max("height"), F.max("groups"), F.max(height(F.col("groups")))).first()
    leaves = materialize(leaves.drop("n").join(groups.drop("n", "groups"), ["has", "name"]).select(
        "group", "rank", "digest", "payload", "height"), "merkle-ranked")

    levels = _levels(leaves.select("group", F.col("rank").alias("idx"), "digest", "height"),
                     sizes[0] or 0, "merkle-level")
    ends = leaves.where("height = 0").select("group", "digest")
    for i, level in enumerate(levels, 1):
        ends = ends.union(level.where(F.col("height") == i).select("group", "digest"))
    groups = materialize(groups.drop("groups").join(ends, "group"), "merkle-subroots")
    over = groups.select(F.lit(0).cast("long").alias("group"), F.col("group").alias("idx"), "digest",
                         F.lit(sizes[2] or 0).alias("height"))
    return Manifest(leaves, groups, levels, _levels(over, sizes[2] or 0, "merkle-top"), sizes[2] or 0)


def _segment(children: Column, digit: Column) -> Column:
    """The digests beside the selected one."""
    at = (digit * SIZE).cast("int")
    return F.struct(F.substring(children, F.lit(1), at).alias("before"),
                    F.substring(children, at + SIZE + 1, F.octet_length(children)).alias("after"))


def _step(frontier: DataFrame, level: DataFrame) -> DataFrame:
    """The frontier one level down: each record's children, with the path that leads to them."""
    found = frontier.join(_records(level), "digest").withColumn("digit", F.explode(F.sequence(
        F.lit(0), (F.octet_length("children") / SIZE).cast("int") - 1)))
    digit = F.col("digit")
    rest = [c for c in frontier.columns if c not in ("digest", "idx", "path")]
    return found.select(*rest, (F.col("idx") * FANOUT + digit).alias("idx"),
                        F.substring("children", (digit * SIZE + 1).cast("int"), F.lit(SIZE)).alias("digest"),
                        F.concat("path", F.array(_segment(F.col("children"), digit))).alias("path"))


def _asked(frontier: DataFrame, wanted: DataFrame, level: int) -> DataFrame:
    """Frontier rows that lead to a wanted leaf."""
    here = wanted.select("group", F.shiftright("rank", _BITS * level).alias("idx")).distinct()
    return frontier.join(here, ["group", "idx"], "left_semi")


def proofs(m: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """(group, rank, digest, payload, subroot, root, path) for each requested leaf.

    ``requests`` has (group, rank) of the leaves to prove, each once; None asks for all. ``path`` is
    an array from leaf to root of (before, after): the digests beside the leaf's own branch."""
    leaves = m.leaves if requests is None else m.leaves.join(
        requests.select("group", "rank"), ["group", "rank"], "left_semi")
    empty = F.array().cast("array<struct<before:binary,after:binary>>")

    # the tree over the groups: its leaves are the subroots, in group order
    first = m.top[-1] if m.top else m.groups.withColumn("idx", F.lit(0).cast("long"))
    frontier = first.select(F.col("idx").cast("long").alias("idx"), "digest", F.col("digest").alias("root"),
                            empty.alias("path"))
    for level in reversed(m.top):
        frontier = _step(frontier, level)
    starts = frontier.select(F.col("idx").alias("group"), F.col("digest").alias("subroot"), "root", "path").join(
        m.groups.select("group", "height"), "group")

    # the groups' trees: a group joins the frontier at its own height
    def start(level: int) -> DataFrame:
        return starts.where(F.col("height") == level).select(
            "group", F.lit(0).cast("long").alias("idx"), F.col("subroot").alias("digest"), "subroot", "root", "path")

    frontier = start(len(m.levels))
    for level in range(len(m.levels), 1, -1):
        if requests is not None:
            frontier = _asked(frontier, leaves, level)
        frontier = _step(frontier, m.levels[level - 1]).unionByName(start(level - 1))

    # last step: requests of one run of at most 16 leaves meet their record as one row
    leaf = F.struct("rank", "digest", "payload")
    single = leaves.where("height = 0").join(starts.drop("height"), "group").select(
        "group", "rank", "digest", "payload", "subroot", "root", F.reverse("path").alias("path"))
    if not m.levels:
        return single
    runs = leaves.where("height > 0").groupBy("group", F.shiftright("rank", _BITS).alias("idx")).agg(
        F.collect_list(leaf).alias("leaves"))
    met = frontier.join(_records(m.levels[0]), "digest").drop("digest").join(runs, ["group", "idx"])
    digit = F.col("leaf.rank") % FANOUT
    found = met.withColumn("leaf", F.explode("leaves")).select(
        "group", "leaf.rank", "leaf.digest", "leaf.payload", "subroot", "root",
        F.reverse(F.concat("path", F.array(_segment(F.col("children"), digit)))).alias("path"))
    return found.unionByName(single)


def proof_digest(path: Column) -> Column:
    """Digest, in hexadecimal, of all siblings on a path from leaf to root."""
    return F.sha2(F.array_join(F.transform(path, lambda s: to_hex(F.concat(s.before, s.after))), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf's digest and the siblings on its path lead to."""
    return F.aggregate(path, leaf, lambda acc, s: node_digest(F.concat(s.before, acc, s.after)))


def verified(docs: DataFrame, changed: Column, *, id_col: str = "doc_id", group_col: str = "source",
             columns: Sequence[str] = COLUMNS, tampered: dict[str, Column] | None = None) -> DataFrame:
    """Proof and check of every row of ``docs``: rows where ``changed`` holds are checked with the
    values in ``tampered`` (column to expression) in place of their own, against the original proof.
    """
    other = tampered or {}
    old = leaf_digest(*[F.col(c) for c in columns])
    new = leaf_digest(*[other.get(c, F.col(c)) for c in columns])
    key = fresh(docs.columns, "changed")
    rows = docs.withColumn(key, F.coalesce(changed, F.lit(False)))
    m = manifest(rows, group=F.col(group_col), order=F.col(id_col), digest=old,
                 payload=F.struct(F.col(id_col).alias("id"), F.when(F.col(key), new).alias("now")))
    root = folded(F.coalesce("payload.now", "digest"), F.col("path"))
    out = proofs(m).select(F.col("payload.id").alias(id_col), to_hex(F.col("digest")).alias("leaf"),
                           to_hex(F.col("subroot")).alias("subroot"), to_hex(F.col("root")).alias("root"),
                           proof_digest(F.col("path")).alias("proof_sha256"), to_hex(root).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def lowered(text: Column) -> Column:
    """A-Z to lower case; other characters stay."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


#: Levels of each tree in the SQL form: enough for 16 ** 8 rows of a group, and as many groups.
_SQL_LEVELS = 8


def _sql_tree(name: str, leaves: str) -> str:
    """CTEs <name>0, <name>1, ...: (g, i, h, c) by level; c is empty where a group has one node."""
    out = f"{name}0 AS ({leaves})"
    for k in range(1, _SQL_LEVELS + 1):
        out += f""",
{name}{k} AS (SELECT g, i // {FANOUT} AS i, CASE WHEN n = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h,
       CASE WHEN n = 1 THEN '' ELSE string_agg(h, '' ORDER BY i) END AS c
  FROM (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM {name}{k - 1}) GROUP BY g, i // {FANOUT}, n)"""
    return out


def _sql_path(name: str, tree: str, start: str) -> str:
    """CTEs that climb a tree: (id, leaf, src, g, i, f, proof) with the folded digest and the siblings."""
    out = f"{name}0 AS ({start})"
    for k in range(1, _SQL_LEVELS + 1):
        out += f""",
{name}{k} AS (SELECT id, leaf, src, p.g, p.i // {FANOUT} AS i, proof || a || b AS proof, CASE WHEN c = '' THEN f ELSE sha256(a || f || b) END AS f
  FROM (SELECT p.*, c, left(c, 64 * (p.i % {FANOUT})) AS a, substr(c, 64 * (p.i % {FANOUT}) + 65) AS b FROM {name}{k - 1} p
        JOIN {tree}{k} t ON p.g = t.g AND p.i // {FANOUT} = t.i) p)"""
    return out


#: crc32 of an ASCII text by bytes, in a CTE ``crc`` with the list of the 256 table entries.
SQL_CRC_TABLE = """crc AS (SELECT list_transform(range(256), lambda b: list_reduce(list_concat([b], range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS tab)"""


def sql_crc32(byte_list: str) -> str:
    """SQL for the unsigned crc32 of a list of bytes; the query must have ``crc`` in scope."""
    return (f"xor(list_reduce(list_concat([4294967295::BIGINT], {byte_list}), "
            "lambda c, b: xor(c // 256, tab[xor(c, b) % 256 + 1])), 4294967295)")


def _sql_encoded(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR) || ':' || {column}::VARCHAR, '-')"


def _sql() -> str:
    values = [_sql_encoded(c) for c in COLUMNS]
    bad = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    digits = "list_transform(string_split(doc_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)"
    return f"""WITH {SQL_CRC_TABLE},
d AS (SELECT doc_id AS id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g,
       row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS i,
       sha256({' || '.join(values)}) AS leaf,
       CASE WHEN {sql_crc32(digits)} % 5 = 0 THEN sha256({' || '.join([*values[:-1], _sql_encoded(bad)])}) END AS now
  FROM documents, crc),
{_sql_tree('s', 'SELECT g, i, leaf AS h FROM d')},
{_sql_tree('t', f'SELECT 0 AS g, g AS i, h FROM s{_SQL_LEVELS}')},
{_sql_path('p', 's', "SELECT id, leaf, g AS src, g, i, coalesce(now, leaf) AS f, '' AS proof FROM d")},
{_sql_path('q', 't', f'SELECT id, leaf, src, 0 AS g, src AS i, f, proof FROM p{_SQL_LEVELS}')}
SELECT id AS doc_id, leaf, s.h AS subroot, t.h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = t.h AS verified
FROM q{_SQL_LEVELS} q JOIN s{_SQL_LEVELS} s ON s.g = q.src, t{_SQL_LEVELS} t"""


SQL = _sql()
