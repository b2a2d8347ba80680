"""SimHash near-duplicates with bit-sliced comparison.

1. Fingerprints: one pass over the texts, inside Arrow batches.
2. Distinct fingerprints (exact copies collapse before anything is compared) are filed under each
   pair of four 16-bit quarters: two fingerprints within distance 2 agree in at least two quarters.
   A bucket with more than ``bucket`` members is filed anew under thirds of its free bits (within
   distance 2 one of three pieces agrees); after three such steps a bucket has at most 10 free bits,
   so at most 1,024 distinct members. No bucket is cut or sampled.
3. In a bucket the bit planes are stored vertically: one machine word holds a bit of 64 members. A
   carry-save counter adds the differing planes for all members at once, and a block of members is
   left as soon as all of them exceed the radius. Each bucket yields a spanning forest of its links
   (at most members - 1 edges), never all pairs.
4. Components by alternating large-star and small-star rounds, each written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qualmart.llm.common import LOWER_AZ, join_counted, utf8
from qualmart.session import materialize

SHINGLE = 3
RADIUS = 2
BUCKET = 1024
_ROWS = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of one text: a bit is 1 if set in over half of the shingles' XXH64 (seed 42)."""
    words = text.translate(LOWER_AZ).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    first = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > shingle:
        first, ends = first[: 1 - shingle or None], ends[shingle - 1:]
    else:
        first, ends = first[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    set_in = np.zeros(64, np.int64)
    for at in range(0, len(first), _ROWS):
        h = np.array([digest(joined[a:b], 42) for a, b in
                      zip(first[at:at + _ROWS].tolist(), ends[at:at + _ROWS].tolist(), strict=True)],
                     "<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_in += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_in * 2 > len(first), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) with the fingerprint as a signed long. Null and empty texts get 0."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = pa.array([fingerprint(t, shingle) for t in utf8(batch, text_col)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), fps], ["doc_id", "fp"])

    return docs.select(id_col, text_col).mapInArrow(run, f"doc_id {kind}, fp long")


def with_fingerprint(docs: DataFrame, name: str, *, text_col: str = "text") -> DataFrame:
    """``docs`` with the fingerprint of each row's text in the column ``name``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = pa.array([fingerprint(t) for t in utf8(batch, text_col)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, fps], [*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))


def beyond(planes: Iterator[np.ndarray], radius: int, dead: np.ndarray) -> np.ndarray:
    """Lanes with more than ``radius`` set bits over the planes. Carry-save: bit i of every lane's
    count is kept in one array of machine words, so one addition serves 64 lanes a word. Stops once
    all lanes are beyond the radius."""
    count = [np.zeros_like(dead) for _ in range(max(1, radius.bit_length()))]
    for k, carry in enumerate(planes):
        for i in range(len(count)):
            count[i], carry = count[i] ^ carry, count[i] & carry
        over, equal = carry, ~np.zeros_like(dead)
        for i in reversed(range(len(count))):
            if radius >> i & 1:
                equal = equal & count[i]
            else:
                over, equal = over | (equal & count[i]), equal & ~count[i]
        dead = dead | over
        if k % 4 == 3 and (dead == ~np.uint64(0)).all():
            break
    return dead


def _vertical(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64, words) bit planes of the fingerprints, and a mask of the lanes that hold none."""
    m = len(fps)
    bits = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(m, 8), axis=1, bitorder="little")
    pad = np.zeros((65, -(-m // 64) * 64), np.uint8)
    pad[:64, :m] = bits.T
    pad[64, m:] = 1
    words = np.packbits(pad, axis=1, bitorder="little").view("<u8")
    return words[:64], words[64]


def _lanes(words: np.ndarray, m: int) -> np.ndarray:
    return np.unpackbits(words.view(np.uint8), axis=-1, bitorder="little")[..., :m].astype(bool)


def pairs_within(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    """For each i whether a[i] and b[i] differ in at most ``radius`` bits; lanes are pairs."""
    planes, void = _vertical(a ^ b)
    return ~_lanes(beyond(iter(planes), radius, void), len(a))


def linked_within(fps: np.ndarray, radius: int) -> np.ndarray:
    """The smallest index that each fingerprint reaches over links within ``radius``."""
    m = len(fps)
    planes, void = _vertical(fps)
    own = [_lanes(p, m) for p in planes]
    differ = [i for i, o in enumerate(own) if o.any() and not o.all()]  # the others add nothing
    linked = np.zeros((m, m), bool)
    for at in range(0, m, 256):
        rows = slice(at, min(m, at + 256))
        flip = [np.where(own[i][rows], ~np.uint64(0), np.uint64(0))[:, None] for i in differ]
        steps = (planes[i] ^ f for i, f in zip(differ, flip, strict=True))
        dead = beyond(steps, radius, np.repeat(void[None], rows.stop - at, axis=0))
        linked[rows] = ~_lanes(dead, m)
    label = np.arange(m)
    while True:
        least = np.array([label[row].min() for row in linked])
        least = least[least]
        if (least == label).all():
            return label
        label = least


def slots(radius: int) -> list[list[int]]:
    """For each level the bit masks of its slots: the bits on which a bucket's members agree.

    Level 0: each two of radius + 2 blocks (at least two agree). Child c of a slot, numbered
    slot x (radius + 1) + c, adds the c-th of radius + 1 pieces of the free bits.
    """
    blocks = np.array_split(np.arange(64), radius + 2)
    free = []
    for i in range(len(blocks)):
        for j in range(i + 1, len(blocks)):
            free.append([b for k, x in enumerate(blocks) for b in x.tolist() if k not in (i, j)])
    out = []
    while True:
        out.append([~sum(1 << b for b in f) & (1 << 64) - 1 for f in free])
        if len(free[0]) <= 10 + radius:
            return out
        free = [[b for k, x in enumerate(np.array_split(f, radius + 1)) if k != c for b in x.tolist()]
                for f in free for c in range(radius + 1)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


#: Groups up to this size are compared as pairs in shared lanes, many groups at once.
_SMALL = 8


def _compare(radius: int):
    """Links of buckets that arrive sorted by (slot, key); a bucket may span batches."""
    def edges(slot: np.ndarray, key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        cut = np.flatnonzero((np.diff(slot) != 0) | (np.diff(key) != 0)) + 1
        starts, ends = np.concatenate(([0], cut)), np.concatenate((cut, [len(fp)]))
        size = ends - starts
        a, b = [], []
        left, right = [], []
        for m in range(2, _SMALL + 1):
            at = starts[size == m]
            for i in range(m):
                for j in range(i + 1, m):
                    left.append(at + i)
                    right.append(at + j)
        if left and sum(map(len, left)):
            x, y = fp[np.concatenate(left)], fp[np.concatenate(right)]
            near = pairs_within(x.view(np.uint64), y.view(np.uint64), radius)
            a.append(x[near])
            b.append(y[near])
        for s, e in zip(starts[size > _SMALL], ends[size > _SMALL], strict=True):
            label = linked_within(fp[s:e].view(np.uint64), radius)
            joined = label != np.arange(e - s)
            a.append(fp[s:e][joined])
            b.append(fp[s:e][label[joined]])
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a), pa.int64()),
                                              pa.array(np.concatenate(b), pa.int64())], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.empty(0, np.int64)] * 3
        for batch in batches:
            cols = [np.concatenate((r, c.to_numpy(zero_copy_only=False).astype(np.int64)))
                    for r, c in zip(rest, batch.columns, strict=True)]
            if not len(cols[0]):
                continue
            last = (cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1])
            rest = [c[last] for c in cols]
            if not last.all():
                yield from edges(*[c[~last] for c in cols])
        if len(rest[0]):
            yield from edges(*rest)

    return run


#: A list of hot buckets of up to this many rows (16 bytes each) is broadcast.
_BROADCAST_ROWS = 100_000


def links(distinct: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """(a, b): for each bucket a spanning forest of the pairs of ``fp`` within the radius."""
    masks = slots(radius)
    children = radius + 1

    def filed(df: DataFrame, level: int) -> DataFrame:
        mask = F.element_at(F.array(*[F.lit(_signed(m)) for m in masks[level]]), F.col("slot") + 1)
        return df.select("slot", F.col("fp").bitwiseAND(mask).alias("key"), "fp")

    at = filed(distinct.select("fp", F.explode(F.sequence(F.lit(0), F.lit(len(masks[0]) - 1)))
                               .alias("slot")), 0)
    out = None
    for level in range(len(masks)):
        hot, n_hot = None, 0
        if level + 1 < len(masks):
            hot = materialize(at.groupBy("slot", "key").count().where(F.col("count") > bucket)
                                .select("slot", "key"), "simhash-hot")
            n_hot = hot.count()
            if 0 < n_hot <= _BROADCAST_ROWS:
                hot = F.broadcast(hot)
        here = at.join(hot, ["slot", "key"], "left_anti") if n_hot else at
        found = (here.select("slot", "key", "fp").repartition("slot", "key")
                     .sortWithinPartitions("slot", "key").mapInArrow(_compare(radius), "a long, b long"))
        out = found if out is None else out.union(found)
        if not n_hot:
            return out
        at = filed(at.join(hot, ["slot", "key"], "left_semi")
                     .select("fp", F.explode(F.transform(
                         F.sequence(F.lit(0), F.lit(children - 1)),
                         lambda c: F.col("slot") * children + c)).alias("slot")), level + 1)
    return out


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the undirected edges (a, b) of longs; root is the smallest
    node reachable. Alternating large-star and small-star; each round is written and read back."""
    pairs = lambda df: df.where("a <> b").distinct()
    e = materialize(pairs(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))),
                    "components")
    before = None
    while True:
        state = e.agg(F.count("*"), F.sum(F.hash("a", "b"))).first()
        if state == before or not state[0]:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                e.select("b", "b").distinct())
        before = state
        both = e.union(e.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = pairs(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        e = materialize(pairs(small.select(F.col("b").alias("a"), F.col("m").alias("b"))
                              .union(least.select("a", "m"))), "components")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, fp, component_id) for every row: ``component_id`` is the smallest id reachable over
    links of at most ``radius`` differing bits.

    Null, empty and wordless texts have fingerprint 0 and link like any other. Equal texts share a
    fingerprint and so a component; repeated rows give repeated rows. Null ids take part in links
    but never name a component unless no member has an id (then it is null). An empty table gives
    an empty result.
    """
    return members(docs, id_col=id_col, text_col=text_col, shingle=shingle, radius=radius,
                   bucket=bucket).drop("root")


def members(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
            radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, fp, component_id, root) for every row; ``root``, a fingerprint, is the component's own
    whatever ids its rows have."""
    fps = materialize(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle), "simhash-fp")
    distinct = materialize(fps.groupBy("fp").agg(
        F.min("doc_id").alias("first_id"), F.count("*").alias("copies")), "simhash-distinct")
    member = components(links(distinct, radius, bucket))
    named = distinct.join(member, F.col("fp") == F.col("node"))
    ids = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    linked = named.join(ids, "root").select("fp", "component_id", "root")
    by_fp = distinct.join(linked, "fp", "left").select("fp", "copies", F.when(
        F.col("root").isNotNull(), F.col("component_id")).otherwise(F.col("first_id")).alias("component_id"),
        F.coalesce("root", "fp").alias("root"))
    by_fp = materialize(by_fp, "simhash-components")
    return join_counted(fps, by_fp, "fp", "copies").select("doc_id", "fp", "component_id", "root")
