"""Threshold-scaled sketches as document fingerprints.

A document's sketch holds every hash of its five-word shingles that lies below a fixed fraction of the
hash range (one in eight). It grows with the document, so a share of common hashes estimates how much
of the smaller document lies in the larger one, however unequal they are; and the sketch of several
texts together is the union of theirs (``merge``). A document without any hash below the fraction is
known by its smallest hash alone, so that only wordless texts have an empty sketch; such a document
is found equal to others, not contained in larger ones.

A word's hash is the first half of its MD5; a shingle's is the sum of its words' hashes times powers
of an odd constant, modulo 2 ** 64. Both are plain arithmetic that SQL can repeat.

``edited`` compares every document with an edited text that borrows from the next document:

1. (id, hash of the text) of all rows is written once. A sample of it gives range bounds; it decides
   only which task gets a row, never a result. Bounds are keys of real rows, and a range ends with
   its bound, so the row before a range is known: it is the one with the last range's bound.
2. Rows are dealt to their ranges, the texts compressed; a row that ends a range is sent to the next
   one too. That is the only shuffle, and no row is joined.
3. A task reads its ranges in order and holds one row besides the current one.

Defined cases: a null text is empty. The order is by descending id, nulls last, rows of equal id by
descending XXH64 of the text; equal rows are interchangeable. A table of one row has itself as next.
Rows of one id are split between tasks by their texts. Rows equal in id and text that would fill a range
end it, and all but one from each task are dealt to all ranges, as each has an equal row as next. An
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import string
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualmart.llm.common import LOWER_AZ, WORD, utf8
from qualmart.session import materialize

#: Words of a shingle.
SHINGLE = 5
#: One hash in so many is kept.
SCALE = 8
#: Odd, so that multiplying by a power of it maps the hash range onto itself.
BASE = 0x9E3779B97F4A7C15

_FACTORS = np.array([pow(BASE, j, 1 << 64) for j in range(SHINGLE)], np.uint64)
_BELOW = (1 << 64) // SCALE
#: A worker remembers this many words' hashes.
_MEMO = 500_000
#: Rows per range bound in the sample of keys.
_SAMPLED = 20


class _WordHashes(dict):
    """Word to hash; unknown words are hashed, and all are forgotten once there are too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MEMO:
            self.clear()
        value = self[word] = int.from_bytes(hashlib.md5(word).digest()[:8], "big")
        return value


def sketch(text: bytes, words: dict | None = None) -> np.ndarray:
    """Sorted hashes of a text. A-Z count as a-z; a text of fewer than five words is one shingle."""
    known = _WordHashes() if words is None else words
    split = text.translate(LOWER_AZ).split()
    if not split:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, split), np.uint64, len(split))
    n = max(1, len(h) - SHINGLE + 1)
    sums = np.zeros(n, np.uint64)
    for j in range(min(SHINGLE, len(h))):
        sums += h[j:j + n] * _FACTORS[j]
    return _scaled(sums)


def _scaled(hashes: np.ndarray) -> np.ndarray:
    kept = np.unique(hashes[hashes < np.uint64(_BELOW)])
    return kept if len(kept) else hashes.min(keepdims=True) if len(hashes) else hashes


def merge(*sketches: np.ndarray) -> np.ndarray:
    """The sketch of several texts' shingles together, from their sketches alone."""
    return _scaled(np.concatenate([np.empty(0, np.uint64), *sketches]))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of the smaller document's shingles that the other one has, 0 to 1. Two empty
    sketches are alike, an empty and another one are not."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    return len(np.intersect1d(a, b, assume_unique=True)) / min(len(a), len(b))


def to_text(hashes: np.ndarray) -> str:
    """16 hexadecimal digits a hash, in ascending order."""
    return hashes.astype(">u8").tobytes().hex()


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, hashes) for every row: the sketch as an array of signed longs. Null texts are empty."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _WordHashes()
        for batch in batches:
            rows = [sketch(t, words).view(np.int64) for t in utf8(batch, text_col)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, pa.list_(pa.int64()))], ["doc_id", "hashes"])

    return docs.select(id_col, text_col).mapInArrow(run, f"doc_id {kind}, hashes array<long>")


def _order(row_id, text_hash: int) -> tuple:
    """Key of the ascending order: null ids first."""
    return (row_id is not None, row_id if row_id is not None else 0, text_hash)


def _bounds(keys: DataFrame, ranges: int) -> list[tuple]:
    """Keys of real rows at which ranges end, ascending; the last one is the largest key."""
    key = F.struct(F.col("id").isNotNull().alias("has"), "id", "h")
    n, top = keys.agg(F.count("*"), F.max(key)).first()
    if not n:
        return []
    sample = keys.sample(min(1.0, _SAMPLED * ranges / n), seed=13).collect()
    sample = sorted(_order(r.id, r.h) for r in sample)
    step = max(1, -(-len(sample) // ranges))
    return sorted({*sample[step - 1::step], _order(top.id, top.h)})


#: What a dealt row is: one of its range, the one that leads the range, or a further row equal to a bound.
_ROW, _LEAD, _TWIN = 0, 1, 2


def _deal(bounds: list[tuple]):
    """Rows to (part, role, id, h, body): the range of each row, and the row that ends a range once
    more, as the one that leads the next range. Of rows equal to a bound a task sends one to its range;
    the further ones follow an equal row, wherever they are compared."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        sent, twins = set(), 0
        for batch in batches:
            take, part, role = [], [], []
            ids, hashes = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for at, key in enumerate(map(_order, ids, hashes)):
                i = bisect_left(bounds, key)
                take.append(at)
                if bounds[i] == key and i in sent:
                    twins += 1
                    part.append((i + twins) % len(bounds))
                    role.append(_TWIN)
                    continue
                part.append(i)
                role.append(_ROW)
                if bounds[i] == key:
                    sent.add(i)
                    take.append(at)
                    part.append((i + 1) % len(bounds))
                    role.append(_LEAD)
            bodies = [pack(t) for t in utf8(batch, "text")]
            index = pa.array(take, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array(role, pa.int32()), batch.column(0).take(index),
                 batch.column(2).take(index), pa.array([bodies[at] for at in take], pa.binary())],
                ["part", "role", "id", "h", "body"])
    return run


_OUT = pa.schema([("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                  ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of whole ranges, each range in ascending order behind the row that leads it; twins come first.
    The next document in descending order is the one just read, a twin's is a row like itself."""
    unpack = zstandard.ZstdDecompressor().decompress
    words = _WordHashes()
    before = None
    for batch in batches:
        ids, rows = [], []
        for at, (role, body) in enumerate(zip(batch.column(1).to_pylist(), batch.column(4).to_pylist(),
                                               strict=True)):
            raw = unpack(body)
            text, own = raw.decode(), sketch(raw, words)
            if role != _LEAD:
                next_text, next_sketch = before if role == _ROW else (text, own)
                cut = len(text) // 3
                edited = (text[:len(text) - cut] + next_text[:cut]).encode()
                other = sketch(edited, words)
                ids.append(at)
                rows.append((len(text), hashlib.sha256(edited).hexdigest(), to_text(own), to_text(other),
                             likeness(own, other), likeness(own, next_sketch)))
            before = text, own
        columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), _OUT)] if rows else [
            pa.array([], f.type) for f in _OUT]
        yield pa.RecordBatch.from_arrays([batch.column(2).take(pa.array(ids, pa.int64())), *columns],
                                         ["doc_id", *_OUT.names])


def edited(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None
           ) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for
    every row. The edited text has its last third (rounded down, in code points) replaced by the
    beginning of the next document in descending order of ids; the last one is followed by the first.

    ``ranges``: number of ranges that the rows are dealt to; the session's shuffle partitions if None.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    keys = materialize(rows.select("id", "h"), "sketch-keys")
    bounds = _bounds(keys, ranges or int(spark.conf.get("spark.sql.shuffle.partitions")))
    if not bounds:
        return spark.createDataFrame([], f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
                                         "edited_fingerprint string, near_edited double, near_next double")
    dealt = rows.mapInArrow(_deal(bounds), f"part int, role int, id {kind}, h long, body binary")
    lined = dealt.repartitionById(len(bounds), F.col("part")).sortWithinPartitions(
        "part", F.col("role").desc(), F.col("id").asc_nulls_first(), "h")
    return lined.mapInArrow(_compare, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
                                      "edited_fingerprint string, near_edited double, near_next double")


def _sql() -> str:
    lower = f"translate({{}}, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

    def hashes(column: str) -> str:
        return (f"list_transform(regexp_extract_all({lower.format(column)}, '{WORD}'), "
                "lambda w: ('0x' || substr(md5(w), 1, 16))::UBIGINT::UHUGEINT)")

    term = " + ".join(f"coalesce(h[i + {j + 1}], 0::UHUGEINT) * {int(f)}::UHUGEINT % {1 << 64}::UHUGEINT"
                      for j, f in enumerate(_FACTORS))

    def sums(column: str) -> str:
        return (f"list_transform(range(greatest(len({column}) - {SHINGLE - 1}, least(len({column}), 1))), "
                f"lambda i: ({term.replace('h[', column + '[')}) % {1 << 64}::UHUGEINT)")

    def kept(column: str) -> str:
        below = f"list_filter({column}, lambda x: x < {_BELOW}::UHUGEINT)"
        return (f"CASE WHEN len({below}) > 0 THEN list_sort(list_distinct({below})) "
                f"WHEN len({column}) > 0 THEN [list_min({column})] ELSE [] END")

    def text_of(column: str) -> str:
        return f"list_aggregate(list_transform({column}, lambda x: lower(lpad(hex(x::UBIGINT), 16, '0'))), 'string_agg', '')"

    def alike(a: str, b: str) -> str:
        return (f"CASE WHEN least(len({a}), len({b})) = 0 THEN (len({a}) = len({b}))::INT::DOUBLE "
                f"ELSE len(list_intersect({a}, {b}))::DOUBLE / least(len({a}), len({b})) END")

    return f"""WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n FROM documents),
e AS (
  SELECT doc_id, t, n, coalesce(lead(t) OVER o, first_value(t) OVER o) AS next_text, row_number() OVER o AS r
  FROM d WINDOW o AS (ORDER BY doc_id DESC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
x AS (SELECT *, left(t, (n - n // 3)::BIGINT) || left(next_text, (n // 3)::BIGINT) AS edited FROM e),
h AS (SELECT *, {hashes('t')} AS ht, {hashes('edited')} AS he FROM x),
s AS (SELECT *, {sums('ht')} AS st, {sums('he')} AS se FROM h),
k AS (SELECT doc_id, n, r, edited, {kept('st')} AS a, {kept('se')} AS b FROM s),
w AS (SELECT *, coalesce(lead(a) OVER o, first_value(a) OVER o) AS c FROM k
  WINDOW o AS (ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT doc_id, n::BIGINT AS n_chars, sha256(edited) AS edited_sha256, coalesce({text_of('a')}, '') AS fingerprint,
       coalesce({text_of('b')}, '') AS edited_fingerprint, {alike('a', 'b')} AS near_edited, {alike('a', 'c')} AS near_next
FROM w"""


SQL = _sql()
