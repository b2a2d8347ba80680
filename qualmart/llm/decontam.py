"""Benchmark decontamination with an FM-index per training shard.

The benchmark is a query set; it reaches the tasks in blocks of bounded size. One block is broadcast.
Several are made into phrase tables by tasks, one each, and written to the shared folder; whatever their
number, a task holds one at a time and the driver none. A task collects documents into shards of at most
``SHARD_WORDS`` words. For each block it numbers the shard's words by the block's vocabulary (any other
word ends a run; runs shorter than the shortest phrase can hold none and are left out), indexes the shard,
searches all phrases backwards at once, locates the occurrences and merges them into spans of each
document.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qualmart.llm.common import ALNUM_WORDS, fresh, utf8
from qualmart.llm.fmindex import FMIndex
from qualmart.session import materialize

#: Consecutive words of a window; a shorter item is one window.
WINDOW = 10
#: Words of a shard.
SHARD_WORDS = 1 << 20
#: Bytes of benchmark text in a block, about.
BLOCK_BYTES = 16 << 20

_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(ALNUM_WORDS).split()


class Phrases:
    """The distinct windows of a block of items, and the items that each occurs in."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        vocab: dict[bytes, int] = {}
        found: dict[tuple, dict[str, None]] = {}
        for name, text in items:
            ids = [vocab.setdefault(w, len(vocab) + 1) for w in words_of(text)]
            for at in range(max(1, len(ids) - window + 1) if ids else 0):
                found.setdefault(tuple(ids[at:at + window]), {})[name] = None
        self.vocab = vocab
        names = sorted({n for v in found.values() for n in v})
        number = {n: i for i, n in enumerate(names)}
        self.names = names
        self.groups = []  # (length, phrases, first item of each, items)
        for length in sorted({*map(len, found)}):
            part = [k for k in found if len(k) == length]
            owners = [[number[n] for n in found[k]] for k in part]
            self.groups.append((length, np.array(part, np.int64),
                                np.cumsum([0, *map(len, owners)]),
                                np.array([o for x in owners for o in x], np.int64)))
        self.shortest = min((g[0] for g in self.groups), default=0)


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers start[i] .. start[i] + count[i] - 1 of all i in a row."""
    shift = np.repeat(start - np.concatenate(([0], np.cumsum(count)[:-1])), count)
    return np.arange(count.sum()) + shift


def search_shard(docs: list[np.ndarray], phrases: Phrases) -> tuple[list[list[tuple[int, int]]], list[list[int]]]:
    """For each document (word numbers, 0: not in the vocabulary) its merged spans [start, end) of
    hit words and the numbers of the items with an occurring window."""
    size = np.array([len(d) for d in docs], np.int64)
    begin = np.concatenate(([0], np.cumsum(size + 1)))
    flat = np.zeros(begin[-1], np.int64)
    for d, at in zip(docs, begin[:-1], strict=True):
        flat[at:at + len(d)] = d
    edge = np.flatnonzero(np.diff(np.concatenate(([0], (flat > 0).view(np.int8), [0]))))
    start, stop = edge[::2], edge[1::2]
    kept = stop - start >= phrases.shortest
    start, stop = start[kept], stop[kept]
    spans: list[list[tuple[int, int]]] = [[] for _ in docs]
    items: list[list[int]] = [[] for _ in docs]
    if not len(start):
        return spans, items
    at = _ranges(start, stop - start + 1)  # each run and the separator or foreign word behind it
    text = flat[at]
    text[np.cumsum(stop - start + 1) - 1] = 0
    index = FMIndex(text, len(phrases.vocab))
    hit = np.zeros(len(flat) + 1, np.int64)
    pairs = []
    for length, patterns, first, owners in phrases.groups:
        low, high = index.search(patterns)
        found = high > low
        n = (high - low)[found]
        if not len(n):
            continue
        place = at[index.locate(_ranges(low[found], n))]
        np.add.at(hit, place, 1)
        np.add.at(hit, place + length, -1)
        doc = np.searchsorted(begin, place, side="right") - 1
        both = np.unique(doc * len(patterns) + np.repeat(np.flatnonzero(found), n))
        doc, pattern = both // len(patterns), both % len(patterns)
        count = np.diff(first)[pattern]
        pairs.append(np.repeat(doc, count) * len(phrases.names) + owners[_ranges(first[pattern], count)])
    inside = np.cumsum(hit[:-1]) > 0
    edge = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
    for s, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        d = int(np.searchsorted(begin, s, side="right") - 1)
        spans[d].append((s - int(begin[d]), e - int(begin[d])))
    for p in np.unique(np.concatenate(pairs)).tolist() if pairs else []:
        items[p // len(phrases.names)].append(p % len(phrases.names))
    return spans, items


def cut_words(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words in the spans; a line break stands for each span."""
    at = [m.span() for m in _WORD.finditer(text)]
    out, done = [], 0
    for s, e in spans:
        out += [text[done:at[s][0]], b"\n"]
        done = at[e - 1][1]
    return b"".join([*out, text[done:]])


def _items(bench: DataFrame, item_col: str, text_col: str) -> DataFrame:
    return bench.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"),
                        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))


def n_blocks(bench: DataFrame, item_col: str, text_col: str, block_bytes: int) -> int:
    size = F.octet_length("text") + 16
    total = _items(bench, item_col, text_col).agg(F.sum(size)).first()[0] or 0
    return max(1, -(-total // block_bytes))


class _Broadcast:
    """The phrase table of the only block."""

    def __init__(self, bench: DataFrame, item_col: str, text_col: str, window: int):
        rows = _items(bench, item_col, text_col).collect()
        table = Phrases([(r.item, bytes(r.text)) for r in rows], window)
        self._table = bench.sparkSession.sparkContext.broadcast(table)

    def __iter__(self) -> Iterator[Phrases]:
        yield self._table.value


class _Files:
    """The phrase tables of several blocks, chosen by hash, in files that every task can read."""

    def __init__(self, bench: DataFrame, item_col: str, text_col: str, window: int, n: int):
        part = F.pmod(F.xxhash64("item", "text"), F.lit(n)).cast("int").alias("part")

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = [r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True)]
            if items:
                table = pickle.dumps(Phrases(items, window), pickle.HIGHEST_PROTOCOL)
                yield pa.RecordBatch.from_arrays([pa.array([table], pa.binary())], ["table"])

        tables = (_items(bench, item_col, text_col).select(part, "item", "text").repartitionById(n, F.col("part"))
                  .mapInArrow(pack, "table binary"))
        written = materialize(tables, "decontam-blocks")
        self._paths = sorted(r[0] for r in written.select(F.input_file_name()).distinct().collect())

    def __iter__(self) -> Iterator[Phrases]:
        for path in self._paths:
            source, inside = pafs.FileSystem.from_uri(path)
            for value in pq.read_table(inside, filesystem=source, columns=["table"])["table"]:
                yield pickle.loads(value.as_buffer())


def _blocks(bench: DataFrame, item_col: str, text_col: str, window: int, block_bytes: int) -> _Broadcast | _Files:
    n = n_blocks(bench, item_col, text_col, block_bytes)
    return _Broadcast(bench, item_col, text_col, window) if n == 1 else _Files(bench, item_col, text_col, window, n)


def _pass(docs: DataFrame, tables: _Broadcast | _Files, *, carry: list[str], text_col: str,
          found: str, cut: bool, shard_words: int) -> DataFrame:
    """Search all blocks: ``carry`` columns, and in the struct ``found`` n_words, spans and items.
    With ``cut`` (one block) the hit words leave the text, until no window occurs."""
    cols = list(dict.fromkeys([*carry, text_col]))
    schema = T.StructType([*(docs.schema[c] for c in carry), T.StructField(found, T.StructType([
        T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("items", T.ArrayType(T.StringType()))]))])
    kind = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64()))),
                      ("items", pa.list_(pa.string()))])

    def ids(words: list[bytes], p: Phrases) -> np.ndarray:
        number = p.vocab.get
        return np.fromiter((number(x, 0) for x in words), np.int64, len(words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.RecordBatch, list[bytes], list[list[bytes]]]] = []

        def again_until_clean(texts: list[bytes], spans: list, p: Phrases) -> dict[int, bytes]:
            """The new texts of the documents with spans."""
            out, again = {}, {i: s for i, s in enumerate(spans) if s}
            while again:
                for i, s in again.items():
                    out[i] = cut_words(out.get(i, texts[i]), s)
                where = list(again)
                more, _ = search_shard([ids(words_of(out[i]), p) for i in where], p)
                again = {where[k]: s for k, s in enumerate(more) if s}
            return out

        def finish() -> Iterator[pa.RecordBatch]:
            shard = [w for h in held for w in h[2]]
            spans: list[list] = [[] for _ in shard]
            items: list[list[str]] = [[] for _ in shard]
            texts: dict[int, bytes] = {}
            for p in tables:
                for i, (s, o) in enumerate(zip(*search_shard([ids(w, p) for w in shard], p), strict=True)):
                    spans[i] += s
                    items[i] += [p.names[k] for k in o]
                if cut:
                    texts = again_until_clean([t for h in held for t in h[1]], spans, p)
            rows = [{"n_words": len(w), "spans": _merged(s), "items": o}
                    for w, s, o in zip(shard, spans, items, strict=True)]
            i = 0
            for batch, _, own in held:
                n = len(own)
                arrays = [batch.column(cols.index(c)) for c in carry]
                if text_col in carry and any(i <= k < i + n for k in texts):
                    at = carry.index(text_col)
                    new = arrays[at].to_pylist()
                    for k, t in texts.items():
                        if i <= k < i + n:
                            new[k - i] = t.decode()
                    arrays[at] = pa.array(new, arrays[at].type)
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(rows[i:i + n], kind)], [*carry, found])
                i += n
            held.clear()

        words = 0
        for whole in batches:
            for at in range(0, whole.num_rows, 256):  # so that a shard ends near its size
                batch = whole.slice(at, 256)
                texts = utf8(batch, text_col)
                own = [words_of(t) for t in texts]
                held.append((batch, texts if cut else [], own))
                words += sum(map(len, own))
                if words >= shard_words:
                    yield from finish()
                    words = 0
        if held:
            yield from finish()

    return docs.select([F.col(f"`{c}`") for c in cols]).mapInArrow(run, schema)


def _cut(docs: DataFrame, columns: list[str], text_col: str, found: str) -> DataFrame:
    """``docs`` without the words of the spans in ``found``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            spans = [f["spans"] for f in batch.column(batch.schema.get_field_index(found)).to_pylist()]
            new = [cut_words(t, s).decode() for t, s in zip(utf8(batch, text_col), spans, strict=True)]
            yield batch.set_column(at, batch.schema.field(at), pa.array(new, batch.column(at).type))

    return docs.select([F.col(f"`{c}`") for c in [*columns, found]]).mapInArrow(run, docs.schema)


def _merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for s, e in sorted(map(tuple, spans)):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def contamination(docs: DataFrame, bench: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", bench_text_col: str = "text", window: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated and
    ``spans`` (merged [start, end) word ranges that occurrences cover).

    Null and wordless texts have no words and no hits; so have wordless items. Repeated rows get
    equal results; repeated items count once; an item without an id counts as ``null``. With an
    empty benchmark nothing is hit; an empty table gives an empty result.
    """
    found = fresh(docs.columns, "found")
    out = _pass(docs, _blocks(bench, item_col, bench_text_col, window, block_bytes), carry=[id_col],
                text_col=text_col, found=found, cut=False, shard_words=shard_words)
    hit = F.aggregate(f"{found}.spans", F.lit(0).cast("long"), lambda a, s: a + s[1] - s[0])
    items = F.array_sort(F.array_distinct(f"{found}.items"))
    return out.select(F.col(id_col).alias("doc_id"), f"{found}.n_words", hit.alias("n_hit"),
                      F.size(items).cast("long").alias("n_items"),
                      F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
                      (hit > 0).alias("contaminated"), f"{found}.spans")


def decontaminated(docs: DataFrame, bench: DataFrame, *, text_col: str = "text",
                   length_col: str = "n_chars", item_col: str = "item_id", bench_text_col: str = "text",
                   window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
                   shard_words: int = SHARD_WORDS) -> DataFrame:
    """``docs`` without the words that occurrences of benchmark windows cover; the changed documents
    are searched again until no window of the benchmark occurs. Documents of which no word is left by
    a cut are dropped; ``length_col``, if there is one, follows the new text. Others stay as they are.

    With several blocks all spans are found on the uncut text, and each round over the blocks cuts
    their union, so that the result doesn't depend on the benchmark's size. A round is written and
    read back; the next one has its changed documents only."""
    found = fresh(docs.columns, "found")
    columns = docs.columns

    def searched(rows: DataFrame, cut: bool) -> DataFrame:
        return _pass(rows, tables, carry=columns, text_col=text_col, found=found, cut=cut, shard_words=shard_words)

    def left(rows: DataFrame) -> DataFrame:
        rows = rows.where((F.size(f"{found}.spans") == 0) | F.col(f"`{text_col}`").rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"))
        if length_col in columns:
            rows = rows.withColumn(length_col, F.when(F.size(f"{found}.spans") > 0, F.length(text_col))
                                   .otherwise(F.col(length_col)).cast(docs.schema[length_col].dataType))
        return rows.select([F.col(f"`{c}`") for c in columns])

    tables = _blocks(bench, item_col, bench_text_col, window, block_bytes)
    if isinstance(tables, _Broadcast):
        return left(searched(docs, True))
    out, again = None, docs
    while True:
        rows = materialize(searched(again, False), "decontam-round")
        hit = F.size(f"{found}.spans") > 0
        clean = rows.where(~hit).select([F.col(f"`{c}`") for c in columns])
        out = clean if out is None else out.unionByName(clean)
        changed = rows.where(hit)
        if changed.isEmpty():
            return out
        again = left(_cut(changed, columns, text_col, found))


#: DuckDB SQL of ``contamination`` over ``documents`` and ``benchmark``.
SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT coalesce(item_id::VARCHAR, 'null') AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
g AS (
  SELECT DISTINCT item, least(len(w), 10) AS n,
         array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS p
  FROM b, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS u(i) WHERE len(w) > 0),
l AS (SELECT DISTINCT n FROM g),
x AS (
  SELECT r, i, l.n, array_to_string(w[i:i + l.n - 1], ' ') AS p
  FROM d, l, unnest(range(1, len(w) - l.n + 2)) AS u(i)),
o AS (SELECT r, i, n, item FROM x JOIN g USING (n, p)),
h AS (SELECT r, count(DISTINCT i + k)::BIGINT AS n_hit FROM (SELECT DISTINCT r, i, n FROM o) AS o,
      unnest(range(0, n)) AS u(k) GROUP BY r),
t AS (SELECT r, count(DISTINCT item)::BIGINT AS n_items,
             string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM o GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r)
"""
