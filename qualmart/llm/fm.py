"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

score = sigmoid(b + w.x + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2]): all pairwise
interactions, in time linear in the non-zero features. Words are lower-cased (A-Z) and hashed; the
structure features are the ratios of the text statistics; the one piece of metadata is the stated
length. Labels, language, source and id are never features.

It is trained in numpy on a bounded sample of labelled rows outside the held-out quarter; scoring
covers every whole text in one pass.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualmart.llm.common import LOWER_AZ, utf8
from qualmart.llm.rules import STATS, text_stats

#: Word buckets.
BUCKETS = 4096
#: Rank of the interactions.
RANK = 8
#: Labelled rows that are used for training, about.
SAMPLE_ROWS = 6_000
EPOCHS = 12
BATCH = 128
#: Scores from here on are predicted 1.
THRESHOLD = 0.7
#: Length of the word part of a text's features (the dense ones are of order 1 each).
WORD_NORM = 0.5

_AT = {s: i for i, s in enumerate(STATS)}
N_DENSE = 14


def dense(stats: np.ndarray, n_chars: np.ndarray) -> np.ndarray:
    """(texts, N_DENSE) structure and metadata features, each within about 0 .. 2."""
    s = {k: stats[:, i].astype(float) for k, i in _AT.items()}
    words, chars, lines = np.maximum(s["n_words"], 1), np.maximum(s["word_chars"], 1), np.maximum(s["n_lines"], 1)
    return np.stack([
        np.log1p(s["n_words"]) / 5, np.minimum(s["word_chars"] / words, 20) / 8,
        np.minimum(s["n_symbols"] / words, 2), s["n_dup_lines"] / lines, s["n_repeat_words"] / words,
        s["n_upper"] / chars, s["n_digits"] / chars, np.minimum(s["n_marks"] / words, 3),
        s["n_distinct"] / words, s["n_doubled"] / words, np.minimum(words / lines, 100) / 50,
        s["n_words"] < 50, s["n_repeat_words"] > 0.5 * words,
        np.log1p(np.maximum(n_chars, 0)) / 8], axis=1).astype(np.float32)


@dataclass
class Rows:
    """Sparse rows: feature numbers and values, and where each row begins."""

    index: np.ndarray
    value: np.ndarray
    start: np.ndarray

    def part(self, rows: np.ndarray) -> Rows:
        size = np.diff(self.start)[rows]
        at = np.repeat(self.start[rows] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
        return Rows(self.index[at], self.value[at], np.concatenate(([0], np.cumsum(size))))


def features(texts: list[bytes], n_chars: np.ndarray) -> Rows:
    """Features of whole texts; numbers from ``BUCKETS`` on are the dense ones."""
    stats = np.array([text_stats(t) for t in texts], np.int64).reshape(-1, len(STATS))
    rest = dense(stats, n_chars)
    bucket: dict[bytes, int] = {}
    index, value, sizes = [], [], []
    own = np.arange(BUCKETS, BUCKETS + N_DENSE)
    for i, text in enumerate(texts):
        times = Counter(text.translate(LOWER_AZ).split())
        at = np.empty(len(times), np.int64)
        for k, word in enumerate(times):
            b = bucket.get(word)
            if b is None:
                b = bucket[word] = zlib.crc32(word) % BUCKETS
            at[k] = b
        x = np.log1p(np.fromiter(times.values(), float, len(times)))
        x *= WORD_NORM / max(np.sqrt((x * x).sum()), 1e-9)
        index += [at, own]
        value += [x, rest[i]]
        sizes.append(len(at) + N_DENSE)
    empty = [np.empty(0)]
    return Rows(np.concatenate(index or empty).astype(np.int64), np.concatenate(value or empty).astype(np.float32),
                np.concatenate(([0], np.cumsum(sizes))).astype(np.int64))


@dataclass
class Machine:
    bias: np.ndarray  # (1,)
    w: np.ndarray
    v: np.ndarray

    def forward(self, x: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logits, and the sums and terms that the gradient needs again."""
        n = len(x.start) - 1
        if not n:
            return np.zeros(0), np.zeros((0, RANK)), np.zeros((0, RANK))
        vx = self.v[x.index] * x.value[:, None]
        sums = np.add.reduceat(vx, x.start[:-1])
        squares = np.add.reduceat(vx * vx, x.start[:-1])
        linear = np.add.reduceat(self.w[x.index] * x.value, x.start[:-1])
        return self.bias[0] + linear + 0.5 * (sums * sums - squares).sum(axis=1), sums, vx

    def score(self, x: Rows) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.forward(x)[0], -30, 30)))


def train(x: Rows, y: np.ndarray, *, epochs: int = EPOCHS, seed: int = 7) -> Machine:
    """Logistic loss, Adam on batches, weight decay on the word features. With no rows or one class
    the machine scores the smoothed share of class 1 for every text."""
    rng = np.random.default_rng(seed)
    size = BUCKETS + N_DENSE
    share = (y.sum() + 1) / (len(y) + 2)
    m = Machine(np.array([np.log(share / (1 - share))]), np.zeros(size), rng.normal(0, 0.05, (size, RANK)))
    if not len(y) or y.min() == y.max():
        m.v[:] = 0
        return m
    params = [m.bias, m.w, m.v]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    decay = np.where(np.arange(size) < BUCKETS, 1e-3, 1e-5)
    step = 0
    for epoch in range(epochs):
        rate = 0.02 * (1 - epoch / epochs) + 0.002
        order = rng.permutation(len(y))
        for at in range(0, len(y), BATCH):
            rows = order[at:at + BATCH]
            part = x.part(rows)
            logit, sums, vx = m.forward(part)
            err = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y[rows]) / len(rows)
            each = np.repeat(err, np.diff(part.start)) * part.value
            gw = np.bincount(part.index, each, size) + decay * m.w
            own = each[:, None] * (np.repeat(sums, np.diff(part.start), axis=0) - vx)
            gv = np.stack([np.bincount(part.index, own[:, f], size) for f in range(RANK)], axis=1) + decay[:, None] * m.v
            step += 1
            for p, g, a, b in zip(params, (np.array([err.sum()]), gw, gv), first, second, strict=True):
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                p -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-8)
    return m


def held_out(doc_id: Column) -> Column:
    """The quarter of the ids that no label is learned from. A null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def learn(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          length_col: str = "n_chars", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Machine:
    """Train on about ``sample_rows`` labelled rows that aren't held out (null labels are none; of
    repeated ones the smallest counts), chosen by a hash of the id, and of the text where ids repeat.
    Only their sparse features reach the driver. Ids may be of any type; without a length column the
    texts are measured."""
    lab = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
                 .groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).cast("int").alias("label")))
    n, parts = lab.count(), 1_000_000
    keep = lab.where(F.pmod(F.xxhash64("id", F.lit(5)), F.lit(parts)) < int(parts * min(1.0, sample_rows / max(n, 1))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(utf8(batch, "text"), _lengths(batch.column(3)))
            cut = x.start.astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.ListArray.from_arrays(cut, pa.array(x.index.astype(np.int32))),
                 pa.ListArray.from_arrays(cut, pa.array(x.value))], ["place", "label", "index", "value"])

    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), _length(docs, text_col, length_col))
    # a label's id may have any number of rows: they are counted, and the sample keeps to its size
    place = F.xxhash64(F.col("id").cast("string"), "text", F.lit(5))
    sample = sample.join(F.broadcast(keep), "id").withColumn("place", place)
    rows = sample.count()
    if rows > 2 * sample_rows:
        sample = sample.where(F.pmod("place", F.lit(parts)) < int(parts * sample_rows / rows))
    sample = sample.select("place", "label", "text", "length")
    got = sample.mapInArrow(run, "place long, label int, index array<int>, value array<float>").toArrow().combine_chunks()
    got = got.sort_by([("place", "ascending"), ("label", "ascending")])
    index, value = got["index"].combine_chunks(), got["value"].combine_chunks()
    sizes = np.asarray(pa.compute.list_value_length(index)).astype(np.int64)
    x = Rows(np.asarray(index.flatten()).astype(np.int64), np.asarray(value.flatten()),
             np.concatenate(([0], np.cumsum(sizes))))
    return train(x, np.asarray(got["label"]).astype(float))


def _length(docs: DataFrame, text_col: str, length_col: str) -> Column:
    """The length column, or where there is none the number of characters."""
    value = F.col(length_col) if length_col in docs.columns else F.length(text_col)
    return value.cast("double").alias("length")


def _lengths(column: pa.Array) -> np.ndarray:
    return np.nan_to_num(column.to_numpy(zero_copy_only=False).astype(float))


def scored(docs: DataFrame, machine: Machine, *, id_col: str = "doc_id", text_col: str = "text",
           length_col: str = "n_chars", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted for every row.

    Null and empty texts are texts without words and get a score like any other; a null length
    counts as 0. Repeated rows get equal scores. An empty table gives an empty result."""
    spec = docs.sparkSession.sparkContext.broadcast(machine)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                s = spec.value.score(features(utf8(batch, "text"), _lengths(batch.column(2))))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64())], ["id", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), _length(docs, text_col, length_col))
    return rows.mapInArrow(run, f"id {kind}, score double").select(
        F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def quality(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Learn from ``labels`` and score all of ``docs``."""
    return scored(docs, learn(docs, labels, **options))
