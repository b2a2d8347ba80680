"""Masked pseudo-likelihood with a bidirectional window network.

Every token is predicted from the two tokens on either side of it; a document's score is the sum
of the conditional log-probabilities. The network, in numpy: context embeddings, weighted by
position and summed, a tanh layer, and a two-step softmax (class of the word, word in its class).

The vocabulary and the output biases come from the counts of all words of all documents. Training
covers all documents too, every position once, in ``ROUNDS`` rounds. A hash of (id, text) deals a document
to its round and to one of the round's replicas, of which there is one per ``REPLICA`` words of the
corpus; a replica goes through its documents in order of their hashes. All replicas of a round begin with
the same network and the same sums of squared gradients, and their results are averaged, weighted by
targets, in a tree of small groups, to begin the next round. So files, partitions and the order of rows
have no part in the result, and a replica has a fixed size of about 1 MB however large the corpus.

The network knows the most frequent words and hash buckets of the others. A word of a bucket has the
bucket's probability times its share of the bucket: n / (N + 1), of the exact counts n of the word
and N of the bucket's D distinct words. The remaining 1 / (N + 1) is for unseen words, of which as
many are supposed as seen ones: 1 / ((N + 1) max(D, 1)) each. The counts of the words beyond the
vocabulary stay a table; every task has those of the ``KNOWN`` most frequent words when it looks up words,
and the (row, word) counts of all others are joined to the table. Words are looked up once, for training and
scores.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualmart.llm.common import LOWER_AZ
from qualmart.session import materialize

CLASSES = 64
IN_CLASS = 64
#: Tokens: the most frequent words, and hash buckets for the others.
TOKENS = CLASSES * IN_CLASS
BUCKETS = 512
WORDS = TOKENS - BUCKETS
DIM = 16
SIDE = 2
#: One position in this many is a training target: every one.
STRIDE = 1
BATCH = 1024
#: Positions that are sorted at once, and those that are scored at once, whose numbers should stay in the cache.
SORTED = 1 << 17
SCORED = 4096
RATE = 0.15
#: Passes of averaging, and words of the corpus per replica of one.
ROUNDS = 4
REPLICA = 1 << 20
#: Replicas that are averaged at once.
FAN_IN = 16
#: Words beyond the vocabulary whose counts every task has when it looks up words; those of all others are joined.
KNOWN = 1 << 16
#: Distinct words that a task counts, or twice as many counts of parts, before it passes them on.
COUNTED = 400_000
#: Sums of log shares are taken of whole multiples of 1 / SHARE_UNIT, so that their order is of no account.
SHARE_UNIT = 1 << 30
LOG2_E = 1 / np.log(2)
#: Added to a 32-bit number and taken off again, it rounds to a whole one.
_ROUND = np.float32(3 << 22)
#: Coefficients of 2 ** f for f within a half, the highest power first.
_EXP2 = [np.float32(c) for c in (0.001327647137, 0.00967554133, 0.05550713275, 0.2402211972, 0.6931469671, 1.000000072)]
_SHIFTS = [s for s in range(-SIDE, SIDE + 1) if s]
_AROUND = np.array(_SHIFTS)[:, None]


def words_of(text: bytes) -> list[bytes]:
    return text.translate(LOWER_AZ).split()


def all_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """``words_of`` a whole column: the words of all texts, one after another, and each text's number of words."""
    if pa.types.is_binary(texts.type):
        texts = texts.view(pa.string())
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words, sizes = lists.flatten(), np.asarray(pc.fill_null(pc.list_value_length(lists), 0), np.int64)
    whole = np.asarray(pc.binary_length(words)) > 0
    if not whole.all():  # blanks at either end of a text leave an empty word there
        sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[whole], minlength=len(sizes))
        words = words.filter(pa.array(whole))
    return words, sizes


def word_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """(word, n) over all documents; counted in each task first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def merged() -> pa.Table:
            n = pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")])
            return n.select(["word", "n_sum"]).rename_columns(["word", "n"])
        for whole in batches:
            for k in range(0, whole.num_rows, 256):
                n = all_words(whole.column(0).slice(k, 256))[0].value_counts()
                held.append(pa.table({"word": n.field(0).cast(pa.binary()), "n": n.field(1)}))
                if sum(len(t) for t in held) >= 2 * COUNTED:
                    held = [merged()]
                    if len(held[0]) >= COUNTED:
                        yield from held.pop().to_batches()
        if held:
            yield from merged().to_batches()

    counted = docs.select(text_col).mapInArrow(run, "word binary, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _bucket_tokens(words: Sequence[bytes]) -> np.ndarray:
    return WORDS + np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % BUCKETS


class Vocabulary:
    """Words by number: tokens first, then other known words, which share hash buckets with unknown ones. Both come
    in order of their numbers."""

    def __init__(self, tokens: dict[bytes, int], known: dict[bytes, int] | None = None):
        others = list(known or ())
        self.words = pa.array([*tokens, *others], pa.binary())
        self.tokens = np.concatenate([np.arange(len(tokens)), _bucket_tokens(others)])

    def read(self, words: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
        """Which of the distinct words each word is, the distinct words, their tokens and their numbers (-1: unknown)."""
        coded = words.dictionary_encode()
        distinct = coded.dictionary.cast(pa.binary())
        number = np.asarray(pc.fill_null(pc.index_in(distinct, value_set=self.words), -1)).astype(np.int64)
        missed, tokens = number < 0, np.empty(len(number), np.int64)
        tokens[~missed] = self.tokens[number[~missed]]
        tokens[missed] = _bucket_tokens(distinct.filter(pa.array(missed)).to_numpy(zero_copy_only=False))
        return np.asarray(coded.indices), distinct, tokens, number

    def ids(self, text: bytes) -> np.ndarray:
        code, _, tokens, _ = self.read(all_words(pa.array([text], pa.binary()))[0])
        return tokens[code]


def _arrays(data: bytes) -> list[np.ndarray]:
    with np.load(io.BytesIO(data)) as z:
        return [z[f"arr_{i}"] for i in range(len(z.files))]


class Network:
    """Parameters as float32 arrays; token number TOKENS is the padding around a document."""

    NAMES = ("embed", "place", "bias", "class_w", "class_b", "word_w", "word_b")

    def __init__(self, arrays: list[np.ndarray]):
        self.arrays = arrays
        self.embed, self.place, self.bias, self.class_w, self.class_b, self.word_w, self.word_b = arrays

    @classmethod
    def start(cls, counts: np.ndarray, seed: int = 11) -> Network:
        """Small random weights; the output biases are the corpus-wide log frequencies."""
        rng = np.random.default_rng(seed)
        n = (counts + 1.0).reshape(CLASSES, IN_CLASS)
        of_class = n.sum(axis=1)
        small = lambda *s: rng.normal(0, 0.1, s)
        arrays = [small(TOKENS + 1, DIM), 1 + small(len(_SHIFTS), DIM), np.zeros(DIM), small(CLASSES, DIM),
                  np.log(of_class / of_class.sum()), small(CLASSES, IN_CLASS, DIM), np.log(n / of_class[:, None])]
        return cls([a.astype(np.float32) for a in arrays])

    def dump(self, memory: list[np.ndarray] = ()) -> bytes:
        out = io.BytesIO()
        np.savez(out, *self.arrays, *memory)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Network:
        return cls(_arrays(data)[:len(cls.NAMES)])

    def hidden(self, tokens: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Neighbours, their embeddings, and the hidden layer."""
        context = np.take(tokens, at + _AROUND)
        near = np.take(self.embed, context, axis=0)
        h = np.einsum("smd,sd->md", near, self.place)
        h += self.bias
        return context, near, np.tanh(h, out=h)

    def log_probs(self, tokens: np.ndarray, at: np.ndarray) -> np.ndarray:
        """log p(token | two tokens on either side) at each position; ``tokens`` is padded."""
        out = np.empty(len(at), np.float64)
        class_w, word_w = _joined(self.class_w, self.class_b), _joined(self.word_w, self.word_b)
        scratch = np.empty((SCORED, IN_CLASS), self.embed.dtype)

        def bits(h: np.ndarray, weights: np.ndarray, target: np.ndarray) -> np.ndarray:
            x = np.matmul(h, weights, out=scratch[:len(h)])
            own = x.reshape(-1)[_flat(target)].astype(np.float64)
            sums, shift = _powers(x)
            return own - shift - np.log2(sums.astype(np.float64))
        for k in range(0, len(at), SORTED):
            here = at[k:k + SORTED]
            order = np.argsort(tokens[here].astype(np.int16), kind="stable")  # 16 bits are sorted by radix
            here = here[order]
            cls, word = np.divmod(tokens[here], IN_CLASS)
            h, found = np.empty((len(here), DIM + 1), self.embed.dtype), np.empty(len(here))
            for a in range(0, len(here), SCORED):
                part = slice(a, a + SCORED)
                h[part] = _with_one(self.hidden(tokens, here[part])[2])
                h[part] *= h.dtype.type(LOG2_E)
                found[part] = bits(h[part], class_w, cls[part])
            for c, a, b in _runs(cls):
                for i in range(a, b, SCORED):
                    part = slice(i, min(i + SCORED, b))
                    found[part] += bits(h[part], word_w[c], word[part])
            out[k + order] = found * np.log(2)
        return out

    def train(self, tokens: np.ndarray, at: np.ndarray, memory: list[np.ndarray], batch: int | None = None) -> None:
        """One pass of Adagrad over the positions; ``memory`` holds the sums of squared gradients. A
        word's embedding is touched only in batches where it is a neighbour, which is what Adagrad does
        with a gradient of zero."""
        step = batch or BATCH
        class_w, word_w = _joined(self.class_w, self.class_b), _joined(self.word_w, self.word_b)
        class_m, word_m = _joined(*memory[3:5]), _joined(*memory[5:7])
        class_g, word_g = np.empty_like(class_w), np.empty_like(word_w)
        of_class, of_word = np.empty((2, step, IN_CLASS), self.embed.dtype)
        through = np.empty((step, DIM + 1), self.embed.dtype)
        by_class = [(w, w.T, g) for w, g in zip(word_w, word_g, strict=True)]
        for k in range(0, len(at), step):
            here = at[k:k + step]
            here = here[np.argsort(tokens[here].astype(np.int16), kind="stable")]  # class by class
            n = len(here)
            cls, word = np.divmod(tokens[here], IN_CLASS)
            runs = _runs(cls)
            context, near, h = self.hidden(tokens, here)
            ones = _with_one(h)
            base2 = ones * h.dtype.type(LOG2_E)
            # powers of two stay as they are: what they are divided by is a factor of the few hidden units
            err = np.matmul(base2, class_w, out=of_class[:n])
            sums = _powers(err)[0]
            err.reshape(-1)[_flat(cls)] -= sums
            factor = (np.float32(1 / n) / sums)[:, None]
            np.matmul((ones * factor).T, err, out=class_g)
            back = err @ class_w.T
            back *= factor
            err = of_word[:n]
            for c, a, b in runs:
                np.matmul(base2[a:b], by_class[c][0], out=err[a:b])
            sums = _powers(err)[0]
            err.reshape(-1)[_flat(word)] -= sums
            factor = (np.float32(1 / n) / sums)[:, None]
            ones *= factor
            last = 0
            for c, a, b in runs:
                _, w, g = by_class[c]
                of_run = err[a:b]
                np.matmul(of_run, w, out=through[a:b])
                np.matmul(ones[a:b].T, of_run, out=g)
                if last < c:
                    word_g[last:c] = 0
                last = c + 1
            word_g[last:] = 0
            back += through[:n] * factor
            h *= h
            np.subtract(1, h, out=h)
            h *= back[:, :DIM]
            place_g = np.einsum("smd,md->sd", near, h)
            flat = context.reshape(-1)
            order = np.argsort(flat.astype(np.int16), kind="stable")
            flat = flat[order]
            first = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1])))
            rows = flat[first]
            own = np.take((h[None] * self.place[:, None]).reshape(-1, DIM), order, axis=0)
            seen, part = np.take(memory[0], rows, axis=0), np.take(self.embed, rows, axis=0)
            self._step(part, np.add.reduceat(own, first, axis=0), seen)
            memory[0][rows], self.embed[rows] = seen, part
            self._step(self.place, place_g, memory[1])
            self._step(self.bias, h.sum(axis=0), memory[2])
            self._step(class_w, class_g, class_m)
            self._step(word_w, word_g, word_m)
        for weights, bias, joined in ((self.class_w, self.class_b, class_w), (self.word_w, self.word_b, word_w),
                                      (*memory[3:5], class_m), (*memory[5:7], word_m)):
            weights[...], bias[...] = joined[..., :DIM, :].swapaxes(-1, -2), joined[..., DIM, :]

    @staticmethod
    def _step(array: np.ndarray, grad: np.ndarray, memory: np.ndarray) -> None:
        """In place, through one scratch array."""
        scratch = grad * grad
        memory += scratch
        np.sqrt(memory, out=scratch)
        scratch += np.float32(1e-6)
        np.divide(grad, scratch, out=scratch)
        scratch *= np.float32(RATE)
        array -= scratch


def _joined(weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Transposed weights with the bias as one more row: one multiplication gives both, and both gradients."""
    return np.concatenate([weights.swapaxes(-1, -2), bias[..., None, :]], axis=-2)


def _with_one(h: np.ndarray) -> np.ndarray:
    """Hidden units and the one that the biases are multiplied with."""
    out = np.ones((len(h), DIM + 1), h.dtype)
    out[:, :DIM] = h
    return out


def _flat(target: np.ndarray) -> np.ndarray:
    """Where the targets' numbers stand in rows of IN_CLASS (or CLASSES) that follow one another."""
    return np.arange(0, len(target) * IN_CLASS, IN_CLASS) + target


def _runs(cls: np.ndarray) -> list[tuple[int, int, int]]:
    """(class, first, end) of each run of sorted classes."""
    cut = np.searchsorted(cls, np.arange(CLASSES + 1)).tolist()
    return [(c, a, b) for c, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if b > a]


def _powers(x: np.ndarray) -> tuple[np.ndarray, np.ndarray | float]:
    """2 ** (x - shift) in place; returns its sum for each row, and the shift. Rows are shifted only if
    a power is not well within the range of 32-bit numbers."""
    shift = 0.0
    if len(x) and (x.max() > 60 or x.min() < -60):
        shift = x.max(axis=1)
        x -= shift[:, None]
        np.maximum(x, -110, out=x)
    return np.einsum("ij->i", _exp2(x)), shift


def _exp2(x: np.ndarray) -> np.ndarray:
    """2 ** x in place, for x from -125 to 125. numpy takes powers of 32-bit numbers one by one; this adds the nearest
    whole number to the exponent of a polynomial of the rest, whose relative error is that of rounding."""
    if x.dtype != np.float32:
        return np.exp2(x, out=x)
    whole = x + _ROUND
    power = whole - _ROUND
    x -= power
    np.multiply(x, _EXP2[0], out=power)
    for c in _EXP2[1:-1]:
        power += c
        power *= x
    np.add(power, _EXP2[-1], out=x)
    bits = whole.view(np.int32)
    bits <<= 23
    exponents = x.view(np.int32)
    exponents += bits
    return x


def padded(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All documents in one array with padding around each, and where each begins."""
    size = np.array([len(d) + SIDE for d in docs], np.int64)
    start = SIDE + np.concatenate(([0], np.cumsum(size)))
    tokens = np.full(start[-1], TOKENS, np.int64)
    for d, s in zip(docs, start[:-1], strict=True):
        tokens[s:s + len(d)] = d
    return tokens, start[:-1]


_REPLICA = "replica long, targets long, state binary"


def _dealt(rows: DataFrame, this: int, replicas: int) -> DataFrame:
    """(replica, h, tokens) of the documents of round ``this``, in order of h within their replica's task.
    Only token numbers are shuffled, two bytes a word."""
    replica = F.pmod(F.shiftright("h", 8), F.lit(replicas)).cast("int").alias("replica")
    dealt = rows.where(F.pmod("h", F.lit(ROUNDS)) == this).select(replica, "h", "tokens")
    return dealt.repartitionById(replicas, F.col("replica")).sortWithinPartitions("h")


def _trained(dealt: DataFrame, state, stride: int) -> DataFrame:
    """(replica, targets, state): one row per replica with words. Documents are put together until a batch
    is full, so that batches don't depend on how rows arrive."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = _arrays(state.value)
        net, memory = Network(arrays[:len(arrays) // 2]), arrays[len(arrays) // 2:]
        held, words, n, replica = [], 0, 0, None

        def learn(docs: list[tuple[int, np.ndarray]]) -> int:
            tokens, begin = padded([d for _, d in docs])
            at = np.concatenate([np.arange(b + h % stride, b + len(d), stride)
                                 for (h, d), b in zip(docs, begin, strict=True)])
            net.train(tokens, at, memory)
            return len(at)
        for batch in batches:
            for r, h, data in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                replica = r
                held.append((h, np.frombuffer(data, "<u2").astype(np.int64)))
                words += len(held[-1][1])
                if words >= 16 * BATCH:
                    n += learn(held)
                    held, words = [], 0
        if words:
            n += learn(held)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([replica], pa.int64()), pa.array([n], pa.int64()), pa.array([net.dump(memory)], pa.binary())],
                ["replica", "targets", "state"])

    return dealt.mapInArrow(run, _REPLICA)


def _average(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("replica")
    total = int(pdf["targets"].sum())
    sums = None
    for n, data in zip(pdf["targets"], pdf["state"], strict=True):
        arrays = [a.astype(np.float64) * (n / total) for a in _arrays(data)]
        sums = arrays if sums is None else [s + a for s, a in zip(sums, arrays, strict=True)]
    out = io.BytesIO()
    np.savez(out, *[s.astype(np.float32) for s in sums])
    return pd.DataFrame({"replica": [int(pdf["replica"].iloc[0]) // FAN_IN], "targets": [total],
                         "state": [out.getvalue()]})


def _round(rows: DataFrame, begin: bytes, this: int, replicas: int, stride: int) -> bytes:
    """The state after one round: all replicas trained from ``begin`` and averaged."""
    state = rows.sparkSession.sparkContext.broadcast(begin)
    done = materialize(_trained(_dealt(rows, this, replicas), state, stride), "lm-replicas")
    while (left := done.count()) > 1:
        group = F.floor(F.col("replica") / FAN_IN).alias("group")
        if left <= FAN_IN:
            group = F.lit(0).alias("group")
        done = materialize(done.groupBy(group).applyInPandas(_average, _REPLICA), "lm-replicas")
    last = done.first()
    state.unpersist()
    return bytes(last.state) if last else begin


class Model(NamedTuple):
    """``counts``: (word, n) of all words; ``known``: the same of the most frequent ones beyond ``vocab``.
    ``buckets``: count and number of the words of each bucket."""

    vocab: dict[bytes, int]
    weights: bytes
    counts: DataFrame
    known: dict[bytes, int]
    buckets: list[tuple[int, int]]

    def shares(self) -> np.ndarray:
        """Log share of its bucket of each word of ``known``, in multiples of 1 / SHARE_UNIT."""
        n = np.fromiter(self.known.values(), np.float64, len(self.known))
        bucket = np.fromiter(map(zlib.crc32, self.known), np.int64, len(n)) % BUCKETS
        total = np.array([t for t, _ in self.buckets], np.float64)[bucket]
        return np.rint((np.log(n) - np.log(total + 1)) * SHARE_UNIT).astype(np.int64)


def _bucket(word: Column) -> Column:
    return F.crc32(word) % BUCKETS


def _untrained(docs: DataFrame, text_col: str) -> tuple[Model, np.ndarray]:
    """The model without a network, and the counts of the tokens."""
    counts = materialize(word_counts(docs, text_col), "lm-counts")
    frequent = counts.orderBy(F.desc("n"), "word").limit(WORDS + KNOWN).collect()
    known = {bytes(r.word): r.n for r in frequent[WORDS:]}
    frequent = frequent[:WORDS]
    vocab = {bytes(r.word): i for i, r in enumerate(frequent)}
    n = np.zeros(TOKENS)
    n[: len(frequent)] = [r.n for r in frequent]
    buckets = [(0, 0)] * BUCKETS
    if len(frequent) == WORDS:
        last = frequent[-1]
        others = counts.where((F.col("n") < last.n) | (F.col("n") == last.n) & (F.col("word") > F.lit(bytes(last.word))))
        for r in others.groupBy(_bucket(F.col("word")).alias("b")).agg(F.sum("n").alias("n"), F.count("*").alias("d")).collect():
            buckets[r.b] = (r.n, r.d)
    n[WORDS:] = [b[0] for b in buckets]
    return Model(vocab, b"", counts, known, buckets), n


def _read(docs: DataFrame, model: Model, id_col: str, text_col: str) -> DataFrame:
    """(row, doc_id, h, tokens, share, others) of every row, written once and read by the rounds and for the scores:
    its number, its hash, two bytes a token, the sum of the known words' log shares, and the count of each
    unknown word."""
    spec = docs.sparkSession.sparkContext.broadcast((model.vocab, model.known, model.shares()))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, known, share_of = spec.value
        words, share_of = Vocabulary(vocab, known), np.concatenate([np.zeros(len(vocab), np.int64), share_of, [0]])
        for whole in batches:
            for k in range(0, whole.num_rows, 256):
                batch = whole.slice(k, 256)
                text, size = all_words(batch.column(2))
                code, distinct, token, number = words.read(text)
                end = np.concatenate(([0], np.cumsum(size)))
                data, at = token[code].astype("<u2").tobytes(), (2 * end).tolist()
                shares = np.concatenate(([0], np.cumsum(share_of[number][code])))[end]
                unknown = np.flatnonzero((number < 0)[code])
                of = np.repeat(np.arange(len(size)), size)[unknown]
                pair, n = np.unique(of * max(len(distinct), 1) + code[unknown], return_counts=True)
                of, word = np.divmod(pair, max(len(distinct), 1))
                pairs = pa.StructArray.from_arrays([distinct.take(pa.array(word)), pa.array(n, pa.int64())], ["word", "k"])
                ends = np.searchsorted(of, np.arange(len(size) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array([data[a:b] for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary()),
                     pa.array(np.diff(shares), pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pairs)],
                    ["doc_id", "h", "tokens", "share", "others"])

    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("h"), F.col(text_col).alias("text"))
    rows = rows.mapInArrow(run, f"doc_id {kind}, h long, tokens binary, share long, others array<struct<word:binary,k:long>>")
    return materialize(rows.withColumn("row", F.monotonically_increasing_id()), "lm-rows")  # numbers are read back, never given anew


def _fit(rows: DataFrame, model: Model, n: np.ndarray, stride: int, replica: int) -> Model:
    start = Network.start(n)
    state = start.dump([np.full(a.shape, 1e-4, np.float32) for a in start.arrays])
    replicas = max(1, round(n.sum() / (ROUNDS * replica)))
    for this in range(ROUNDS):
        state = _round(rows, state, this, replicas, stride)
    return model._replace(weights=Network.load(state).dump())


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", stride: int = STRIDE,
        replica: int = REPLICA) -> Model:
    """Counts and network from all documents. Without any word the starting network remains."""
    model, n = _untrained(docs, text_col)
    return _fit(_read(docs, model, id_col, text_col), model, n, stride, replica)


def _bucket_scored(rows: DataFrame, model: Model) -> DataFrame:
    """(row, doc_id, n_tokens, log_likelihood, share): scores of the tokens, and the sum of the known words' log shares."""
    weights = rows.sparkSession.sparkContext.broadcast(model.weights)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network.load(weights.value)
        for whole in batches:
            for k in range(0, whole.num_rows, 256):
                batch = whole.slice(k, 256)
                docs_ids = [np.frombuffer(t, "<u2") for t in batch.column(2).to_pylist()]
                tokens, _ = padded(docs_ids)
                size = np.array([len(d) for d in docs_ids], np.int64)
                sums = np.zeros(len(size))
                at = np.flatnonzero(tokens != TOKENS)
                if len(at):
                    doc = np.repeat(np.arange(len(size)), size)
                    sums = np.bincount(doc, net.log_probs(tokens, at), len(size))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(size), pa.array(sums), batch.column(3)],
                    ["row", "doc_id", "n_tokens", "log_likelihood", "share"])

    return rows.select("row", "doc_id", "tokens", "share").mapInArrow(
        run, f"row long, doc_id {kind}, n_tokens long, log_likelihood double, share long")


def _scored(rows: DataFrame, model: Model) -> DataFrame:
    base = materialize(_bucket_scored(rows, model), "lm-scores")
    total = F.array(*[F.lit(float(np.log(n + 1))) for n, _ in model.buckets])
    unseen = F.array(*[F.lit(float(-np.log(max(d, 1)))) for _, d in model.buckets])
    # a word beyond the known ones is at most one token in KNOWN, so no key is hot; sorted merge at any
    # size, as the counts grow with the documents
    pairs = rows.select("row", F.explode("others").alias("o")).select("row", "o.word", "o.k")
    b = _bucket(F.col("word")).cast("int") + 1
    share = F.coalesce(F.log("n"), F.element_at(unseen, b)) - F.element_at(total, b)
    pairs = pairs.join(model.counts.hint("merge"), "word", "left").select(
        "row", (F.round(share * SHARE_UNIT).cast("long") * F.col("k")).alias("share"))
    none = [F.lit(None).cast(base.schema[c].dataType).alias(c) for c in ("doc_id", "n_tokens", "log_likelihood")]
    out = base.unionByName(pairs.select("row", *none, "share")).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"),
        (F.max("log_likelihood") + F.sum("share") / SHARE_UNIT).alias("log_likelihood"))
    return out.select("doc_id", "n_tokens", "log_likelihood", F.exp(
        -F.col("log_likelihood") / F.greatest("n_tokens", F.lit(1))).alias("perplexity"))


def scored(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, log_likelihood (sum over all tokens) and perplexity of every row.

    Null, empty and blank texts have no tokens, log-likelihood 0 and perplexity 1. Repeated rows get
    equal scores. Other columns aren't read. An empty table gives an empty result."""
    return _scored(_read(docs, model, id_col, text_col), model)


def pseudo_likelihood(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                      stride: int = STRIDE) -> DataFrame:
    """Fit on all of ``docs`` and score them; their words are looked up once for both."""
    model, n = _untrained(docs, text_col)
    rows = _read(docs, model, id_col, text_col)
    return _scored(rows, _fit(rows, model, n, stride, REPLICA))
