"""Spelling variants of a corpus's words, found with a frequency-vector trie.

1. Words are counted in one scan over the whole texts: each task counts the words of its documents
   in a bounded table, and the counts are summed after that.
2. Letters are dealt to groups of about equal weight. A word's vector has the number of its letters
   in each group; one inserted, deleted or replaced letter changes it by a surplus of at most one and a
   deficit of at most one. The trie arranges words by successive group counts.
3. The trie's top is laid out over the cluster: a node with more than ``node`` words is split by its
   next group, until each shard is a node that one task can hold. A word visits the shards whose
   prefix it can reach within the budget. Words of equal vectors that fill a shard are dealt to
   blocks, and visit the other blocks.
4. Within a shard the search descends both sides' tries together, depth first: a pair of nodes goes on
   to each pair of children whose counts differ by no more than what is left of the budget. Pairs of
   vectors are ordered (their first difference is a surplus), so every pair of words is met once.
   The words at the leaves are verified letter by letter.
5. A shard yields one row per word: how many near words, and the most frequent one. These are merged,
   and forms are followed to their roots by pointer doubling.

No word, link or shard is dropped or sampled. See ``variants`` for the defined cases.
"""

from __future__ import annotations

import re
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualmart.llm.common import LOWER_AZ, utf8
from qualmart.llm.merkle import SQL_CRC_TABLE, sql_crc32
from qualmart.session import materialize

#: A run of letters of these ranges is a word.
LETTERS = "A-Za-zÀ-ÿ"
#: One in so many (document, word) pairs loses a letter.
TYPO = 97
LENGTH, COUNT = 5, 3
#: A form is at least so many times as frequent.
RATIO = 2
#: Letter groups, that is levels of the trie.
GROUPS = 16
#: Words of one trie node that a task holds.
NODE = 4096
#: A task's table of words is emptied when it has grown to this size.
_TABLE = 400_000
#: Pairs of trie nodes, or of words, handled at once.
_PAIRS = 1 << 18
#: Longest word that the vectorised steps take; longer ones are handled one by one.
_LONG = 64


# ------------------------------------------------------------------ counting words

class _Shifts:
    """crc32 of ``prefix + word`` for many pairs at once, from the crc32 of each part: the prefix's is
    carried over the word's length by a linear map, tabulated by byte, then the word's is added."""

    def __init__(self):
        zeros = [b"\0" * n for n in range(_LONG + 1)]
        self.table = np.array([[[zlib.crc32(z, b << 8 * k) ^ zlib.crc32(z) for b in range(256)]
                                for k in range(4)] for z in zeros], np.uint32)

    def crc(self, prefix: np.ndarray, word: np.ndarray, size: np.ndarray) -> np.ndarray:
        out = word.copy()
        for k in range(4):
            out ^= self.table[size, k, prefix >> np.uint32(8 * k) & np.uint32(255)]
        return out


class _Table:
    """Counts of words, with a letter taken from those (document, word) pairs that the rule names."""

    def __init__(self, typo: int):
        self.typo, self.shifts = typo, _Shifts()
        self.clear()

    def clear(self) -> None:
        self.index, self.words, self.sizes, self.crcs = {}, [], [], []
        self.counts = np.zeros(0, np.int64)
        self.changed: dict[str, int] = {}

    def _number(self, word: str) -> int:
        at = self.index.get(word)
        if at is None:
            at = self.index[word] = len(self.words)
            raw = word.encode()
            self.words.append(word)
            self.sizes.append(len(raw))
            self.crcs.append(zlib.crc32(raw))
        return at

    def add(self, docs: list[tuple[object, list[str]]]) -> None:
        """Count the words of some documents, given as (id, words)."""
        number, index = self._number, self.index
        at = np.fromiter((index[w] if w in index else number(w) for _, words in docs for w in words), np.int64)
        n = np.bincount(at, minlength=len(self.words))
        n[:len(self.counts)] += self.counts
        self.counts = n
        lengths = [len(words) for i, words in docs if i is not None]
        if not sum(lengths):
            return
        if len(lengths) < len(docs):  # a document without an id keeps its words
            at = at[np.repeat([i is not None for i, _ in docs], [len(w) for _, w in docs])]
        prefix = np.repeat(np.array([zlib.crc32(f"{i}:".encode()) for i, _ in docs if i is not None], np.uint32), lengths)
        size, crc = np.array(self.sizes)[at], np.array(self.crcs, np.uint32)[at]
        h = self.shifts.crc(prefix, crc, np.minimum(size, _LONG))
        for k in np.flatnonzero(size > _LONG).tolist():
            h[k] = zlib.crc32(self.words[at[k]].encode(), int(prefix[k]))
        for k in np.flatnonzero(h % np.uint32(self.typo) == 0).tolist():
            word, cut = self.words[at[k]], int(h[k])
            cut %= len(word)
            self.counts[at[k]] -= 1
            word = word[:cut] + word[cut + 1:]
            self.changed[word] = self.changed.get(word, 0) + 1

    def rows(self, length: int) -> Iterator[pa.RecordBatch]:
        found = [(w, n) for w, n in zip(self.words, self.counts.tolist(), strict=True) if n and len(w) >= length]
        found += [(w, n) for w, n in self.changed.items() if len(w) >= length]
        for at in range(0, len(found), 50_000):
            words, n = zip(*found[at:at + 50_000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(n, pa.int64())], ["word", "n"])


def counted_words(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", typo: int = TYPO,
                  length: int = LENGTH, count: int = COUNT) -> DataFrame:
    """(word, n) of the words of at least ``length`` letters with at least ``count`` occurrences."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = re.compile(f"[{LETTERS}]+").findall
        table = _Table(typo)
        for batch in batches:
            some, words = [], 0
            for i, text in zip(batch.column(0).to_pylist(), utf8(batch, text_col), strict=True):
                some.append((i, find(text.translate(LOWER_AZ).decode())))
                words += len(some[-1][1])
                if words > 200_000:
                    table.add(some)
                    some, words = [], 0
            table.add(some)
            if len(table.words) + len(table.changed) > _TABLE:
                yield from table.rows(length)
                table.clear()
        yield from table.rows(length)

    parts = docs.select(id_col, text_col).mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= count)


# ------------------------------------------------------------------ vectors and shards

def letter_groups(words: DataFrame, groups: int = GROUPS) -> dict[str, int]:
    """Letter to group, of about equal numbers of letters in all words. An alphabet has few letters
    (at most 90 here), so the counts fit on the driver."""
    each = words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").count().collect()
    load, out = [0] * groups, {}
    for r in sorted(each, key=lambda r: (-r["count"], r.letter)):
        least = min(range(groups), key=lambda g: (load[g], g))
        out[r.letter] = least
        load[least] += r["count"]
    return out


def _vector(word: Column, groups: dict[str, int], n: int) -> Column:
    """Letters of the word in each group, as an array of ints."""
    counts = []
    for g in range(n):
        letters = "".join(c for c, own in groups.items() if own == g)
        counts.append(F.length(word) - F.length(F.translate(word, letters, "")) if letters else F.lit(0))
    return F.array(*counts)


def shards(words: DataFrame, node: int = NODE, groups: int = GROUPS) -> DataFrame:
    """(shard, member, word, n, vector): the members of each shard and the words that visit it.

    Each round writes and splits the nodes with more than ``node`` members by their next count. A word
    follows the counts up to one above its own, and once it has a surplus or deficit, what is left of
    its budget; visitors only go to nodes that have members."""
    own = letter_groups(words, groups)
    at = words.select("word", "n", _vector(F.col("word"), own, groups).alias("vector"),
                      F.array().cast("array<int>").alias("shard"), F.lit(0).alias("up"), F.lit(0).alias("down"))
    member = (F.col("up") == 0) & (F.col("down") == 0)
    done = None
    for level in range(groups + 1):
        at = materialize(at, "spelling-nodes")
        sizes = materialize(at.where(member).groupBy("shard").agg(F.count("*").alias("members"))
                              .where(F.col("members") > node), "spelling-large")
        large = sizes.isEmpty()
        here = at if large else at.join(sizes, "shard", "left_anti")
        here = here.select("shard", member.alias("member"), "word", "n", "vector")
        done = here if done is None else done.unionByName(here)
        if large:
            return done
        at = at.join(sizes, "shard")
        if level == groups:
            return done.unionByName(_blocks(at, member, node))
        step = F.explode(F.when(member, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(-1), F.lit(0), F.lit(1))))
        at = at.withColumn("step", step)
        count = F.get("vector", F.lit(level)) + F.col("step")
        at = at.select("word", "n", "vector", F.concat("shard", F.array(count)).alias("shard"),
                       (F.col("up") + (F.col("step") > 0).cast("int")).alias("up"),
                       (F.col("down") + (F.col("step") < 0).cast("int")).alias("down")).where(
            (count >= 0) & (F.col("up") < 2) & (F.col("down") < 2))
        # visitors of nodes without members have nothing to meet there
        met = at.where(member).select("shard").distinct()
        at = at.where(member).unionByName(at.where(~member).join(met, "shard", "left_semi").select(at.columns))
    return done


def _blocks(at: DataFrame, member: Column, node: int) -> DataFrame:
    """Members of equal vectors, dealt to blocks; members visit later blocks, visitors all."""
    blocks = F.ceil(F.col("members") / node).cast("int")
    own = F.pmod(F.xxhash64("word"), blocks).cast("int")
    first = F.when(member, own).otherwise(F.lit(0))
    each = at.withColumn("own", first).withColumn("block", F.explode(F.sequence("own", blocks - 1)))
    return each.select(F.concat("shard", F.array(F.col("block"))).alias("shard"),
                       (member & (F.col("block") == F.col("own"))).alias("member"), "word", "n", "vector")


# ------------------------------------------------------------------ search within a shard

class _Trie:
    """Distinct vectors in ascending order; a node of level k is a run of equal first k counts."""

    def __init__(self, vectors: np.ndarray):
        self.vectors, self.leaf_of = np.unique(vectors, axis=0, return_inverse=True)
        self.leaf_of = self.leaf_of.reshape(-1)
        n, groups = self.vectors.shape
        new = np.zeros(n, bool)
        new[:1] = True
        self.keys, self.count, parent = [], [], np.zeros(n, np.int64)
        for k in range(groups):
            new = new | np.concatenate(([True], np.diff(self.vectors[:, k]) != 0))[:n]
            first = np.flatnonzero(new)
            count = self.vectors[first, k].astype(np.int64)
            self.count.append(count)
            self.keys.append(parent[first] << 20 | count)  # ascending
            parent = np.cumsum(new) - 1

    def children(self, level: int, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = self.keys[level]
        return np.searchsorted(keys, node << 20), np.searchsorted(keys, (node + 1) << 20)

    def child(self, level: int, node: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Child with a given count, and whether there is one."""
        keys, wanted = self.keys[level], node << 20 | count
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return at, (keys[at] == wanted) & (count >= 0)


def _spread(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, position) for every position of the ranges."""
    n = end - start
    row = np.repeat(np.arange(len(n)), n)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + start[row]


def near_leaves(left: _Trie, right: _Trie) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (leaf of left, leaf of right) within a surplus and a deficit of one: equal vectors, or
    vectors whose first difference is a surplus on the right. Depth first, a chunk of pairs a time."""
    depth = left.vectors.shape[1]
    zero = np.zeros(1, np.int64)
    stack = [(0, zero, zero, np.zeros(1, np.int8), np.zeros(1, np.int8))]
    while stack:
        level, a, b, up, down = stack.pop()
        if level == depth:
            yield a, b
            continue
        if len(a) > _PAIRS:
            for at in range(0, len(a), _PAIRS):
                cut = slice(at, at + _PAIRS)
                stack.append((level, a[cut], b[cut], up[cut], down[cut]))
            continue
        row, x = _spread(*left.children(level, a))
        b, up, down, count = b[row], up[row], down[row], left.count[level][x]
        found = []
        for step in (-1, 0, 1):
            may = (up < 1 if step > 0 else (down < 1) & (up > 0) if step < 0 else np.True_)
            y, is_there = right.child(level, b, count + step)
            go = is_there & may
            found.append((x[go], y[go], up[go] + (step > 0), down[go] + (step < 0)))
        a, b, up, down = (np.concatenate(c) for c in zip(*found, strict=True))
        if len(a):
            stack.append((level + 1, a, b, up.astype(np.int8), down.astype(np.int8)))


def _one_edit(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    p = 0
    while p < min(len(a), len(b)) and a[p] == b[p]:
        p += 1
    if len(a) == len(b):
        return a[p + 1:] == b[p + 1:]
    return a[p:] == b[p + 1:] if len(a) < len(b) else a[p + 1:] == b[p:]


class _Letters:
    """Words as rows of letters, aligned at their beginnings and at their ends."""

    def __init__(self, words: list[str]):
        self.words = words
        self.size = np.fromiter(map(len, words), np.int64, len(words))
        width = max(1, min(_LONG, int(self.size.max(initial=1))))
        short = [w if len(w) <= width else "" for w in words]
        raw = np.array([w.ljust(width, "\0") for w in short], f"<U{width}").view("<u4").reshape(-1, width)
        end = np.array([w.rjust(width, "\0") for w in short], f"<U{width}").view("<u4").reshape(-1, width)
        self.head, self.tail = raw.astype(np.uint8), np.ascontiguousarray(end.astype(np.uint8)[:, ::-1])

    def one_edit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair of words whether exactly one letter is inserted, deleted or replaced."""
        out = np.zeros(len(a), bool)
        long = (self.size[a] > _LONG) | (self.size[b] > _LONG)
        gap = self.size[a] - self.size[b]
        same = np.flatnonzero((gap == 0) & ~long)
        out[same] = (self.head[a[same]] != self.head[b[same]]).sum(axis=1) == 1
        other = np.flatnonzero((np.abs(gap) == 1) & ~long)
        x, y = a[other], b[other]
        front = (self.head[x] != self.head[y]).argmax(axis=1)
        back = (self.tail[x] != self.tail[y]).argmax(axis=1)
        out[other] = front + back >= np.minimum(self.size[x], self.size[y])
        for k in np.flatnonzero(long).tolist():
            out[k] = _one_edit(self.words[a[k]], self.words[b[k]])
        return out


def near_pairs(words: list[str], member: np.ndarray, vectors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each pair of indexes of near words of which the second is a member: visitor and member, or two
    members once."""
    letters = _Letters(words)
    left, right = _Trie(vectors), _Trie(vectors[member])
    who = np.flatnonzero(member)
    held = np.argsort(right.leaf_of, kind="stable")
    ends = np.cumsum(np.bincount(right.leaf_of, minlength=len(right.vectors)))
    comes = np.argsort(left.leaf_of, kind="stable")
    stops = np.cumsum(np.bincount(left.leaf_of, minlength=len(left.vectors)))
    for a, b in near_leaves(left, right):
        pair, i = _spread(np.concatenate(([0], stops))[a], stops[a])
        for at in range(0, len(pair), _PAIRS // 16):
            some, mine = pair[at:at + _PAIRS // 16], comes[i[at:at + _PAIRS // 16]]
            row, j = _spread(np.concatenate(([0], ends))[b[some]], ends[b[some]])
            for cut in range(0, len(row), _PAIRS):
                x, y = mine[row[cut:cut + _PAIRS]], who[held[j[cut:cut + _PAIRS]]]
                alike = left.leaf_of[x] == left.leaf_of[y]
                go = ~(alike & member[x]) | (x < y)  # two members of one leaf meet both ways
                x, y = x[go], y[go]
                near = letters.one_edit(x, y)
                yield x[near], y[near]


_FOUND = "word string, n_near long, best_n long, best string"


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (shard, member, word, n, vector) sorted by shard to one row per word with near words."""
    def solve(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        member = rows["member"].to_numpy(zero_copy_only=False)
        if not member.any() or rows.num_rows < 2:
            return
        words, n = rows["word"].to_pylist(), rows["n"].to_numpy()
        flat = rows["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        place = np.empty(len(words), np.int64)  # in code-point order
        place[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
        total = np.zeros(len(words), np.int64)
        best = np.full(len(words), -1)
        for x, y in near_pairs(words, member, flat.reshape(len(words), -1)):
            a, b = np.concatenate((x, y)), np.concatenate((y, x))
            total += np.bincount(a, minlength=len(words))
            order = np.lexsort((place[b], -n[b], a))
            a, b = a[order], b[order]
            first = np.flatnonzero(np.concatenate(([True], np.diff(a) != 0))[:len(a)])
            a, b = a[first], b[first]
            old = best[a]
            better = (old < 0) | (n[b] > n[old]) | ((n[b] == n[old]) & (place[b] < place[old]))
            best[a[better]] = b[better]
        found = np.flatnonzero(total)
        name = pa.array(words, pa.string())
        yield pa.RecordBatch.from_arrays(
            [name.take(pa.array(found)), pa.array(total[found]), pa.array(n[best[found]], pa.int64()),
             name.take(pa.array(best[found]))], ["word", "n_near", "best_n", "best"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        key = batch.column(0).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            if start == end:
                continue
            if held and held[-1].column(0)[0].as_py() != key[start]:
                yield from solve(pa.Table.from_batches(held))
                held = []
            held.append(batch.slice(start, end - start))
    if held:
        yield from solve(pa.Table.from_batches(held))


def near_words(words: DataFrame, node: int = NODE, groups: int = GROUPS) -> DataFrame:
    """(word, n, n_near, best_n, best) for every row of (word, n): the number of near words, and the
    most frequent of them (of equally frequent ones the first in code-point order)."""
    dealt = shards(words, node, groups).withColumn("shard", F.array_join("shard", ","))
    found = (dealt.select("shard", "member", "word", "n", "vector").repartition("shard")
                  .sortWithinPartitions("shard").mapInArrow(_search, _FOUND))
    none = words.select("word", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("best_n"),
                        F.lit(None).cast("string").alias("best"), "n")
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("less"), "best")))
    merged = none.unionByName(found.withColumn("n", F.lit(None).cast("long"))).groupBy("word").agg(
        F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("b"))
    return merged.select("word", "n", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.best").alias("best"))


# ------------------------------------------------------------------ roots

def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for the words of (word, form) whose form isn't null: the last word reached by
    following forms. Each round doubles the steps and is written; a form is more frequent than its word,
    so no chain is longer than the number of bits of a count. A pointer that many words share is split
    by the adaptive join."""
    chain = forms.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    chain = materialize(chain, "spelling-roots")
    while True:
        further = chain.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = chain.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                           F.col("next").isNotNull().alias("moved"))
        chain = materialize(moved, "spelling-roots")
        if chain.where("moved").isEmpty():
            return chain.select("word", "root")
        chain = chain.drop("moved")


def variants(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", typo: int = TYPO,
             node: int = NODE, groups: int = GROUPS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every counted word of the documents.

    A null or empty text has no words; a document without an id keeps its words as they are. Repeated
    rows count again. Equally frequent near words: the first in code-point order is the form. An empty
    table, or one without frequent words, gives an empty result. Words of any length take part."""
    words = materialize(counted_words(docs, id_col=id_col, text_col=text_col, typo=typo), "spelling-words")
    near = near_words(words, node, groups)
    is_form = F.col("best_n") >= RATIO * F.col("n")
    forms = materialize(near.select("word", "n", "n_near", F.when(is_form, F.col("best")).alias("form"),
                                    F.when(is_form, F.col("best_n")).alias("form_n")), "spelling-forms")
    return forms.join(roots(forms), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _sql() -> str:
    """Near words share a word with one letter deleted; whether they are one edit apart is checked on
    words with one byte a letter, because the SQL engine counts edits in bytes."""
    accented = "".join(map(chr, range(0xC0, 0x100)))
    bytes_for = [c for c in map(chr, range(33, 127)) if c not in string.ascii_lowercase and c not in "'\\"]
    plain = f"translate(word, '{accented}', '{''.join(bytes_for[:64])}')"
    lower = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    text = "doc_id::VARCHAR || ':' || w"
    raw = (f"list_transform(range(strlen({text})), lambda k: "
           f"('0x' || substr(hex({text}), (2 * k + 1)::BIGINT, 2))::BIGINT)")
    return f"""WITH RECURSIVE {SQL_CRC_TABLE},
r AS (SELECT doc_id, unnest(regexp_extract_all({lower}, '[{LETTERS}]+')) AS w FROM documents),
p AS (SELECT doc_id, w, count(*) AS c FROM r GROUP BY ALL),
h AS (SELECT w, c, {sql_crc32(raw)} AS h FROM p, crc),
e AS (SELECT c, CASE WHEN h % {TYPO} = 0 THEN left(w, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word FROM h),
v AS (SELECT word, sum(c)::BIGINT AS n, {plain} AS b FROM e
      WHERE length(word) >= {LENGTH} GROUP BY word HAVING sum(c) >= {COUNT}),
x AS (SELECT DISTINCT word, n, b, unnest(list_append(list_transform(range(length(word)),
        lambda k: left(word, k) || substr(word, k + 2)), word)) AS part FROM v),
g AS (SELECT DISTINCT s.word, s.n, t.word AS near, t.n AS near_n FROM x s JOIN x t ON s.part = t.part
      WHERE levenshtein(s.b, t.b) = 1),
m AS (SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS best, max(near_n) AS best_n
      FROM g GROUP BY word),
f AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= {RATIO} * n THEN best END AS form,
        CASE WHEN best_n >= {RATIO} * n THEN best_n END AS form_n FROM v LEFT JOIN m USING (word)),
z AS (SELECT word, word AS root FROM f WHERE form IS NULL
      UNION ALL SELECT f.word, z.root FROM f JOIN z ON f.form = z.word)
SELECT word, form, root, n, n_near::BIGINT AS n_near, form_n FROM f JOIN z USING (word)"""


SQL = _sql()
