"""Quality rules: a learned decision list over interpretable text statistics.

The statistics come from one pass over the texts. Sequential covering on a bounded, hash-chosen
sample of labelled rows grows, at each step, a rule that rejects and one that keeps: conjunctions of
thresholds by information gain, pruned on rows held apart. The more precise of the two joins the list,
the rows that it covers leave, and the list ends when neither holds any more. The result is an ordered
list of rules of both verdicts, given as one Spark conditional expression over the statistics of all
documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualmart.llm.common import fresh, utf8

#: Labelled rows that the list is learned from, about; chosen by a hash of the id.
SAMPLE_ROWS = 20_000
#: A rule must hold for this share of the rows held apart that it covers.
MIN_PRECISION = 0.9
#: And cover at least so many of them.
MIN_COVER = 4
MAX_RULES = 24
MAX_CONDITIONS = 4
THRESHOLDS = 64
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
         "n_lines", "n_upper", "n_digits", "n_marks", "n_distinct", "n_doubled")
#: Interpretable ratios that rules may test, as SQL over the statistics.
FEATURES = {
    "words": "double(n_words)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbols_a_word": "n_symbols / greatest(n_words, 1)",
    "duplicate_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeated_words": "n_repeat_words / greatest(n_words, 1)",
    "upper_case": "n_upper / greatest(word_chars, 1)",
    "digits": "n_digits / greatest(word_chars, 1)",
    "marks_a_word": "n_marks / greatest(n_words, 1)",
    "distinct_words": "n_distinct / greatest(n_words, 1)",
    "doubled_words": "n_doubled / greatest(n_words, 1)",
}

_SPACE = np.array([32, *range(9, 14)])
_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
_MARKS = np.frombuffer(b"!?\"'()+,-./:;=@[\\]^_`{}~", np.uint8)


def text_stats(text: bytes) -> tuple[int, ...]:
    """The statistics of one whole text, in the order of ``STATS``."""
    words = text.split()  # of bytes: cuts at the six ASCII white-space characters alone
    n = len(words)
    if not n:
        return (0,) * 2 + (0,) * (len(STATS) - 2)
    of = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    chars = int(of[:128].sum() + of[192:].sum() - of[_SPACE].sum())
    lines = Counter(x for x in text.split(b"\n") if x and not x.isspace())
    repeated = 0
    if n >= 4:
        windows = list(zip(words, words[1:], words[2:], strict=False))
        times = Counter(windows)
        if len(times) < len(windows):
            twice = np.fromiter((times[w] > 1 for w in windows), bool, n - 2)
            inside = np.zeros(n, bool)
            for shift in range(3):
                inside[shift:n - 2 + shift] |= twice
            repeated = int(inside.sum())
    doubled = sum(map(bytes.__eq__, words, words[1:]))
    return (n, chars, int(of[_SYMBOLS].sum()), sum(lines.values()) - len(lines), repeated,
            sum(lines.values()), int(of[65:91].sum()), int(of[48:58].sum()), int(of[_MARKS].sum()),
            len(set(words)), doubled)


def with_stats(docs: DataFrame, name: str, *, carry: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``carry`` of ``docs`` plus a struct ``name`` of the statistics of each text. Null
    and wordless texts have zeros."""
    cols = list(dict.fromkeys([*carry, text_col]))
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in carry)
    fields = ", ".join(f"{s}: bigint" for s in STATS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = np.array([text_stats(t) for t in utf8(batch, text_col)], np.int64)
            stats = stats.reshape(-1, len(STATS)).T
            struct = pa.StructArray.from_arrays([pa.array(s) for s in stats], list(STATS))
            yield pa.RecordBatch.from_arrays([*(batch.column(cols.index(c)) for c in carry), struct],
                                             [*carry, name])

    return docs.select([F.col(f"`{c}`") for c in cols]).mapInArrow(
        run, f"{schema}, `{name}` struct<{fields}>")


@dataclass(frozen=True)
class Rule:
    """A conjunction of (feature, '<=' or '>', threshold) and the verdict on texts that it covers."""

    conditions: tuple[tuple[str, str, float], ...]
    keep: bool = False

    def covers(self, values: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(values.values()))), bool)
        for name, op, at in self.conditions:
            out &= values[name] <= at if op == "<=" else values[name] > at
        return out

    def column(self, stats: str) -> Column:
        out = F.lit(True)
        for name, op, at in self.conditions:
            value = F.expr(_of(stats, FEATURES[name]))
            out = out & (value <= F.lit(at) if op == "<=" else value > F.lit(at))
        return out


def _of(stats: str, sql: str) -> str:
    for s in STATS:
        sql = sql.replace(s, f"`{stats}`.{s}")
    return sql


def _entropy_gain(p: np.ndarray, n: np.ndarray, p0: int, n0: int) -> np.ndarray:
    gain = p * (np.log2(np.maximum(p, 1e-9) / np.maximum(p + n, 1e-9)) - np.log2(p0 / (p0 + n0)))
    return np.where(p > 0, gain, -1.0)


def grow(values: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Add the threshold that gains most until only rows of the wanted class (here ``bad``) are covered,
    or nothing is gained."""
    inside, conditions = np.ones(len(bad), bool), []
    while len(conditions) < MAX_CONDITIONS and (~bad[inside]).any() and bad[inside].any():
        best = (1e-9, None)
        p0, n0 = int(bad[inside].sum()), int((~bad[inside]).sum())
        for name, all_of in values.items():
            v, b = all_of[inside], bad[inside]
            order = np.argsort(v, kind="stable")
            v, b = v[order], b[order]
            ends = np.flatnonzero(np.diff(v) > 0)  # a threshold lies between two different values
            if not len(ends):
                continue
            if len(ends) > THRESHOLDS:
                ends = ends[np.unique(np.linspace(0, len(ends) - 1, THRESHOLDS).astype(int))]
            low_bad = np.cumsum(b)[ends]
            low_good = ends + 1 - low_bad
            for op, p, n in (("<=", low_bad, low_good), (">", p0 - low_bad, n0 - low_good)):
                gain = _entropy_gain(p, n, p0, n0)
                i = int(np.argmax(gain))
                if gain[i] > best[0]:
                    best = (gain[i], (name, op, float((v[ends[i]] + v[ends[i] + 1]) / 2)))
        if best[1] is None:
            break
        conditions.append(best[1])
        inside &= Rule((best[1],)).covers(values)
    return Rule(tuple(conditions))


def prune(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """The front part of the rule that does best, (p - n) / (p + n), on rows held apart."""
    def worth(k: int) -> tuple[float, int]:
        inside = Rule(rule.conditions[:k]).covers(values)
        p, n = int(bad[inside].sum()), int((~bad[inside]).sum())
        return ((p - n) / (p + n) if p + n else -1.0, -k)
    return Rule(rule.conditions[: max(range(1, len(rule.conditions) + 1), key=worth)])


def _best(values: dict[str, np.ndarray], bad: np.ndarray, apart: np.ndarray) -> Rule | None:
    """The better of a rule that rejects and one that keeps, by its precision on the rows held apart;
    None if neither covers and is right often enough there."""
    at = lambda m: {k: v[m] for k, v in values.items()}
    found = []
    for keep in (False, True):
        wanted = ~bad if keep else bad
        if not wanted[~apart].any() or wanted[~apart].all():
            continue
        rule = grow(at(~apart), wanted[~apart])
        if not rule.conditions:
            continue
        rule = prune(rule, at(apart), wanted[apart])
        inside = rule.covers(at(apart))
        p, n = int(wanted[apart][inside].sum()), int((~wanted[apart][inside]).sum())
        if p >= MIN_COVER and p >= MIN_PRECISION * (p + n):
            found.append((p / (p + n), not keep, Rule(rule.conditions, keep)))
    return max(found, key=lambda f: f[:2])[2] if found else None


def learn(values: dict[str, np.ndarray], bad: np.ndarray, apart: np.ndarray) -> list[Rule]:
    """Sequential covering for both verdicts: rows that a rule covers leave before the next is grown, so
    a rule speaks only of texts that the earlier ones leave undecided, and their order matters. What no
    rule covers is kept, unless all that is left is bad."""
    rules: list[Rule] = []
    while len(rules) < MAX_RULES and bad.any():
        if bad.all() and bad[apart].sum() >= MIN_COVER:
            return [*rules, Rule(())]
        rule = _best(values, bad, apart)
        if rule is None:
            break
        rules.append(rule)
        left = ~rule.covers(values)
        values, bad, apart = {k: v[left] for k, v in values.items()}, bad[left], apart[left]
    while rules and rules[-1].keep:  # the end of the list keeps anyway
        rules.pop()
    return rules


def learn_list(docs: DataFrame, labels: DataFrame, *, sample_rows: int = SAMPLE_ROWS,
               id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> list[Rule]:
    """The decision list for ``docs`` from labelled rows (label 0 is bad, null is no label; of
    repeated labels the smallest counts). About ``sample_rows`` labelled rows are used; their statistics
    are all that reaches the driver. No labels, or good ones alone, give no rules."""
    lab = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
                 .groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("label")))
    n = lab.count()
    parts = 1_000_000
    keep = lab.where(F.pmod(F.xxhash64("id"), F.lit(parts)) < int(parts * min(1.0, sample_rows / max(n, 1))))
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(keep), "id")
    found = sample.count()  # a label's id may have any number of rows
    if found > 2 * sample_rows:
        place = F.pmod(F.xxhash64("id", "text", F.lit(2)), F.lit(parts))
        sample = sample.where(place < int(parts * sample_rows / found))
    stats = with_stats(sample, "s", carry=["id", "label"])
    rows = stats.select((F.col("label") == 0).alias("bad"),
                        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(3)) == 0).alias("apart"),
                        F.col("s.n_words").alias("n"), F.col("s.n_repeat_words").alias("r"),
                        *[F.expr(_of("s", f)).alias(k) for k, f in FEATURES.items()]).toPandas()
    # the base checks come first in the list, so rules are learned from the rows that pass them
    rows = rows[~((rows["n"] < MIN_WORDS) | (100 * rows["r"] > MAX_REPEAT_PERCENT * rows["n"]))]
    if rows.empty:
        return []
    return learn({k: rows[k].to_numpy(float) for k in FEATURES}, rows["bad"].to_numpy(bool),
                 rows["apart"].to_numpy(bool))


def base_failed(stats: str) -> Column:
    """Too few words, or too many words in repeated 3-word windows."""
    return F.expr(_of(stats, f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"))


def verdict(rules: list[Rule], stats: str) -> Column:
    """True if the text is kept: the first rule that covers it decides; without one it is kept."""
    out = F.when(base_failed(stats), F.lit(False))
    for rule in rules:
        out = out.when(rule.column(stats), F.lit(rule.keep))
    return out.otherwise(F.lit(True))


def judged(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
           **options) -> DataFrame:
    """``doc_id``, ``n_words``, the base statistics, ``base_failed`` and ``kept`` of every row.

    Null, empty and blank texts have no words and fail the base check. Repeated rows get the same
    verdict each. Other columns aren't read. An empty table gives an empty result."""
    rules = learn_list(docs, labels, id_col=id_col, text_col=text_col, **options)
    out = with_stats(docs, "stats", carry=[id_col], text_col=text_col)
    return out.select(F.col(id_col).alias("doc_id"), *[f"stats.{s}" for s in STATS[:5]],
                      base_failed("stats").alias("base_failed"), verdict(rules, "stats").alias("kept"))


def kept_documents(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id",
                   text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that the decision list keeps, with all their columns."""
    rules = learn_list(docs, labels, id_col=id_col, text_col=text_col, **options)
    name = fresh(docs.columns, "stats")
    out = with_stats(docs, name, carry=docs.columns, text_col=text_col)
    return out.where(verdict(rules, name)).select([F.col(f"`{c}`") for c in docs.columns])
