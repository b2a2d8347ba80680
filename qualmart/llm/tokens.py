"""Token counts of whole texts with the whole-token shortcut.

Offline, each vocabulary string is encoded alone; those that are one pre-token and come out as one
token are proven to count 1. A text is cut into pre-tokens; proven ones are counted directly and
only the others go through the merge table, once for each distinct pre-token that a worker's
bounded memo doesn't hold.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

#: Entries of a worker's memo; a full memo starts anew from the proven strings.
MEMO = 500_000
#: Longer pre-tokens are merged but not remembered.
MEMO_CHARS = 64
OVER = 1024


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1
    characters stand for themselves, the other bytes for the code points from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, extra = [], 256
    for b in range(256):
        out.append(chr(b if b in plain else extra))
        extra += b not in plain
    return out


def check_definition(definition: str) -> None:
    """Refuse vocabularies whose counts the shortcut doesn't follow: it splits at added tokens as they
    stand, pre-tokenizes by a pattern and merges bytes."""
    d = json.loads(definition)
    model, pre = d["model"], d.get("pre_tokenizer") or {}
    wrong = [f"{k} of the added token {t['content']!r}" for t in d["added_tokens"]
             for k in ("single_word", "lstrip", "rstrip", "normalized") if t.get(k)]
    wrong += [k for k in ("normalizer", "truncation", "padding", "post_processor") if d.get(k)]
    wrong += [f"model {k}" for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback",
                                     "ignore_merges") if model.get(k)]
    if model["type"] != "BPE":
        wrong.append(f"model type {model['type']}")
    if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space"):
        wrong.append("pre_tokenizer")
    if wrong:
        raise ValueError("vocabulary not supported: " + ", ".join(wrong))


class Counter(dict):
    """Pre-token -> its number of tokens; unknown ones are merged on first use."""

    def __init__(self, definition: str, proven: list[str], pattern: str):
        from tokenizers import Tokenizer

        self._model = Tokenizer.from_str(definition).model
        self._special = [t["content"] for t in json.loads(definition)["added_tokens"]]
        self._split = regex.compile("|".join(map(regex.escape, self._special)) or r"(?!)")
        self._cut = regex.compile(pattern).findall
        self._to = byte_alphabet()
        self._proven = dict.fromkeys(proven, 1)
        super().__init__(self._proven)

    def merge(self, token: str) -> int:
        return len(self._model.tokenize("".join(map(self._to.__getitem__, token.encode()))))

    def __missing__(self, token: str) -> int:
        n = self.merge(token)
        if len(token) <= MEMO_CHARS:
            if len(self) >= MEMO + len(self._proven):
                self.clear()
                self.update(self._proven)
            self[token] = n
        return n

    def count(self, text: str) -> int:
        parts = self._split.split(text)
        return len(parts) - 1 + sum(sum(map(self.__getitem__, self._cut(p))) for p in parts)


def prove(definition: str, pattern: str) -> list[str]:
    """The vocabulary strings that, encoded alone, are one pre-token and one token."""
    counter = Counter(definition, [], pattern)
    back = {c: b for b, c in enumerate(byte_alphabet())}
    out = []
    for piece in json.loads(definition)["model"]["vocab"]:
        try:
            text = bytes(back[c] for c in piece).decode()
        except (KeyError, UnicodeDecodeError):
            continue  # part of a character: never a pre-token of its own
        if counter._cut(text) == [text] and counter.merge(text) == 1:
            out.append(text)
    return out


def token_counts(docs: DataFrame, tokenizer_path: str, pattern: str, *, id_col: str = "doc_id",
                 text_col: str = "text", over: int = OVER) -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` of every whole text.

    A null or empty text has 0 bytes and 0 tokens. Added tokens inside a text count one each, as
    the library's default has it. Repeated rows give repeated rows; other columns are not read. The
    vocabulary file (a fixed size of about 2 MB) is read on the driver and broadcast; one with a
    normalizer, other added tokens or another model than this counts raises ValueError.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()
    check_definition(definition)
    spec = docs.sparkSession.sparkContext.broadcast((definition, prove(definition, pattern), pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(*spec.value)
        for batch in batches:
            texts = batch.column(1)
            n = pa.array([counter.count(t) if t else 0 for t in texts.to_pylist()], pa.int64())
            size = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), size, n, pc.greater(n, over)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
