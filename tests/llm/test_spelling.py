import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from qualmart.llm import spelling as S

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def count(rows):
    """Words of (doc_id, text) rows by the rule, word for word."""
    out = Counter()
    for i, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{i}:{w}".encode())
            if i is not None and h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            out[w] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, old[j] + 1, old[j - 1] + (x != y)))
    return row[-1]


def brute(words):
    """Expected rows for a dict of words and counts: every pair is compared."""
    by_size = {}
    for w in words:
        by_size.setdefault(len(w), []).append(w)
    near = {w: [v for k in (-1, 0, 1) for v in by_size.get(len(w) + k, ())
                if len(set(w) ^ set(v)) < 3 and edits(w, v) == 1] for w in words}
    form = {}
    for w, ns in near.items():
        top = min(ns, key=lambda v: (-words[v], v), default=None)
        form[w] = top if top is not None and words[top] >= 2 * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return sorted((w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items())


def rows_of(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()))


def corpus(seed, docs, size):
    """Documents over a vocabulary of syllable words, their misspellings and anagrams."""
    r = random.Random(seed)
    parts = ["n", "ré", "t", "l", "a", "e", "ß", "É", "an", "o", "er"]
    vocabulary = ["".join(r.choice(parts) for _ in range(r.randrange(4, 7))) for _ in range(size)]
    weights = [1 / (k + 1) for k in range(size)]
    return [(i, " ".join(r.choices(vocabulary, weights, k=120)) + ".") for i in range(docs)]


@pytest.mark.parametrize("node, groups", [(4096, 16), (40, 16), (3, 4)])
def test_matches_brute_force_at_every_shard_size(make, odd_texts, node, groups):
    rows = [(i, t) for i, t in enumerate(odd_texts[:-2])] + [(100 + i, t) for i, t in corpus(1, 60, 500)]
    rows += [(None, "Unnamed words here words here unnamed unnamed here words"), (None, None)] + rows[20:24]
    docs = make(rows, extra=["word", "n", "shard", "N_near"])
    want = brute(count(rows))
    assert len(want) > 200 and sum(r[1] is not None for r in want) > 10
    assert rows_of(S.variants(docs.repartition(3), node=node, groups=groups)) == want


def test_equal_vectors_beyond_a_shard(make):
    """All words are anagrams of each other or near one, more of them than a shard takes."""
    r = random.Random(3)
    words = sorted({"".join(r.sample("abcdefg", 7)) for _ in range(150)} | {"abcdef", "abcdefgg", "abcdefx"})
    rows = [(None, " ".join([w] * (3 + k % 5))) for k, w in enumerate(words)]
    assert rows_of(S.variants(make(rows), node=10, groups=4)) == brute(count(rows))


def test_long_words(make):
    long = "ab" * 60
    words = [long, long + "a", long[1:], long[:50] + "x" + long[51:], long[:50] + "yy" + long[52:], "é" * 70, "é" * 71,
             "q" * 600, "q" * 601]
    rows = [(None, " ".join([w] * (3 + 4 * k))) for k, w in enumerate(words)]
    rows += [(i, " ".join(words * 3)) for i in range(97)]
    assert rows_of(S.variants(make(rows), groups=5)) == brute(count(rows))


def test_chains_lead_to_the_last_form(make):
    chain = ["aaaaaaaaaa" + "b" * k for k in range(8)]
    rows = [(None, " ".join([w] * (3 * 2 ** k))) for k, w in enumerate(chain)]
    got = rows_of(S.variants(make(rows)))
    assert got == brute(count(rows)) and {r[2] for r in got} == {chain[-1]}


def test_empty_tables(make):
    assert rows_of(S.variants(make([]))) == rows_of(S.variants(make([(1, None), (2, "too few")]))) == []


def test_one_table_or_many(make):
    rows = corpus(5, 40, 300)
    docs = make(rows)
    want = sorted(count(rows).items())
    assert sorted(map(tuple, S.counted_words(docs.repartition(1)).collect())) == want
    assert sorted(map(tuple, S.counted_words(docs.repartition(7)).collect())) == want


def test_sql_gives_the_same(make):
    rows = corpus(9, 50, 400)
    docs = make(rows)
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    res = con.execute(S.SQL)
    at = [[c[0] for c in res.description].index(c) for c in COLUMNS]
    assert sorted(tuple(r[i] for i in at) for r in res.fetchall()) == rows_of(S.variants(docs)) == brute(count(rows))


def test_crc_of_parts():
    r = random.Random(2)
    prefix = [f"{r.randrange(10 ** 9)}:" for _ in range(500)]
    word = ["".join(r.choice("abcé") for _ in range(r.randrange(1, 30))) for _ in range(500)]
    raw = [w.encode() for w in word]
    got = S._Shifts().crc(np.array([zlib.crc32(p.encode()) for p in prefix], np.uint32),
                          np.array([zlib.crc32(w) for w in raw], np.uint32), np.array([len(w) for w in raw]))
    assert got.tolist() == [zlib.crc32((p + w).encode()) for p, w in zip(prefix, word, strict=True)]
