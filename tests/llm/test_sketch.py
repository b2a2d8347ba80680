import hashlib
import random

import duckdb
import numpy as np
import pytest
import xxhash

from qualmart.llm import sketch as S

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def hashes(text):
    """All shingle hashes, by plain integers."""
    words = [w for w in text.translate(LOWER).replace("\t", " ").replace("\n", " ").replace("\r", " ")
             .replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    h = [int(hashlib.md5(w.encode()).hexdigest()[:16], 16) for w in words]
    runs = [h[i:i + 5] for i in range(max(1, len(h) - 4))] if h else []
    return {sum(x * S.BASE ** j for j, x in enumerate(run)) % 2 ** 64 for run in runs}


def brute_sketch(text):
    every = hashes(text)
    return {x for x in every if x < 2 ** 64 // 8} or ({min(every)} if every else set())


def alike(a, b):
    return float(a == b) if not a or not b else len(a & b) / min(len(a), len(b))


def brute(rows):
    """Expected rows of ``edited`` for (doc_id, text) rows."""
    line = sorted(((i, t or "") for i, t in rows), reverse=True, key=lambda r: (
        r[0] is not None, r[0] or 0, np.uint64(xxhash.xxh64_intdigest(r[1].encode(), 42)).astype(np.int64)))
    show = lambda s: "".join(f"{x:016x}" for x in sorted(s))
    out = []
    for at, (i, t) in enumerate(line):
        after = line[(at + 1) % len(line)][1]
        cut = len(t) // 3
        edited = t[:len(t) - cut] + after[:cut]
        a, b, c = brute_sketch(t), brute_sketch(edited), brute_sketch(after)
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), show(a), show(b), alike(a, b), alike(a, c)))
    return sorted(out, key=str)


def rows_of(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=str)


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(5000)}" for _ in range(n))


def test_matches_brute_force_however_the_rows_lie(make, odd_texts):
    rows = [(3 * i, t) for i, t in enumerate(odd_texts)] + [(1000 + i, prose(i, i)) for i in range(120)]
    rows += [(None, "no id"), (None, None), (None, prose(1, 60)), (1005, prose(7, 30)), (1005, prose(8, 30))]
    rows += rows[20:24] + [(1010, prose(10, 10))] * 5
    docs = make(rows, extra=["part", "leads", "h", "body", "ID"])
    want = brute(rows)
    assert rows_of(S.edited(docs.repartition(1), ranges=1)) == want
    assert rows_of(S.edited(docs.repartition(3), ranges=40)) == want
    assert rows_of(S.edited(docs.repartition(8))) == want


@pytest.mark.parametrize("n", [0, 1, 2])
def test_small_tables(make, n):
    rows = [(i, f"Some short text number {i}") for i in range(n)]
    assert rows_of(S.edited(make(rows))) == (brute(rows) if n else [])


def test_equal_rows_only(make):
    rows = [(7, "one two three four five six seven")] * 9 + [(None, None)] * 4
    assert rows_of(S.edited(make(rows), ranges=4)) == brute(rows)


def test_equal_rows_are_spread(make):
    from pyspark.sql import functions as F
    rows = [(None, "the same words in every one of these rows")] * 400 + [(i, prose(i, 12)) for i in range(200)]
    random.Random(3).shuffle(rows)
    got = S.edited(make(rows).repartition(5), ranges=8)
    assert rows_of(got) == brute(rows)
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 3 and max(sizes) < 200   # one range ends with the frequent row


def test_sql_gives_the_same(make, odd_texts):
    rows = [(i, t) for i, t in enumerate(odd_texts[:-2])] + [(100 + i, prose(i, 3 * i)) for i in range(60)]
    docs = make(rows)
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    res = con.execute(S.SQL)
    at = [[c[0] for c in res.description].index(c) for c in COLUMNS]
    got = sorted([tuple(r[i] for i in at) for r in res.fetchall()], key=str)
    assert got == rows_of(S.edited(docs)) == brute(rows)


def test_containment_between_unequal_documents():
    long, other = prose(1, 20_000).split(), prose(2, 20_000).encode()
    whole = S.sketch(" ".join(long).encode())
    for n in (300, 1000, 4000):
        part = " ".join(long[500:500 + n])
        assert S.likeness(S.sketch(part.encode()), whole) == 1.0
        half = S.sketch((part + " " + prose(3, n)).encode())
        assert S.likeness(half, whole) == pytest.approx(0.5, abs=4 * (0.25 / (n / 4)) ** 0.5)
        assert S.likeness(S.sketch(part.encode()), S.sketch(other)) == 0


def test_merge_is_the_union_of_the_shingles():
    for seed in range(40):
        texts = [prose(seed * 10 + i, random.Random(seed + i).randrange(0, 25)) for i in range(3)]
        every = set().union(*map(hashes, texts))
        want = {x for x in every if x < 2 ** 64 // 8} or ({min(every)} if every else set())
        assert set(map(int, S.merge(*[S.sketch(t.encode()) for t in texts]))) == want


def test_fingerprints_of_equal_texts_are_equal(make, odd_texts):
    docs = make([(i, t) for i, t in enumerate(odd_texts)] + [(90, odd_texts[5])])
    got = {r.doc_id: r.hashes for r in S.fingerprints(docs).collect()}
    assert got[90] == got[5] == got[7] and got[0] == got[1] == got[2] == []
