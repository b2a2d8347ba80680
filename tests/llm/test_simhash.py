import random

import numpy as np
import xxhash

from qualmart.llm import simhash as S


def brute_fp(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        low = low.replace(c, " ")
    w = [x for x in low.split(" ") if x]
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps):
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                parent[find(i)] = find(j)
    return [min(ids[j] for j in range(len(ids)) if find(j) == find(i)) for i in range(len(ids))]


def check(docs, **options):
    rows = docs.select("doc_id", "text").collect()
    fps = [brute_fp(r.text) for r in rows]
    want = sorted(zip([r.doc_id for r in rows], fps, brute_components([r.doc_id for r in rows], fps), strict=True))
    got = S.near_duplicates(docs, **options).collect()
    assert sorted((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in got) == want


def test_odd_texts_repeated_rows_and_clashing_names(make, odd_texts):
    rows = [(i + 5, t) for i, t in enumerate(odd_texts)]
    check(make(rows + rows[3:6], extra=["fp", "component_id", "node"]))


def test_near_copies(make):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(500)]
    rows = []
    for g in range(40):
        base = [rng.choice(vocab) for _ in range(300)]
        for _ in range(rng.randrange(1, 8)):
            t = list(base)
            for _ in range(rng.randrange(3)):
                t[rng.randrange(len(t))] = rng.choice(vocab)
            rows.append((len(rows), " ".join(t)))
    check(make(rows))


def test_hot_buckets_are_refined_without_losing_links(spark):
    rng = random.Random(2)
    base = rng.getrandbits(64)
    fps = {base}
    while len(fps) < 700:  # all share most bits, so buckets overflow at every level
        x = rng.choice(sorted(fps)) if len(fps) % 3 else base
        for _ in range(rng.randrange(1, 6)):
            x ^= 1 << rng.choice([1, 2, 3, 17, 18, 33, 40, 50, 51, 62])
        fps.add(x)
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(3)
    for bucket in (8, 100, 10_000):
        got = {r.node: r.root for r in S.components(S.links(df, 2, bucket)).collect()}
        want = brute_components(signed, [x & (1 << 64) - 1 for x in signed])
        assert [got.get(x, x) for x in signed] == want


def test_bit_sliced_distances():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 500, dtype=np.uint64)
    b = a.copy()
    for i in range(500):
        for bit in rng.choice(64, rng.integers(0, 6), replace=False):
            b[i] ^= np.uint64(1) << np.uint64(bit)
    dist = np.array([(int(x) ^ int(y)).bit_count() for x, y in zip(a, b, strict=True)])
    for radius in (1, 2, 3, 4):
        assert (S.pairs_within(a, b, radius) == (dist <= radius)).all()
    for masks in S.slots(2):
        assert all((m).bit_count() >= 32 for m in masks)


def test_null_ids_and_empty_table(make):
    got = S.near_duplicates(make([(None, "a b c"), (4, "a b c"), (None, "x y z w")])).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in got) == [
        ("4", "4"), ("None", "4"), ("None", "None")]
    assert S.near_duplicates(make([])).count() == 0
