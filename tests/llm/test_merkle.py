import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from qualmart.llm import merkle as M

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(values):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(level):
    """Root of a list of digests, and for each of them its (before, after) per level."""
    paths = [[] for _ in level]
    owner = [[i] for i in range(len(level))]
    while len(level) > 1:
        up, held = [], []
        for at in range(0, len(level), 16):
            run = level[at:at + 16]
            for j, own in enumerate(owner[at:at + 16]):
                for i in own:
                    paths[i].append(("".join(run[:j]), "".join(run[j + 1:])))
            up.append(digest(*run))
            held.append([i for own in owner[at:at + 16] for i in own])
        level, owner = up, held
    return level[0], paths


def brute(rows):
    """Expected result of op11 for (doc_id, source, lang, n_chars, text) rows."""
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append(r)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in order:
        group = sorted(by_source[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees.append((group, *climb([leaf_of(r) for r in group])))
    root, above = climb([t[1] for t in trees])
    out = []
    for (group, subroot, paths), top in zip(trees, above, strict=True):
        for r, path in zip(group, paths, strict=True):
            now = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                now = (*r[:4], r[4].translate(LOWER))
            f = leaf_of(now)
            for before, after in path + top:
                f = digest(before, f, after)
            out.append((r[0], leaf_of(r), subroot, root, digest(*[b + a for b, a in path + top]), f, f == root))
    return sorted(out, key=str)


def rows_in(docs):
    return [tuple(r) for r in docs.select(*M.COLUMNS).collect()]


def query(docs):
    out = M.verified(docs, F.crc32(F.col("doc_id").cast("string")) % 5 == 0,
                     tampered={"text": M.lowered(F.col("text"))})
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, out.collect()), key=str)


def test_matches_brute_force(make, odd_texts):
    rows = [(i, t, "hot") for i, t in enumerate(odd_texts)]
    rows += [(100 + i, f"Text {i} Of MANY", "hot" if i % 3 else ["", "b", "é", None][i % 4]) for i in range(700)]
    rows += [(5000, "alone", "single"), (None, "no id", "hot"), (None, None, "b"), (101, "other Text", "hot")]
    rows += [(6000 + i, "X", "seventeen") for i in range(17)]
    rows += rows[20:23]
    docs = make(rows, extra=["changed", "digest", "rank", "has", "name", "GROUP"])
    got = query(docs)
    assert got == brute(rows_in(docs))
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("n", [0, 1, 2, 16, 17])
def test_small_tables(make, n):
    docs = make([(i, f"T{i}", "a") for i in range(n)])
    assert query(docs) == (brute(rows_in(docs)) if n else [])


def test_sql_gives_the_same(make, odd_texts):
    docs = make([(i * 7, t, ["a", None, "ß"][i % 3]) for i, t in enumerate(odd_texts)]
                + [(1000 + i, f"Word {i}", "a") for i in range(300)])
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    res = con.execute(M.SQL)
    at = [[c[0] for c in res.description].index(c) for c in
          ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")]
    assert sorted([tuple(r[i] for i in at) for r in res.fetchall()], key=str) == query(docs)


def built(docs):
    return M.manifest(docs, group=F.col("source"), order=F.col("doc_id"),
                      digest=M.leaf_digest(*[F.col(c) for c in M.COLUMNS]),
                      payload=F.struct(F.col("doc_id").alias("id")))


def test_some_requests_and_the_store(make):
    docs = make([(i, f"t {i}", "ab"[i % 5 == 0]) for i in range(900)])
    m = built(docs)
    ask = m.leaves.where("payload.id % 97 = 0")
    some = {r.payload.id: r.path for r in M.proofs(m, ask).collect()}
    every = {r.payload.id: r.path for r in M.proofs(m).collect()}
    assert len(some) == 10 and len(every) == 900 and some == {i: every[i] for i in some}
    # every record's key is its content's digest, and every digest but the root is some record's child
    store = {bytes(r.digest): bytes(r.children) for r in m.store().collect()}
    assert all(hashlib.sha256(c.hex().encode()).digest() == d for d, c in store.items())
    children = {c[i:i + 32] for c in store.values() for i in range(0, len(c), 32)}
    assert len(store.keys() - children) == 1


def test_equal_subtrees_share_a_record(make):
    docs = make([(1, "same", "a")] * 64 + [(2, "b", "b")])
    m = built(docs)
    assert m.store().count() == 3  # sixteen equal leaves, four equal runs, the root
    got = query(docs)
    assert got == brute(rows_in(docs)) and len(got) == 65
