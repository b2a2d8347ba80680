import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from qualmart.llm import decontam as D
from qualmart.llm.fmindex import FMIndex, suffix_array


def bench_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def oracle(docs, bench):
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": pa.array([d[0] for d in docs], pa.int64()),
                                        "text": pa.array([d[1] for d in docs], pa.string())}))
    con.register("benchmark", pa.table({"item_id": pa.array([b[0] for b in bench], pa.int64()),
                                        "text": pa.array([b[1] for b in bench], pa.string())}))
    return sorted(con.execute(D.SQL).fetchall(), key=str)


@pytest.mark.parametrize("options", [{}, {"block_bytes": 400, "shard_words": 500}])
def test_matches_sql(make, spark, odd_texts, options):
    rng = random.Random(6)
    vocab = "the of a be to in é x1 zz".split()
    bench = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randrange(0, 16)))) for i in range(40)]
    bench += [(50, None), (None, "the, of THE of the of the of the of the of"), (3, bench[3][1]), (60, "one")]
    docs = [(i, t) for i, t in enumerate(odd_texts) if t is None or len(t) < 9000]
    docs += [(100 + i, " ".join(rng.choice(vocab) for _ in range(rng.randrange(120)))) for i in range(150)]
    docs += [(400 + i, f"Intro. {rng.choice(bench)[1] or ''}!! {rng.choice(vocab)} tail") for i in range(40)]
    docs += docs[5:9] + [(None, "one")]
    got = D.contamination(make(docs, extra=["found", "items", "n_hit"]), bench_of(spark, bench), **options)
    assert sorted((tuple(r)[:6] for r in got.collect()), key=str) == oracle(docs, bench)


def test_removal(make, spark):
    p = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    nested = "keep alpha beta gamma delta epsilon " + p.upper() + " zeta eta theta iota kappa lambda stay"
    docs = [(1, f"Before it, {p}! After."), (2, "clean text here"), (3, p), (4, None), (5, nested), (6, "")]
    out = {r.doc_id: r for r in D.decontaminated(make(docs, extra=["found"]), bench_of(spark, [(1, p)])).collect()}
    assert sorted(out) == [1, 2, 4, 5, 6]
    assert out[1].text.split() == ["Before", "it,", "!", "After."] and out[1].n_chars == len(out[1].text)
    assert out[5].text.split()[0] == "keep" and out[5].text.split()[-1] == "stay" and "kappa" not in out[5].text
    assert (out[2].text, out[4].text, out[6].text, out[2].found) == ("clean text here", None, "", 7)


def test_removal_does_not_depend_on_the_blocks(make, spark):
    rng = random.Random(5)
    w = [f"w{i}" for i in range(60)]
    bench = [(i, " ".join(w[i:i + 14])) for i in range(0, 46, 4)]  # items that share passages
    docs = [(i, f"start {' '.join(w[rng.randrange(20):rng.randrange(35, 60)])} end {i}") for i in range(30)]
    docs += [(50 + i, " ".join(["keep", *w[2:6 + i], *w[20:40], *w[6 + i:16], "stay"])) for i in range(4)]  # brought together
    docs += [(70, " ".join(w[:58])), (71, None), (72, "clean text"), (72, "clean text"), (None, " ".join(["x", *w[8:30]]))]
    frame, items = make(docs, extra=["found", "spans"]).repartition(3), bench_of(spark, bench)

    def rows(out):
        assert out.columns == frame.columns
        return sorted(map(tuple, out.collect()), key=str)
    whole = rows(D.decontaminated(frame, items))
    out = D.decontaminated(frame, items, block_bytes=150, shard_words=300)
    assert D.n_blocks(items, "item_id", "text", 150) > 3
    assert rows(out) == whole and len(whole) == len(docs) - 1
    assert D.contamination(out, items).where("contaminated").count() == 0


def test_empty_tables(make, spark):
    assert D.contamination(make([]), bench_of(spark, [(1, "a b")])).count() == 0
    r = D.contamination(make([(1, "a b")]), bench_of(spark, [])).first()
    assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (2, 0, 0, False)


def test_index_against_plain_search():
    rng = np.random.default_rng(2)
    for sigma in (1, 2, 5, 40):
        text = rng.integers(0, sigma + 1, 700)
        text[100:200] = text[300:400]
        text = np.concatenate((text, [0]))
        rank_of_sep = np.cumsum(text == 0)
        key = [[(0, rank_of_sep[j]) if text[j] == 0 else (1, text[j]) for j in range(i, min(i + 150, 701))]
               for i in range(701)]
        assert suffix_array(text).tolist() == sorted(range(701), key=lambda i: key[i])
        index = FMIndex(text, sigma, sample=8)
        for length in (1, 2, 3, 6):
            phrases = rng.integers(1, sigma + 1, (30, length))
            low, high = index.search(phrases)
            for p, a, b in zip(phrases, low, high, strict=True):
                want = [i for i in range(701 - length) if (text[i:i + length] == p).all()]
                assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_many_blocks_are_one_stage_without_driver_tables(make, spark, monkeypatch):
    rng = random.Random(7)
    bench = [(i, " ".join(f"w{rng.randrange(400)}" for _ in range(20))) for i in range(200)]
    docs = [(i, f"a b {bench[i * 5][1]} c") for i in range(40)] + [(100, "clean")]
    size = sum(len(t) + 16 for _, t in bench)
    built = []
    monkeypatch.setattr(D, "_Broadcast", lambda *a: built.append(a))    # the driver makes no table
    out = D.contamination(make(docs), bench_of(spark, bench), block_bytes=size // 16, shard_words=200)
    assert D.n_blocks(bench_of(spark, bench), "item_id", "text", size // 16) >= 16 and not built
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    got = {r.doc_id: (r.n_hit, r.n_items) for r in out.collect()}
    assert got.pop(100) == (0, 0) and all(n == 20 and k >= 1 for n, k in got.values())
