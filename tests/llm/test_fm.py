import random
import zlib

import numpy as np

from qualmart.llm import fm as M


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def corpus(n=1200):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(n):
        w = [rng.choice(vocab) for _ in range(rng.randrange(40, 160))]
        bad = rng.random() < 0.3
        if bad:
            w = [x.upper() + "!!" for x in w] if rng.random() < 0.5 else [w[0]] * len(w)
        docs.append((i, " ".join(w)))
        labels.append((i, int(not bad), 0))
    return docs, labels


def test_held_out_accuracy(make, spark):
    docs, labels = corpus()
    extra = [(9000, None), (9001, ""), (9001, ""), (None, "x y z")]
    out = M.quality(make(docs + extra, extra=["score", "predicted"]), labels_of(spark, labels)).collect()
    assert len(out) == len(docs) + 4
    truth = {i: q for i, q, _ in labels}
    for r in out:
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert len(held) > 200 and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97


def test_held_out_labels_and_other_columns_have_no_say(make, spark):
    docs, labels = corpus(400)
    flipped = [(i, q if zlib.crc32(str(i).encode()) % 4 != 2 else 1 - q, 1) for i, q, _ in labels]
    a = M.quality(make(docs), labels_of(spark, labels))
    b = M.quality(make([(*d, f"s{d[0]}") for d in docs]), labels_of(spark, flipped))
    assert {r.doc_id: r.score for r in a.collect()} == {r.doc_id: r.score for r in b.collect()}


def test_sum_of_squares_identity():
    rng = np.random.default_rng(0)
    x = M.features([b"a b c a", b"", b"x " * 70], np.array([7.0, 0.0, 140.0]))
    size = M.BUCKETS + M.N_DENSE
    m = M.Machine(np.array([0.3]), rng.normal(size=size), rng.normal(size=(size, M.RANK)))
    for row, logit in enumerate(m.forward(x)[0]):
        at = slice(x.start[row], x.start[row + 1])
        i, v = x.index[at], x.value[at].astype(float)
        pairs = sum(m.v[i[a]] @ m.v[i[b]] * v[a] * v[b] for a in range(len(i)) for b in range(a))
        assert abs(logit - (0.3 + m.w[i] @ v + pairs)) < 1e-3


def test_one_class_no_labels_and_empty_table(make, spark):
    docs, labels = corpus(60)
    one = M.quality(make(docs), labels_of(spark, [(i, 1, 0) for i, _, _ in labels])).collect()
    assert len({r.score for r in one}) == 1 and one[0].score > 0.9
    assert {r.score for r in M.quality(make(docs), labels_of(spark, [])).collect()} == {0.5}
    assert M.quality(make([]), labels_of(spark, [])).count() == 0


def test_text_ids_and_no_length_column(make, spark):
    from pyspark.sql import functions as F
    docs, labels = corpus(600)
    named = make(docs + [(None, "x")]).select(F.concat(F.lit("doc-"), "doc_id").alias("doc_id"), "text")
    lab = labels_of(spark, labels).withColumn("doc_id", F.concat(F.lit("doc-"), "doc_id"))
    out = M.quality(named, lab).collect()
    truth = {f"doc-{i}": q for i, q, _ in labels}
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert len(out) == 601 and len(held) > 80 and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95


def test_odd_and_very_long_texts(make, spark, odd_texts):
    docs, labels = corpus(300)
    out = M.quality(make(docs + [(1000 + i, t) for i, t in enumerate(odd_texts)]), labels_of(spark, labels)).collect()
    assert len(out) == 300 + len(odd_texts) and all(0 <= r.score <= 1 for r in out)


def test_a_label_with_many_rows_keeps_the_sample_bounded(make, spark, monkeypatch):
    docs, labels = corpus(300)
    rows = []
    train = M.train
    monkeypatch.setattr(M, "train", lambda x, y: (rows.append(len(y)), train(x, y))[1])
    many = make(docs + [(1, f"{docs[1][1]} copy {k}") for k in range(3000)])
    M.learn(many, labels_of(spark, labels), sample_rows=300)
    assert rows[0] < 700
