import random

import numpy as np

from qualmart.llm import rules as R


def brute(text):
    text = text or ""
    for c in "\t\v\f\r":
        text = text.replace(c, " ")
    w = [x for x in text.replace("\n", " ").split(" ") if x]
    wins = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    inside = {i + k for i, x in enumerate(wins) if wins.count(x) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if x.strip(" ")]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(inside)


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def corpus(rng, n=900):
    vocab = [f"w{i}" for i in range(400)]
    docs, labels = [], []
    for i in range(n):
        w = [rng.choice(vocab) for _ in range(rng.randrange(60, 200))]
        bad = i % 5 == 0
        if bad:
            w = [x + rng.choice(["###", "%%%", "|"]) if rng.random() < 0.7 else x for x in w]
        docs.append((i, " ".join(w)))
        labels.append((i, int(not bad), 0))
    return docs, labels


def test_base_statistics_match_brute_force(make, odd_texts, spark):
    rng = random.Random(4)
    texts = [t for t in odd_texts if t is None or len(t) < 10_000]
    texts += ["\n".join(" ".join(rng.choice("ab#c|") * rng.randrange(1, 3) for _ in range(rng.randrange(9)))
                        for _ in range(rng.randrange(12))) for _ in range(120)]
    docs = make(list(enumerate(texts)) + [(1, texts[1])], extra=["n_words", "stats", "kept"])
    got = R.judged(docs, labels_of(spark, [(0, 0, 0), (None, 1, 0), (3, None, 0)])).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        n, chars, symbols, dup, rep = brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, rep)
        assert r.base_failed == (n < 50 or 100 * rep > 50 * n) and not (r.base_failed and r.kept)


def test_learned_list_generalises_and_filters(make, spark):
    docs, labels = corpus(random.Random(1))
    fresh_docs, fresh_labels = corpus(random.Random(2))
    rules = R.learn_list(make(docs), labels_of(spark, labels))
    assert 1 <= len(rules) <= 3
    unseen = R.with_stats(make(fresh_docs, extra=["stats"]), "stats_", carry=["doc_id"])
    kept = {r[0]: r[1] for r in unseen.select("doc_id", R.verdict(rules, "stats_")).collect()}
    assert all(kept[i] == bool(q) for i, q, _ in fresh_labels)
    left = R.kept_documents(make(docs, extra=["stats"]), labels_of(spark, labels))
    assert left.columns[-1] == "stats" and left.count() == sum(q for _, q, _ in labels)


def test_no_rule_without_evidence():
    rng = np.random.default_rng(0)
    values = {"a": rng.random(600), "b": rng.random(600)}
    assert R.learn(values, rng.random(600) < 0.2, rng.random(600) < 0.3) == []
    assert R.learn(values, np.zeros(600, bool), rng.random(600) < 0.3) == []


def test_pruning_drops_conditions_that_do_not_hold():
    rng = np.random.default_rng(1)
    x = rng.random(900)
    rule = R.Rule((("x", ">", 0.8), ("y", "<=", 0.1)))
    assert R.prune(rule, {"x": x, "y": rng.random(900)}, x > 0.8).conditions == (("x", ">", 0.8),)


def test_empty_tables(make, spark):
    assert R.judged(make([]), labels_of(spark, [])).count() == 0
    assert R.judged(make([(1, "a " * 60)]), labels_of(spark, [])).first().base_failed


def verdicts(rules, values):
    out = np.ones(len(next(iter(values.values()))), bool)
    free = out.copy()
    for rule in rules:
        hit = rule.covers(values) & free
        out[hit], free = rule.keep, free & ~hit
    return out


def test_both_verdicts_in_order():
    rng = np.random.default_rng(5)
    values = {"x": rng.random(4000), "y": rng.random(4000)}
    apart = rng.random(4000) < 0.3
    corner = (values["x"] > 0.5) & (values["y"] > 0.5)   # good in one corner only: no conjunction covers the rest
    assert (verdicts(R.learn(values, ~corner, apart), values) == corner).mean() > 0.98
    # a few bad rows everywhere, none in the corner: keeping it is the surest rule, and comes first
    noisy = ~corner & (rng.random(4000) < np.where(values["x"] < 0.3, 0.97, 0.02))
    rules = R.learn(values, noisy, apart)
    assert rules[0].keep and not rules[-1].keep and (verdicts(rules, values) == ~noisy).mean() > 0.95
    # an exception inside a bad region, itself with an exception
    bad = (values["x"] > 0.4) & ~((values["y"] > 0.3) & (values["y"] < 0.7))
    rules = R.learn(values, bad, apart)
    assert (verdicts(rules, values) == ~bad).mean() > 0.98


def test_order_decides(spark):
    from pyspark.sql import functions as F
    name = next(iter(R.FEATURES))
    rules = [R.Rule(((name, ">", 0.5),), True), R.Rule(())]
    assert verdicts(rules, {name: np.array([0.4, 0.6])}).tolist() == [False, True]
    assert verdicts(rules[::-1], {name: np.array([0.4, 0.6])}).tolist() == [False, False]
    stats = spark.createDataFrame([(100, 500, 80, 0, 0)], "n_words long, word_chars long, n_symbols long, "
                                                          "n_dup_lines long, n_repeat_words long").select(F.struct("*").alias("s"))
    first, second = (stats.select(R.verdict(r, "s")).first()[0] for r in (rules, rules[::-1]))
    assert second is False and first in (True, False)


def test_a_label_with_many_rows_keeps_the_sample_bounded(make, spark, monkeypatch):
    docs, labels = corpus(random.Random(1), 300)
    many = make(docs + [(1, f"{docs[1][1]} copy {k}") for k in range(3000)])
    seen = []
    learn = R.learn
    monkeypatch.setattr(R, "learn", lambda v, b, a: (seen.append(len(b)), learn(v, b, a))[1])
    R.learn_list(many, labels_of(spark, labels), sample_rows=300)
    assert seen[0] < 700
