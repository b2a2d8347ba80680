import random
import zlib
from collections import Counter

import numpy as np
import pytest

from qualmart.llm import lm as L


def test_log_probs_are_a_distribution():
    net = L.Network.start(np.arange(L.TOKENS, 0, -1))
    tokens, begin = L.padded([np.array([5, 9, 700]), np.array([], int), np.array([4000])])
    assert tokens.tolist() == [L.TOKENS] * 2 + [5, 9, 700] + [L.TOKENS] * 4 + [4000] + [L.TOKENS] * 2
    for at in (2, 4, 9):  # one document per token, all with the same neighbours
        many = np.tile(tokens[at - 2:at + 3], L.TOKENS)
        many[2::5] = np.arange(L.TOKENS)
        assert abs(np.exp(net.log_probs(many, np.arange(2, len(many), 5))).sum() - 1) < 1e-3


def test_gradients_agree_with_differences():
    rng = np.random.default_rng(1)
    tokens, _ = L.padded([rng.integers(0, 200, 40)])
    at = np.flatnonzero(tokens != L.TOKENS)
    start = L.Network.start(np.ones(L.TOKENS))
    arrays = [a.astype(np.float64) for a in start.arrays]
    moved = L.Network([a.copy() for a in arrays])
    memory = [np.zeros(a.shape) for a in arrays]
    moved.train(tokens, at, memory)  # one batch
    for k, m in enumerate(memory):
        i = np.unravel_index(np.argmax(m), m.shape)
        values = []
        for eps in (1e-4, -1e-4):
            net = L.Network([a.copy() for a in arrays])
            net.arrays[k][i] += eps
            values.append(-net.log_probs(tokens, at).mean())
        slope = (values[0] - values[1]) / 2e-4
        assert abs(abs(slope) - np.sqrt(m[i])) < 1e-3 * max(1, abs(slope)), L.Network.NAMES[k]


def test_order_from_both_sides_is_learned(make):
    rng = random.Random(2)
    docs = []
    for i in range(300):
        w = []
        for _ in range(60):
            a = rng.randrange(20)
            w += [f"a{a}", f"b{a}", f"c{a}"]
        docs.append((i, " ".join(w)))
    shuffled = []
    for i, t in docs[:40]:
        w = t.split()
        rng.shuffle(w)
        shuffled.append((1000 + i, " ".join(w)))
    odd = [(2000, None), (2001, ""), (2002, "Unseen wörd"), (2002, "Unseen wörd")]
    frame = make(docs + shuffled + odd, extra=["n_tokens", "word"]).repartition(3)
    out = {r.doc_id: r for r in L.pseudo_likelihood(frame, stride=1).collect()}
    assert len(out) == 343 and all(out[i].n_tokens == 180 for i in range(300))
    assert (out[2000].n_tokens, out[2000].log_likelihood, out[2000].perplexity) == (0, 0.0, 1.0)
    assert out[2002].n_tokens == 2
    ordered = np.mean([out[i].perplexity for i in range(40)])
    print(ordered, np.mean([out[1000 + i].perplexity for i in range(40)]))
    assert ordered < 0.7 * np.mean([out[1000 + i].perplexity for i in range(40)])


def test_counts_cover_all_documents(make):
    got = {bytes(r.word): r.n for r in L.word_counts(make([(1, "A a b"), (2, None), (3, "b\tB c")]).repartition(3), "text").collect()}
    assert got == {b"a": 2, b"b": 3, b"c": 1}


def test_empty_table(make):
    assert L.pseudo_likelihood(make([])).count() == 0


def test_every_position_is_a_target_by_default(make):
    rng = random.Random(4)
    docs = make([(i, " ".join(f"a{rng.randrange(9)}" for _ in range(1 + i % 12))) for i in range(60)]).coalesce(1)
    by_default = {r.doc_id: r.log_likelihood for r in L.pseudo_likelihood(docs).collect()}
    assert by_default == {r.doc_id: r.log_likelihood for r in L.pseudo_likelihood(docs, stride=1).collect()}


@pytest.mark.parametrize("known", [0, 500, L.KNOWN])
def test_words_beyond_the_vocabulary_have_their_own_probability(make, monkeypatch, known):
    monkeypatch.setattr(L, "KNOWN", known)   # the others' counts are joined
    often = [f"v{i}" for i in range(L.WORDS)] * 4
    rare = {f"r{i}": 1 + i % 3 for i in range(3000)}
    text = often + [w for w, n in rare.items() for _ in range(n)]
    docs = make([(i, " ".join(text[i::40])) for i in range(40)])
    model = L.fit(docs)
    assert len(model.known) == min(known, len(rare))
    bucket = {w: zlib.crc32(w.encode()) % L.BUCKETS for w in [*rare, *(f"junk{i}" for i in range(50))]}
    total, distinct = Counter(), Counter()
    for w, n in rare.items():
        total[bucket[w]] += n
        distinct[bucket[w]] += 1
    assert model.buckets == [(total[b], distinct[b]) for b in range(L.BUCKETS)]
    tests = [[w] for w in bucket] + [["r7", "r7", "junk3", "v5"]]
    rows = [(i, " ".join(w)) for i, w in enumerate(tests)] + [(0, "r0"), (None, "r7 r7 junk3 v5")]
    got = L.scored(make(rows).repartition(3), model).collect()
    assert len(got) == len(rows)
    words, net = L.Vocabulary(model.vocab), L.Network.load(model.weights)
    for r in got:
        w = tests[-1 if r.doc_id is None else r.doc_id]
        tokens, _ = L.padded([words.ids(" ".join(w).encode())])
        want = net.log_probs(tokens, np.arange(2, 2 + len(w))).sum()
        for x in w:
            if x in bucket:
                b = bucket[x]
                want += np.log(rare[x] if x in rare else 1 / max(1, distinct[b])) - np.log(total[b] + 1)
        assert r.n_tokens == len(w) and abs(r.log_likelihood - want) < 1e-4
        assert abs(r.perplexity - np.exp(-r.log_likelihood / len(w))) < 1e-6 * r.perplexity


def corpus(n, seed=5):
    rng = random.Random(seed)
    return [(i, " ".join(f"w{int(rng.paretovariate(0.7))}" for _ in range(rng.randrange(1, 90)))) for i in range(n)]


def test_scores_do_not_depend_on_partitions(make):
    rows = corpus(150) + [(None, "w1 w2 w3"), (None, None), (7, "again w1"), (7, "again w1")]
    results = []
    for parts in (1, 3, 8):
        docs = make(rows).repartition(parts)
        model = L.fit(docs, replica=200)      # about ten replicas a round
        got = L.scored(docs, model).collect()
        results.append((model.weights, sorted((str(r.doc_id), r.n_tokens, r.log_likelihood) for r in got)))
    assert len(results[0][1]) == len(rows)
    for weights, scores in results[1:]:
        assert weights == results[0][0]         # the network is the same to the last bit
        assert [s[:2] for s in scores] == [s[:2] for s in results[0][1]]
        # scoring multiplies matrices of other heights, so its 32-bit sums may round otherwise
        assert np.allclose([s[2] for s in scores], [s[2] for s in results[0][1]], rtol=1e-6, atol=1e-5)


def test_whole_fit_against_a_plain_loop(make):
    """Rounds, replicas and averages again, document by document in one process."""
    from pyspark.sql import functions as F
    docs = make(corpus(60))
    size = 150
    model = L.fit(docs, replica=size)
    rows = [(r.h, r.text.encode()) for r in docs.select(F.xxhash64("doc_id", "text").alias("h"), "text").collect()]
    counts = Counter(w for _, t in rows for w in L.words_of(t))
    n = np.zeros(L.TOKENS)
    for w, i in model.vocab.items():
        n[i] = counts[w]
    assert n.sum() == sum(counts.values())
    words, net = L.Vocabulary(model.vocab), L.Network.start(n)
    arrays, memory = net.arrays, [np.full(a.shape, 1e-4, np.float32) for a in net.arrays]
    replicas = round(n.sum() / (4 * size))
    assert replicas > 2
    for this in range(4):
        sums, total = [0.0] * (2 * len(arrays)), 0
        for r in range(replicas):
            mine = sorted(x for x in rows if x[0] % 4 == this and (x[0] >> 8) % replicas == r)
            if not mine:
                continue
            own = L.Network([a.copy() for a in arrays])
            seen = [m.copy() for m in memory]
            tokens, _ = L.padded([words.ids(t) for _, t in mine])
            at = np.flatnonzero(tokens != L.TOKENS)
            own.train(tokens, at, seen)
            total += len(at)
            sums = [s + len(at) * a.astype(np.float64) for s, a in zip(sums, own.arrays + seen, strict=True)]
        state = [(s / total).astype(np.float32) for s in sums]
        arrays, memory = state[:len(arrays)], state[len(arrays):]
    for got, want in zip(L.Network.load(model.weights).arrays, arrays, strict=True):
        assert np.allclose(got, want, atol=1e-5)


def test_a_very_long_text(make):
    rng = random.Random(8)
    long = " ".join(f"w{rng.randrange(300)}" for _ in range(200_000))
    out = {r.doc_id: r for r in L.pseudo_likelihood(make([(1, long), (2, "w1 w2"), (3, "x" * 100_000)])).collect()}
    assert out[1].n_tokens == 200_000 and out[3].n_tokens == 1 and all(np.isfinite(r.log_likelihood) for r in out.values())


def test_words_of_a_column_are_those_of_its_texts():
    import pyarrow as pa
    texts = [None, "", " ", "\t A b C\x1cd \n", "\x0bx\x0c\ry", "ÄZ İ", "a  a"]
    for kind in (pa.string(), pa.large_string()):
        words, sizes = L.all_words(pa.array(texts, kind))
        want = [L.words_of((t or "").encode()) for t in texts]
        assert [w.encode() for w in words.to_pylist()] == [w for ws in want for w in ws]
        assert sizes.tolist() == [len(ws) for ws in want]


def test_powers_are_as_exact_as_rounding():
    x = np.random.default_rng(3).uniform(-125, 125, (50, 64))
    x[0], x[1, :3] = np.arange(-32, 32), (0.5, -0.5, 1.5)
    x = x.astype(np.float32)
    want = np.exp2(x.astype(np.float64))
    assert np.abs(L._exp2(x.copy()) / want - 1).max() < 4e-7


def test_far_apart_logits_have_finite_log_probs():
    start = L.Network.start(np.ones(L.TOKENS))
    start.word_b[:, 0] = 400.0          # exp of -400 is no 32-bit number
    tokens, _ = L.padded([np.array([1, 64, 130])])
    at = np.arange(2, 5)
    got = start.log_probs(tokens, at)
    exact = L.Network([a.astype(np.float64) for a in start.arrays]).log_probs(tokens, at)
    assert np.isfinite(got).all() and np.allclose(got, exact, rtol=1e-5) and got[0] < -390 and got[1] > -10


def test_words_are_looked_up_once(make, monkeypatch, capsys):
    """One pass of Python over the texts after the counts; a round's documents come from its token numbers."""
    reads, read = [], L._read
    monkeypatch.setattr(L, "_read", lambda *a: reads.append(read(*a)) or reads[-1])
    docs = make(corpus(40))
    assert L.pseudo_likelihood(docs).count() == 40
    assert len(reads) == 1 and "text" not in reads[0].columns
    L._dealt(reads[0], 0, 3).explain()
    plan = capsys.readouterr().out
    assert "Arrow" not in plan and "tokens" in plan and "others" not in plan


def test_counts_are_passed_on_in_parts(make, monkeypatch):
    monkeypatch.setattr(L, "COUNTED", 7)
    rows = corpus(600) + [(None, None)]
    got = {bytes(r.word): r.n for r in L.word_counts(make(rows).coalesce(2), "text").collect()}
    assert got == Counter(w for _, t in rows if t for w in L.words_of(t.encode()))
