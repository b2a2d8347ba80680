import random
import re

from qualmart.llm import licenses as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_base(text):
    w = words(text)
    at = [(i, label) for p, label in L.PHRASES.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    starts = [i for i, _ in at]
    return len(w), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at}))


def brute_labels(text):
    """All rules at all places, then containment, in plain Python."""
    w, found = words(text), set()
    for anchor, left, right, label, priority in L.rules():
        for i in range(len(w)):
            if w[i] != anchor:
                continue
            before, behind = " ".join(w[max(0, i - 14):i]) + " ", " ".join(w[i:i + 18])
            a = re.search(f"(?:^| )(?:{left})$", before) if left else None
            b = re.search(f"^(?:{right})(?= |$)", behind)
            if b and (a or not left):
                found.add((i - (len(a[0].split()) if a else 0), i + len(b[0].split()), priority, label))
    order = sorted(found, key=lambda d: (d[0], -d[1], -d[2], d[3]))
    kept = [d for k, d in enumerate(order) if not any(e[2] >= d[2] and e[1] >= d[1] for e in order[:k])]
    return {d[3] for d in kept}


def test_matches_brute_force(make, odd_texts):
    rng = random.Random(8)
    pool = ["under the MIT license", "Apache License, Version 2.0", "CC BY-NC 4.0", "cc by nc cc-by-nc", "mit", "Licensed under the",
            "GNU General Public License, version 3", "SPDX-License-Identifier: GPL-3.0", "All rights reserved", "cc by", "nc", "sa",
            "émit license", "the", "BSD 3-Clause License", "Released", "public domain", "😀", "license", "version 2", "Creative Commons Attribution"]
    texts = [t for t in odd_texts if t is None or len(t) < 9000]
    texts += [rng.choice([" ", "\n", ". ", " -- "]).join(rng.choice(pool) for _ in range(rng.randrange(1, 25))) for _ in range(150)]
    texts += ["under the mit license " * 400, "cc by nc"]
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, "cc by nc")]
    got = L.scanned(make(rows, extra=["n_words", "norm", "found", "labels"])).collect()
    assert len(got) == len(rows)
    for r in got:
        text = "cc by nc" if r.doc_id is None else texts[r.doc_id]
        n, count, first, last, base = brute_base(text)
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (n, count, first, last, base), text
        assert set(filter(None, r.labels.split(","))) == brute_labels(text) | set(filter(None, base.split(","))), text
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)


def test_containment_and_priority(make):
    text = "SPDX-License-Identifier: GPL-3.0. Licensed under the GNU General Public License, version 3."
    r = L.scanned(make([(1, text)])).first()
    assert [(d.label, d.priority) for d in r.detections] == [("gpl-3", 4), ("gpl-3", 3)] and r.score == 1.0


def test_rule_table():
    table = L.rules()
    assert len(table) > 300 and len(set(table)) == len(table)
    for anchor, left, right, _, _ in table:
        re.compile(left), re.compile(right)
        assert right.startswith(anchor)


def test_empty_table(make):
    assert L.scanned(make([])).count() == 0


def brute_detections(text):
    """The unsuppressed (label, priority, start, end) of all rules at all places, in plain Python."""
    w, found = words(text), set()
    for anchor, left, right, label, priority in L.rules():
        for i in (i for i in range(len(w)) if w[i] == anchor):
            a = re.search(f"(?:^| )(?:{left})$", " ".join(w[max(0, i - 14):i]) + " ") if left else None
            b = re.search(f"^(?:{right})(?= |$)", " ".join(w[i:i + 18]))
            if b and (a or not left):
                found.add((i - (len(a[0].split()) if a else 0), i + len(b[0].split()), priority, label))
    order = sorted(found, key=lambda d: (d[0], -d[1], -d[2], d[3]))
    return [(d[3], d[2], d[0], d[1]) for k, d in enumerate(order)
            if not any(e[2] >= d[2] and e[1] >= d[1] for e in order[:k])]


def test_scores_and_detections_match_brute_force(make):
    rng = random.Random(12)
    verbs = "Released Licensed Distributed Available Published Provided Covered".split()
    grants = [f"{v} {how}under {terms}" for v in verbs for how in ("", "only ", "also ") for terms in ("", "the ", "the terms of the ")]
    grants += ["subject to the", "in accordance with", "governed by the terms of the", "license is the", "licence", ""]
    names = ["Apache 2.0", "GPLv3", "CC BY 4.0", "CC0", "CC BY-NC-SA 4.0", "MIT license", "BSD 2-Clause", "MPL 2.0", "WTFPL", "0BSD",
             "GNU GPL", "zlib licence", "EUPL 1.2", "public domain", "creativecommons.org/licenses/by-nd"]
    texts = [f"{g} {n}" for g in grants for n in names] + [" . ".join(
        f"{rng.choice(grants)} {rng.choice(names)} foo" for _ in range(4)) for _ in range(60)]
    for r in L.scanned(make(list(enumerate(texts)))).collect():
        want = brute_detections(texts[r.doc_id])
        assert [tuple(d) for d in r.detections] == want, texts[r.doc_id]
        base = 3 if r.base_labels else 0
        assert r.score == max([base, *(d[1] for d in want)]) / 4, texts[r.doc_id]


def test_grants_without_the_word_license(make):
    texts = ["Released under Apache 2.0", "distributed under the GPLv3", "available under CC BY 4.0", "published under CC0"]
    got = [(r.labels, r.score, [(d.priority, d.start) for d in r.detections]) for r in
           L.scanned(make(list(enumerate(texts))).coalesce(1)).collect()]
    assert got == [(label, 0.75, [(3, 0)]) for label in ("apache-2", "gpl-3", "cc-by", "cc0")]


def test_every_sentence_is_found_whole(make):
    plain = [(label, re.sub(r"\(\?:([^|)]*)[^)]*\)", r"\1", s.replace("{", "").replace("}", "")).replace("[23]", "2"))
             for label, sentences in L.SENTENCES.items() for s in sentences]
    assert len(plain) > 30
    texts = [f"Some words. {s.capitalize()}, and so on." for _, s in plain] + [s[:s.rindex(" ")] for _, s in plain]
    got = {r.doc_id: r for r in L.scanned(make(list(enumerate(texts)))).collect()}
    for i, (label, s) in enumerate(plain):
        assert (label, 3, 2, 2 + len(s.split())) in [tuple(d) for d in got[i].detections], s
        assert [tuple(d) for d in got[i].detections] == brute_detections(texts[i]), s
        short = [tuple(d) for d in got[len(plain) + i].detections]
        assert short == brute_detections(texts[len(plain) + i]) and (label, 3, 0, len(s.split())) not in short, s
