import random

import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from qualmart.llm.tokens import MEMO, Counter, prove, token_counts

PATH = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    text = open(PATH, encoding="utf-8").read()
    return Counter(text, prove(text, P.PATTERN), P.PATTERN)


def test_whole_texts(make, odd_texts, library):
    docs = make(list(enumerate(odd_texts)), extra=["n_bytes", "n_tokens"])
    got = {r.doc_id: tuple(r)[1:] for r in token_counts(docs, PATH, P.PATTERN).collect()}
    for i, t in enumerate(odd_texts):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert got[i] == (len((t or "").encode()), n, n > 1024)


def test_every_character_is_cut_as_the_library_does(library, counter):
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(chars), 4096):
        part = chars[at:at + 4096]
        text = "".join(f"a{c}{c}1 {c}x  " for c in part)
        if counter.count(text) != len(library.encode(text, add_special_tokens=False).ids):
            bad = [hex(ord(c)) for c in part if counter.count(f"a{c}{c}1 {c}x  ")
                   != len(library.encode(f"a{c}{c}1 {c}x  ", add_special_tokens=False).ids)]
            raise AssertionError(bad[:20])


def test_random_texts(library, counter):
    rng = random.Random(3)
    pool = ["the", " of", "'s", "'LL", "\n", "  ", "\t", "é", "ß", "zx", "99", "...", "<|endoftext|>", "😀", "́"]
    for _ in range(400):
        text = "".join(rng.choice(pool) for _ in range(rng.randrange(60)))
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids), text


def test_proven_strings_are_single_tokens(library, counter):
    assert 30_000 < len(counter._proven) < 51_000
    for t in random.Random(1).sample(sorted(counter._proven), 500):
        assert len(library.encode(t, add_special_tokens=False).ids) == 1


def test_memo_is_bounded(counter):
    assert len(counter) <= MEMO + len(counter._proven)


def test_empty_table(make):
    assert token_counts(make([]), PATH, P.PATTERN).count() == 0


def test_other_kinds_of_vocabularies_are_refused():
    import json

    import public_tokenizers

    from qualmart.llm import tokens
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        plain = json.load(f)
    tokens.check_definition(json.dumps(plain))
    flagged = dict(plain["added_tokens"][0], lstrip=True)
    for change in ({"normalizer": {"type": "Lowercase"}}, {"added_tokens": [flagged]}, {"pre_tokenizer": {"type": "Whitespace"}},
                   {"model": dict(plain["model"], byte_fallback=True)}, {"model": dict(plain["model"], type="WordPiece")}):
        with pytest.raises(ValueError, match="not supported"):
            tokens.check_definition(json.dumps({**plain, **change}))
