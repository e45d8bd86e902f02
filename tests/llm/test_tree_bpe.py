import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tests.llm.conftest import edge_docs
from vantage.llm import tree_bpe
from vantage.llm.common import tokenizer_path
from vantage.llm.tree_bpe import Monoid


def rank_file(name="byte_bpe_50k.tiktoken"):
    with open(tokenizer_path(name), "rb") as f:
        return f.read()


@pytest.fixture(scope="module", params=["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def both(request):
    content = rank_file(request.param)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return Monoid.from_bytes(content, public_tokenizers.PATTERN), theirs


def ids(monoid, text):
    return np.frombuffer(monoid.encode(text), np.int32).tolist()


TEXTS = ["", " ", "  ", "Don't STOP!'s it's 'tis we'll", "a\x1cb \x1f c\x85d\xa0e f g  h \n i\n\n j ", "<|endoftext|>hello",
         "12345 ½ ² Ⅷ 1,234.5", "日本語 テキスト", "!!!!!??''s''", "x" * 5000, "ha" * 1999, "ab" * 999 + "a", " " * 700 + "x",
         "\n" * 99, "́abc ͅ", "👍🏽 emoji ‍ zwj", " lead", "trail ", "tab\t two\t\tb", " .,;:!?", "é." * 50, "A'll'll x'"]


def odd_texts(n=1500):
    rng = random.Random(1)
    alphabet = "aeiouthnsrAB 'xé́ß!-\t\n1中😀\x1c\x85\xa0."
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 80))) for _ in range(n)]


def test_equal_to_the_library(both):
    ours, theirs = both
    for text in TEXTS + odd_texts():
        got = ids(ours, text)
        assert got == theirs.encode_ordinary(text), text
        assert ours.spell(np.array(got, np.int32)) == text.encode()


def test_characters_of_every_kind(both):
    ours, theirs = both
    for c in range(0, 0x110000, 37):
        if not 0xD800 <= c < 0xE000:
            text = f"a{chr(c)}{chr(c)} {chr(c)}1"
            assert ids(ours, text) == theirs.encode_ordinary(text), hex(c)


def by_definition(word, ranks):
    """The least rank first, the leftmost of equals."""
    tokens = [word[i:i + 1] for i in range(len(word))]
    while True:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(tokens, tokens[1:])) if a + b in ranks]
        if not found:
            return [ranks[t] for t in tokens]
        i = min(found)[1]
        tokens[i:i + 2] = [tokens[i] + tokens[i + 1]]


def random_ranks(rng, letters):
    """A rank table as merging makes one, every token reachable or not."""
    ranks = {bytes([b]): b for b in range(256)}
    while len(ranks) < 256 + rng.randint(3, 25):
        a, b = (rng.choice([t for t in ranks if len(t) > 1 or t in letters]) for _ in range(2))
        ranks.setdefault(a + b, len(ranks))
    return ranks


@pytest.mark.parametrize("seed", range(20))
def test_joins_give_what_merging_gives(seed):
    rng = random.Random(seed)
    letters = [b"a", b"b", b"c"][:rng.randint(1, 3)]
    ranks = random_ranks(rng, letters)
    monoid = Monoid(ranks, ".+", cache=3 if seed % 2 else None)
    for _ in range(150):
        left, middle, right = (b"".join(rng.choice(letters) for _ in range(rng.randint(1, 40))) for _ in range(3))
        whole = by_definition(left + middle + right, ranks)
        a, b, c = (monoid.reduce(x) for x in (left, middle, right))
        assert a == by_definition(left, ranks)
        assert monoid.join(monoid.join(a, b), c) == monoid.join(a, monoid.join(b, c)) == whole
        assert monoid.join([], a) == monoid.join(a, []) == a
        long = (left + middle + right) * 3
        assert monoid._merge_long(long) == by_definition(long, ranks)


def test_a_rank_file_without_some_byte_is_refused():
    with pytest.raises(ValueError, match="byte 0"):
        Monoid({b"a": 0}, ".+")


def test_small_caches_and_leaves_change_nothing(monkeypatch, both):
    ours, _ = both
    texts = odd_texts(300)
    monkeypatch.setattr(tree_bpe, "LEAF", 2)
    monkeypatch.setattr(tree_bpe, "SHORT", 3)
    monkeypatch.setattr(tree_bpe, "SCAN", 4)
    fresh = Monoid(ours.ranks, public_tokenizers.PATTERN, cache=4)
    for t in texts:
        assert fresh.encode(t) == ours.encode(t)
        assert fresh.spell(np.frombuffer(fresh.encode(t), np.int32)) == t.encode()


def test_other_patterns_find_matches_over_the_whole_text():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file().splitlines())}
    pattern = r"\p{L}+ \p{L}+|\s|\S"
    theirs = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    ours = Monoid(ranks, pattern)
    for t in ["two words here now", "a b  c\nd e."]:
        assert ids(ours, t) == theirs.encode_ordinary(t)


def test_whole_table(spark, docs, both):
    theirs = both[1]
    name = "byte_bpe_50k.tiktoken" if both[0].ranks == Monoid.from_bytes(rank_file(), ".").ranks else "byte_bpe_multi_50k.tiktoken"
    expected = {}
    for r in docs.collect():
        coded = theirs.encode_ordinary(r.text or "")
        expected[r.doc_id] = (len(coded), hashlib.sha256(" ".join(map(str, coded)).encode()).hexdigest(),
                              hashlib.sha256(theirs.decode_bytes(coded)).hexdigest())
    got = tree_bpe.token_digests(docs, tokenizer_path(name)).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == expected and len(got) == len(expected)


def test_edges(spark):
    got = tree_bpe.token_digests(edge_docs(spark)).collect()
    by = {r.doc_id: r for r in got}
    none = hashlib.sha256(b"").hexdigest()
    assert len(got) == 9 and all(tuple(by[i])[1:] == (0, none, none) for i in (1, 2))
    assert by[8].decoded_sha256 == hashlib.sha256(("long text " * 20_000).encode()).hexdigest()
    assert tree_bpe.token_digests(edge_docs(spark).limit(0)).collect() == []
    kept = tree_bpe.round_trip(edge_docs(spark), keep=("doc_id", "lang", "n")).collect()
    assert len(kept) == 9 and all(r.n == "n!" for r in kept)
