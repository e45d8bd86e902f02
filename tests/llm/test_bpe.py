import hashlib
import random

import numpy as np
import pytest
import regex
from tokenizers import Tokenizer

from tests.llm.conftest import edge_docs
from vantage.llm import bpe
from vantage.llm.bpe import Automaton
from vantage.llm.common import tokenizer_path


@pytest.fixture(scope="module")
def theirs():
    t = Tokenizer.from_file(tokenizer_path())
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def ours():
    return Automaton.from_file(tokenizer_path())


def random_texts(n=1500):
    rng = random.Random(1)
    alphabet = "aeiouthnsrAB 'xé́ß!-\t\n1中"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(n)]


TEXTS = ["", "  ", "Don't STOP!'s it's 'tis we'll", "ΑΣΣ ΣΊΣΥΦΟΣ ς", "éá İstanbul", "a\x1cb \x1f c\x85d\xa0e f​g",
         "<|endoftext|>hello <|startoftext|>!", "aaaaaaaaaaaaaaaaaaaaa " * 3, "12345 ½ ² Ⅷ", "日本語 テキスト", "!!!!!??''s''",
         "x" * 5000, "ha" * 999, "́abc ͅ", "ﬁ ﬂ ẞ ß ǅ", "👍🏽 emoji ‍ zwj", " a b﻿c"]


def test_equal_to_the_library(ours, theirs):
    for text in TEXTS + random_texts():
        ids = np.frombuffer(ours.encode(text), np.int32)
        assert ids.tolist() == theirs.encode(text, add_special_tokens=False).ids, text
        assert ours.decode(ids) == theirs.decode(ids.tolist(), skip_special_tokens=False)


def merged(word, merges):
    """Merging as defined: the earliest merge first, from the left."""
    while True:
        ranks = [(merges[p], i) for i, p in enumerate(zip(word, word[1:])) if p in merges]
        if not ranks:
            return word
        rank, _ = min(ranks)
        out, i = [], 0
        while i < len(word):
            if i + 1 < len(word) and merges.get((word[i], word[i + 1])) == rank:
                out.append(word[i] + word[i + 1])
                i += 2
            else:
                out.append(word[i])
                i += 1
        word = out


@pytest.mark.parametrize("seed", range(12))
def test_gadgets_give_what_merging_gives(seed):
    rng = random.Random(seed)
    base = ["a", "b", "c"][:rng.randint(1, 3)]
    tokens, merges = list(base), []
    while len(merges) < rng.randint(3, 14):
        u, v = rng.choice(tokens), rng.choice(tokens)
        if u + v in tokens:
            break
        tokens.append(u + v)
        merges.append((u, v))
    machine = Automaton.compile({t: i for i, t in enumerate(tokens)}, merges, {})
    ranks = {p: i for i, p in enumerate(merges)}
    for _ in range(300):
        word = [rng.choice(base) for _ in range(rng.randint(1, 14))]
        assert [tokens[i] for i in machine.run(word)] == merged(list(word), ranks)


def test_neighbours_of_the_whole_vocabulary(ours, theirs):
    rng = random.Random(5)
    bodies = [t for t in ours.labels if t and regex.fullmatch("[a-z]+(</w>)?", t)]
    starts = [t for t in bodies if not t.endswith(bpe.WORD_END)]
    for _ in range(4000):
        word = rng.choice(starts) + rng.choice(starts) + rng.choice(bodies).removesuffix(bpe.WORD_END)
        got = ours.run([*word[:-1], word[-1] + bpe.WORD_END])
        assert got == theirs.encode(word, add_special_tokens=False).ids, word


def test_the_compiled_table_is_small(ours):
    states = len(ours.ids)
    assert len(ours.cuts) < 25 * states and max(ours.last) == len(ours.cuts)


def test_vocabularies_it_cannot_compile():
    with pytest.raises(ValueError, match="two merges"):
        Automaton.compile({"a": 0, "b": 1, "ab": 2, "ba": 3, "aba": 4}, [("a", "b"), ("b", "a"), ("ab", "a"), ("a", "ba")], {})
    with pytest.raises(ValueError, match="no earlier merge"):
        Automaton.compile({"a": 0, "b": 1, "ab": 2, "aba": 3}, [("ab", "a"), ("a", "b")], {})
    with pytest.raises(ValueError, match="no path"):
        Automaton.compile({"a": 0}, [], {}).run(["z"])


def test_small_caches_change_nothing(monkeypatch, ours):
    texts = random_texts(300)
    whole = [ours.encode(t) for t in texts]
    monkeypatch.setattr(bpe, "CACHE", 4)
    fresh = Automaton.from_file(tokenizer_path())
    assert [fresh.encode(t) for t in texts] == whole


def test_whole_table(spark, docs, theirs):
    expected = {}
    for r in docs.collect():
        ids = theirs.encode(r.text, add_special_tokens=False).ids
        expected[r.doc_id] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                              hashlib.sha256(theirs.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    got = bpe.token_digests(docs).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == expected and len(got) == len(expected)


def test_edges(spark, theirs):
    got = bpe.token_digests(edge_docs(spark)).collect()
    by = {r.doc_id: r for r in got}
    none = hashlib.sha256(b"").hexdigest()
    assert len(got) == 9 and all(tuple(by[i])[1:] == (0, none, none) for i in (1, 2, 3))
    assert by[8].n_tokens == len(theirs.encode("long text " * 20_000, add_special_tokens=False).ids)
    assert bpe.token_digests(edge_docs(spark).limit(0)).collect() == []
    odd = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r.decoded for r in bpe.decode(odd).orderBy("doc_id").collect()] == [None, ""]
