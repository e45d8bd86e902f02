import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.llm.conftest import edge_docs
from vantage.llm import token_alignment as ta
from vantage.llm.common import tokenizer_path

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    with open(A, "rb") as a, open(B, "rb") as b:
        return ta.Tokenizers(a.read(), b.read())


class Plain:
    """The libraries applied to whole texts, their tokens as bytes, and ends compared one by one."""

    def __init__(self):
        self.a, self.b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
        self.a.encode_special_tokens = True
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        rest = [b for b in range(256) if b not in shown]
        self.byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}

    def a_bytes(self, i):
        return bytes(self.byte[c] for c in self.a.id_to_token(i))

    def b_bytes(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def tokens(self, text):
        if not text:
            return [], []
        a = [(i, self.a_bytes(i)) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, self.b_bytes(i)) for i in self.b.encode(text)]
        same = b"".join(x for _, x in a) == b"".join(x for _, x in b) == (" " + text).encode()
        return (a, b) if same else ([], [])

    def align(self, text):
        """(n_a, n_b, groups as text, links as (a, b))."""
        a, b = self.tokens(text)
        groups, links, i, j = [], [], 0, 0
        while i < len(a):
            left, right = [a[i]], [b[j]]
            while (x := sum(len(t) for _, t in left)) != (y := sum(len(t) for _, t in right)):
                if x < y:
                    i += 1
                    left.append(a[i])
                else:
                    j += 1
                    right.append(b[j])
            i, j = i + 1, j + 1
            groups.append(",".join(str(t) for t, _ in left) + "|" + ",".join(str(t) for t, _ in right))
            links.append((left[-1][0], right[-1][0]))
        return len(a), len(b), ";".join(groups), links

    def report(self, rows):
        found = [(d, *self.align(t)) for d, t in rows]
        counts = Counter(link for f in found for link in f[4])
        highest = {}
        for (_, b), n in counts.items():
            highest[b] = max(n, highest.get(b, 0))
        return sorted(((d, na, nb, len(links), len(links), sum(counts[x] == highest[x[1]] for x in links),
                        sum(counts[x] for x in links), hashlib.sha256(said.encode()).hexdigest() if na else "")
                       for d, na, nb, said, links in found), key=repr), counts, highest


@pytest.fixture(scope="module")
def plain():
    return Plain()


TEXTS = ["", None, "hello  world\n<s> <0x41> é😀x", "a▁b fine", " lead", "trail ", "x" * 50, "日本語 テキスト ", "<|endoftext|> </s> ok",
         "ﬁ ½ Ⅷ", "tab\there\r\n", "a\x1c b \x85c\xa0d", "  ", "\n", "a \n b", "nul\x00byte", "é́ ́x", "ok a▁"]


def odd_texts(n):
    rng = random.Random(2)
    parts = ["the", " ", "  ", "ing", "é", "日本", "😀", "\n", "\t", "'s", "1234", ".", ",", " word", "\xa0", "▁"]
    return ["".join(rng.choice(parts[:15 + (rng.random() < 0.1)]) for _ in range(rng.randint(1, 30))) for _ in range(n)]


def test_texts_against_the_libraries(both, plain):
    assert both.cuttable
    texts = TEXTS + odd_texts(600)
    for _ in range(2):  # the second time from the cache
        found, pairs = both.align(texts)
        at = 0
        for k, t in enumerate(texts):
            n_a, n_b, said, links = plain.align(t)
            assert (found["n_a"][k], found["n_b"][k], found["alignment"][k], found["n_links"][k]) == (n_a, n_b, said, len(links)), t
            assert [(int(p) & (1 << 21) - 1, int(p) >> 21) for p in pairs[at:at + len(links)]] == links
            at += len(links)


def test_without_cuts_the_same(both, plain):
    texts = TEXTS + odd_texts(100)
    both.cuttable = False
    try:
        found, pairs = both.align(texts)
    finally:
        both.cuttable = True
    again, same = both.align(texts)
    assert all(list(found[c]) == list(again[c]) for c in found) and pairs.tolist() == same.tolist()


@pytest.mark.parametrize("radices", [1, 8])
def test_runs_hold_every_link(radices):
    rng = np.random.default_rng(1)
    a, b, doc = rng.integers(0, 9, 5000), rng.integers(0, 30, 5000), np.sort(rng.integers(0, 50, 5000))
    runs = list(ta.spill(b << 21 | a, doc, radices))
    expected, seen = Counter(zip(b.tolist(), a.tolist(), doc.tolist())), Counter()
    for r in runs:
        keys, each = ta.unpack_sorted(r["keys"]), ta.unpack(r["docs_each"], np.uint32)
        assert (np.diff(keys) > 0).all() and set((keys >> 21 & radices - 1).tolist()) == {r["radix"]}
        places, links = ta.unpack(r["places"], np.uint32), ta.unpack(r["links"], np.uint32)
        for k, p, n in zip(np.repeat(keys, each).tolist(), places.tolist(), links.tolist()):
            seen[k >> 21, k & (1 << 21) - 1, p] += n
        assert ta.unpack(r["counts"]).tolist() == np.add.reduceat(links, np.cumsum([0, *each[:-1]])).tolist()
    assert seen == expected
    assert list(ta.spill(np.zeros(0, np.int64), np.zeros(0, np.int64), radices)) == []


def test_merge_and_highest(monkeypatch):
    monkeypatch.setattr(ta, "BLOCK", 3)
    rng, total, runs = np.random.default_rng(2), Counter(), []
    for _ in range(9):
        keys = np.unique(rng.integers(0, 5, 40) << 21 | rng.integers(0, 20, 40))
        counts = rng.integers(1, 9, len(keys))
        total.update(dict(zip(keys.tolist(), counts.tolist())))
        runs.append((ta.pack_sorted(keys), ta.pack(counts)))
    keys, counts = ta.merged(runs)
    assert dict(zip(keys.tolist(), counts.tolist())) == total and (np.diff(keys) > 0).all()
    best = ta.highest(keys, counts)
    for side in range(5):
        own = counts[keys >> 21 == side]
        assert best[keys >> 21 == side].tolist() == (own == own.max()).tolist()
    assert ta.merged([]) [0].tolist() == [] and ta.highest(*ta.merged([])).tolist() == []
    assert ta.unpack(ta.pack(np.zeros(0, np.int64))).tolist() == []


@pytest.mark.parametrize("spill, radices, fan", [(None, None, None), (400, 4, 2), (50, 1, 3)])
def test_whole_table(spark, docs, plain, spill, radices, fan):
    """One slice a task, and many small slices merged in several passes, give the plain result."""
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    docs = docs.repartition(3)
    if spill is None:
        got = ta.report(docs)
    else:
        rows = rows[:40]
        docs = docs.where(docs.doc_id.isin([d for d, _ in rows])).repartition(9, "doc_id")
        counted = ta.Counted(docs, spill=spill, radices=radices, fan=fan)
        assert len(counted.levels) >= (4 if fan == 2 else 3)
        from pyspark.sql import functions as F

        got = counted.documents().withColumn("g", F.when(F.col("n_a") == 0, "").otherwise(F.sha2("alignment", 256))).select(
            "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "g")
        _, counts, highest = plain.report(rows)
        assert {(r.a, r.b): (r["count"], r.best) for r in counted.pairs().collect()} == {
            k: (n, n == highest[k[1]]) for k, n in counts.items()}
    assert sorted(map(tuple, got.collect()), key=repr) == plain.report(rows)[0]


def test_edges(spark, plain):
    got = ta.report(edge_docs(spark)).collect()
    rows = [(r.doc_id, r.text) for r in edge_docs(spark).collect()]
    assert sorted(map(tuple, got), key=repr) == plain.report(rows)[0]
    assert ta.report(edge_docs(spark).limit(0)).collect() == []
    none = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(tuple(r)[1:] for r in ta.report(none).collect()) == [(0, 0, 0, 0, 0, 0, "")] * 2
    kept = ta.Counted(edge_docs(spark), keep=("doc_id", "n", "lang")).documents()
    assert kept.columns == ["doc_id", "n", "lang", "n_a", "n_b", "n_groups", "n_links", "alignment", "n_best", "count_sum"]
    with pytest.raises(ValueError):
        ta.Counted(edge_docs(spark), radices=3)
