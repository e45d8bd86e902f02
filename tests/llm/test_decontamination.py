import hashlib
import re

import pytest

from tests.llm.conftest import SF, edge_docs
from vantage.llm import decontamination


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items):
    out = []
    for doc_id, text in docs:
        line, hit, named = words(text), set(), set()
        for item, itext in items:
            w = words(itext)
            windows = {tuple(w[i:i + 13]) for i in range(max(1, len(w) - 12))} if w else set()
            for win in windows:
                for i in range(len(line) - len(win) + 1):
                    if line[i] == win[0] and tuple(line[i:i + len(win)]) == win:
                        hit |= set(range(i, i + len(win)))
                        named.add(item)
        ids = sorted(str(x) for x in named if x is not None)
        out.append((doc_id, len(line), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(line)))
    return sorted(out, key=repr)


LONG = " ".join(f"w{i}" for i in range(30))
ITEMS = [(1, LONG), (2, "Short item!"), (10, "short ITEM"), (3, ""), (4, None), (5, "..."), (None, "nameless thing"), (1, LONG),
         (7, "tick tick tick"), (8, " ".join(f"w{i}" for i in range(10, 23)))]
DOCS = [(1, LONG), (2, f"before {LONG.upper()} after"), (3, LONG.replace(" ", ", ")), (4, " ".join(f"w{i}" for i in range(12))),
        (5, "a short item here"), (6, "tick " * 9), (7, "x " * 39 + "short item"), (8, "x " * 38 + "short item"), (9, None), (10, ""),
        (11, "nameless thing"), (12, "shorter item"), (13, "short éitem"), (14, "v " * 50_000 + LONG), (1, LONG), (None, "short item")]


def frames(spark, docs=DOCS, items=ITEMS):
    return (spark.createDataFrame([(*d, "f") for d in docs], "doc_id long, text string, found string"),
            spark.createDataFrame([(*i, "w") for i in items], "item_id long, text string, window string"))


@pytest.mark.parametrize("most", [500_000, 5])
def test_against_brute_force(spark, most):
    """With five windows a set, several passes give the same."""
    docs, items = frames(spark)
    got = decontamination.scan(docs.select("doc_id", "text"), items, most_windows=most)
    rows = got.select("doc_id", *(f"found.{c}" for c in "n_words n_hit n_items items_sha256 contaminated".split())).collect()
    assert sorted(map(tuple, rows), key=repr) == plain(DOCS, ITEMS)


def test_whole_table(spark, docs):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = decontamination.report(docs, items).collect()
    assert sorted(map(tuple, got), key=repr) == plain([(r.doc_id, r.text) for r in docs.collect()],
                                                      [(r.item_id, r.text) for r in items.collect()])
    assert any(r.contaminated for r in got)


def test_hash_collisions_are_verified(monkeypatch, spark):
    import numpy as np

    monkeypatch.setattr(decontamination, "rolling", lambda line, n: np.zeros(len(line) - n + 1, np.uint64))
    known = decontamination.WindowSet([("1", "a b"), ("2", "c d")])
    line = np.array([known.numbers[w] for w in (b"a", b"c", b"d", b"a", b"b")], np.int32)
    assert known.scan(line) == [(1, 2, ["2"]), (3, 2, ["1"])]


def test_documents_go_or_spans_go(spark):
    docs, items = frames(spark)
    kept = decontamination.clean(docs, items)
    dirty = {r[0] for r in plain(DOCS, ITEMS) if r[5]}
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in DOCS} - dirty and {r.found for r in kept.collect()} == {"f"}
    cut = {r.doc_id: r.text for r in decontamination.clean(docs, items, spans=True).collect()}
    assert cut[2] == "before  after" and cut[5] == "a  here" and cut[9] is None and cut[12] == "shorter item"


def test_empty_tables(spark):
    docs, items = frames(spark)
    assert decontamination.report(docs.limit(0), items).collect() == []
    assert {(r.n_hit, r.contaminated) for r in decontamination.report(docs, items.limit(0)).collect()} == {(0, False)}
    assert decontamination.clean(edge_docs(spark), items).count() == 9


def test_a_window_of_many_items_is_broadcast_once(spark, monkeypatch):
    """Beyond the bound no set holds more windows than it, whatever the number of items that share one; clashing names and
    repeated documents included."""
    common = "one two three four five six seven eight nine ten eleven twelve thirteen"
    items = spark.createDataFrame([(f"i{k}", common) for k in range(300)] + [(f"own{k}", f"{common[4:]} tail{k}") for k in range(40)]
                                  + [(None, common)], "item_id string, text string")
    docs = spark.createDataFrame([(1, f"well {common} indeed", "x"), (2, f"{common} tail3", "y"), (2, f"{common} tail3", "y"), (3, "clean", "z"), (4, None, "w")],
                                 "doc_id long, text string, rid string")
    sizes, made = [], decontamination.WindowSet.__init__
    monkeypatch.setattr(decontamination.WindowSet, "__init__", lambda self, rows: sizes.append(len(rows)) or made(self, rows))
    few = decontamination.scan(docs, items, most_windows=20).collect()
    assert len(sizes) > 1 and max(sizes) <= 20 and sum(sizes) == 41
    sizes.clear()
    assert sorted(map(repr, few)) == sorted(map(repr, decontamination.scan(docs, items).collect())) and sizes == [340 + 1]
    assert {r.doc_id: r.found.n_items for r in few} == {1: 300, 2: 301, 3: 0, 4: 0}
