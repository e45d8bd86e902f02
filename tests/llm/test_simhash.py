import random
import re

import pytest
from xxhash import xxh64_intdigest

from tests.llm.conftest import edge_docs
from vantage.llm import simhash
from vantage.llm.components import components


def plain_print(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    h = [xxh64_intdigest(" ".join(words[i:i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_groups(prints: dict, distance=4):
    """doc -> smallest doc reachable."""
    ids, label = sorted(prints), {}
    for start in ids:
        if start in label:
            continue
        label[start], queue = start, [start]
        while queue:
            x = queue.pop()
            for y in ids:
                if y not in label and (prints[x] ^ prints[y]).bit_count() <= distance:
                    label[y] = start
                    queue.append(y)
    return label


def test_fingerprint_by_hand():
    for text in (None, "", "  ", "one", "a b c", "A b C d", "a b c d e f g a b c d", "é É\x0bx\xa0y z w q", "w " * 3000):
        assert simhash.fingerprint(None if text is None else text.encode()) == plain_print(text)


def test_every_value_has_an_anchor_within_radius_one():
    patterns = simhash.coset_patterns(21, 1)
    assert all(patterns)  # each syndrome is met by an error of one bit at most
    assert sum(map(len, simhash.coset_patterns(22, 2))) == 1 + 22 + 22 * 21 // 2


def test_values_one_bit_apart_share_an_anchor():
    rng = random.Random(3)
    patterns = simhash.coset_patterns(21, 2)

    def anchors(x):
        s = 0
        for b in range(21):
            if x >> b & 1:
                s ^= simhash.check_column(b)
        return {x ^ p for p in patterns[s]}

    for _ in range(200):
        x = rng.getrandbits(21)
        assert all(anchors(x) & anchors(x ^ 1 << b) for b in range(21))


@pytest.mark.parametrize("most", [4096, 12])
def test_links_against_brute_force(spark, most):
    """Clusters around a few centres; with a small ``most`` anchors are dealt out over block pairs."""
    rng = random.Random(most)
    prints = []
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(40):
            x = centre
            for b in rng.sample(range(64), rng.randint(0, 7)):
                x ^= 1 << b
            prints.append(x)
    prints = sorted(set(prints))
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    edges = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), 4, most=most)
    found = edges.collect()
    assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= 4 for r in found)
    assert len(found) < 60 * len(prints)  # spanning forests, not all pairs
    roots = {r.node: r.root for r in components(edges).collect()}
    expected = plain_groups({x & (1 << 64) - 1: x & (1 << 64) - 1 for x in signed})
    same = lambda label: {frozenset(x for x in label if label[x] == r) for r in set(label.values())}
    assert same({x & (1 << 64) - 1: roots.get(x, x) for x in signed}) == same(expected)


def test_whole_table(spark, docs):
    prints = {r.doc_id: plain_print(r.text) for r in docs.collect()}
    expected = plain_groups(prints)
    got = simhash.grouped(docs).select("doc_id", simhash.hex_fingerprint().alias("f"), "component").collect()
    assert {r.doc_id: (r.f, r.component) for r in got} == {d: (f"{prints[d]:016x}", expected[d]) for d in prints}


def test_edges(spark):
    got = simhash.grouped(edge_docs(spark)).collect()
    assert len(got) == 9
    by = {r.doc_id: r.component for r in got}
    assert by[1] == by[2] == by[3] == 1 and by[4] == 4 and by[None] is None
    assert simhash.grouped(edge_docs(spark).limit(0)).collect() == []


def test_one_of_each_group_stays(spark):
    docs = edge_docs(spark)
    kept = simhash.deduplicate(docs)
    rows = kept.collect()
    assert kept.columns == docs.columns and sorted(r.doc_id or -1 for r in rows) == [-1, 1, 4, 6, 7, 8]
    assert all(r.rid == "rid!" and r.fp == "fp!" for r in rows)
    only_null = spark.createDataFrame([(None, "x y z"), (None, "x y z"), (None, "p q r s t")], "doc_id long, text string")
    assert len(simhash.deduplicate(only_null).collect()) == 2
    assert simhash.deduplicate(docs.limit(0)).collect() == []


def test_components_of_chains_stars_and_repeats(spark):
    rng = random.Random(5)
    chain = list(range(100, 160))
    rng.shuffle(chain)
    edges = list(zip(chain, chain[1:])) + [(500, 500 + i) for i in range(1, 30)] + [(-7, 3), (3, -7), (9, 9)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{x: 100 for x in chain}, **{500 + i: 500 for i in range(30)}, -7: -7, 3: -7}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
