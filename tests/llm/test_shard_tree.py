from collections import defaultdict
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import edge_docs
from vantage.llm.shard_tree import HashTree, Leaf, shard_documents


def placed(spark, tree, n=4000):
    return [r[0] for r in spark.range(n).orderBy("id").select(tree.place(F.col("id"))).collect()]


def test_weights_are_met(spark):
    tree = HashTree((Leaf("a", "x", 0, 3.0), Leaf("a", "x", 1, 1.0), Leaf("b", "y", 2, 2.0), Leaf("b", "z", 3, 2.0)))
    got = placed(spark, tree, 16_000)
    for leaf in tree.leaves:
        assert abs(got.count(leaf.shard) - 16_000 * leaf.weight / 8) < 400


def test_growth_moves_rows_only_into_the_new_shard(spark):
    tree = HashTree.uniform(2, 2, 4)
    for _ in range(2):
        before, after = placed(spark, tree), placed(spark, tree.grown())
        new = len(tree.leaves)
        assert all(b == a or a == new for b, a in zip(before, after))
        assert abs(after.count(new) - 4000 / (new + 1)) < 100
        tree = tree.grown()


def test_a_weight_moves_rows_within_its_subtree_only(spark):
    tree = HashTree.uniform(3, 2, 2)
    before, after = placed(spark, tree), placed(spark, tree.reweighted(5, 2.0))
    region = lambda s: s // 4
    moved = [(b, a) for b, a in zip(before, after) if b != a]
    assert moved and all(region(a) == 1 for _, a in moved)
    assert all(a == 5 for b, a in moved if b in (4, 5))  # within the rack: into the shard
    assert all(a in (4, 5) for b, a in moved if b in (6, 7))  # within the region: into the rack


def test_weight_zero_gets_nothing_and_bad_trees_are_refused(spark):
    assert 3 not in placed(spark, HashTree.uniform(1, 2, 2).reweighted(3, 0.0))
    for bad in ((), (Leaf("a", "b", 0, -1.0),), (Leaf("a", "b", 0), Leaf("a", "c", 0))):
        with pytest.raises(ValueError):
            HashTree(bad)


def test_whole_table(spark, docs):
    rows = shard_documents(docs).collect()
    texts = dict(docs.select("doc_id", "text").collect())
    slots = defaultdict(list)
    for r in rows:
        assert (r.size, r.text_crc32, r.law) == (len(texts[r.doc_id].encode()) + 1, crc32(texts[r.doc_id].encode()), "key")
        assert r.grown_shard in (r.shard, 16) and 0 <= r.shard < 16
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(rows) == len(texts)


def test_edges(spark):
    got = shard_documents(edge_docs(spark)).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 9 and (by[1].size, by[1].text_crc32) == (1, 0) == (by[2].size, by[2].text_crc32)
    assert len({r.shard for r in got if r.doc_id == 4}) == 1 and len({(r.shard, r.slot) for r in got}) == 9
    assert by[8].size == 200_001
    assert shard_documents(edge_docs(spark).limit(0)).collect() == []


def test_no_python_and_no_cross_join(spark, docs):
    plan = shard_documents(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Cartesian", "NestedLoop"))
