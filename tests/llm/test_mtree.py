import random
from math import floor

import numpy as np
import pytest
from pyspark.sql import functions as F

from vantage.llm import mtree

SCHEMA = "vec_id long, embedding array<double>, label string, tree string, v string"


def frame(spark, rows):
    return spark.createDataFrame([(i, e, "l", "t", "v") for i, e in rows], SCHEMA)


def brute(rows, every=100, k=10):
    good = [(i, [floor(1024 * x) for x in e]) for i, e in rows
            if i is not None and e is not None and all(x is not None and np.isfinite(x) for x in e)]
    out = set()
    for q, a in {(i, tuple(v)) for i, v in good if i % every == 0}:
        scored = sorted(((-sum(x * y for x, y in zip(a, v)), i) for i, v in good if i != q and len(v) == len(a)))[:k]
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)}
    return out


def found(df):
    return {tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect()}


@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_against_brute_force(spark, spread):
    rng = random.Random(7)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(12)]
    rows = [(i, [x + rng.gauss(0, spread) for x in rng.choice(centres)]) for i in range(1500)]
    vectors = mtree.quantized(frame(spark, rows)).cache()
    pages = mtree.build(vectors, tree_rows=400, page=16, fan=6)
    asked = vectors.where("vec_id % 100 = 0")
    assert found(mtree.top_k(pages, asked, 10, block=4)) == brute(rows)
    assert pages.select(F.max(F.size("ids"))).first()[0] <= 16


def test_ties_copies_and_few_candidates(spark):
    rows = [(i, [1.0, 0.5]) for i in range(300)] + [(300, [0.0, 0.0]), (400, [1.0, 2.0, 3.0]), (401, [1.0, -2.0, 0.25])]
    pages = mtree.build(mtree.quantized(frame(spark, rows)), tree_rows=1000, page=8, fan=4)
    got = found(mtree.top_k(pages, mtree.quantized(frame(spark, rows)).where("vec_id % 100 = 0")))
    assert got == brute(rows)
    assert {r for r in got if r[0] == 400} == {(400, 1, 401, 1024 * 1024 * 1 - 2048 * 2048 + 3072 * 256)}


def test_edges(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]),
            (None, [1.0, 1.0]), (5, [-0.0001, 3.0]), (6, []), (100, [])]
    assert found(mtree.search_table(frame(spark, rows))) == {(0, 1, 5, 2 * 3 * 1024 * 1024 - 1024), (100, 1, 6, 0)}
    assert mtree.search_table(frame(spark, rows).limit(0)).collect() == []
    assert mtree.search_table(frame(spark, rows[2:5])).collect() == []


def test_large_components_stay_exact():
    a = np.array([[2 ** 31, 2 ** 31 - 1]], np.int64)
    assert mtree.dots(a, np.array([3, 2 ** 30], np.int64))[0] == 3 * 2 ** 31 + 2 ** 30 * (2 ** 31 - 1)


def test_bounds_save_distances():
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 3000, (40, 6))
    vectors = (centres[rng.integers(0, 40, 4000)] + rng.normal(0, 20, (4000, 6))).astype(np.int64)
    table = mtree._build(32, 16)(__import__("pyarrow").table(
        {"tree": [0] * 4000, "vec_id": list(range(4000)), "v": vectors.tolist()}))
    tree = mtree.Tree(table.to_pylist())
    best = tree.search(5, vectors[5], 10)
    scores = vectors @ vectors[5]
    assert best == [(int(scores[i]), int(i)) for i in np.lexsort((np.arange(4000), -scores)) if i != 5][:10]
    assert tree.computed < 1500


def test_products_beyond_a_long():
    big = np.array([[3 * 10 ** 15 * 1024, 5], [-3 * 10 ** 15 * 1024, 3 * 10 ** 15 * 1024]], np.int64)
    assert mtree.dots(big, np.array([1, 1], np.int64)).tolist() == [3 * 10 ** 15 * 1024 + 5, 0]
    with pytest.raises(OverflowError):
        mtree.dots(big[:1], np.array([3 * 10 ** 15 * 1024, 1], np.int64))


def test_components_beyond_a_long(spark):
    with pytest.raises(Exception, match="too large"):
        mtree.quantized(frame(spark, [(0, [1e300])])).collect()


def test_clusters_in_many_dimensions_leave_cells_and_pages_out(spark):
    rng = np.random.default_rng(11)
    centres = rng.normal(0, 1, (30, 64))
    centres *= rng.uniform(2, 9, 30)[:, None] / np.linalg.norm(centres, axis=1)[:, None]
    values = centres[rng.integers(0, 30, 3000)] + rng.normal(0, 0.01, (3000, 64))
    rows = [(i, v.tolist()) for i, v in enumerate(values)]
    vectors = mtree.quantized(frame(spark, rows)).cache()
    pages = mtree.build(vectors, tree_rows=60, page=16, fan=8, cell_rows=30)
    assert pages.where("leaf").agg(F.sum(F.size("ids"))).first()[0] == 3000
    asked = vectors.where("vec_id % 100 = 0")
    assert found(mtree.top_k(pages, asked, 10, block=16)) == brute(rows)
    cells = [(r.cell, r.pivot, r.radius) for r in pages.groupBy("cell").agg(
        F.max("pivot").alias("pivot"), F.max("cell_radius").alias("radius")).orderBy("cell").collect()]
    sizes = {r.cell: r.n for r in pages.where("leaf").groupBy("cell").agg(F.sum(F.size("ids")).alias("n")).collect()}
    tenth = {q: s for q, rank, _, s in brute(rows) if rank == 10}
    seen = asked.rdd.map(lambda r: (r.vec_id, r.v, tenth[r.vec_id])).toDF("vec_id long, v array<long>, least long").select(
        mtree._promising(cells)(F.struct("v", "least")).alias("c")).collect()
    assert sum(sizes[c] for r in seen for c in r.c) < len(seen) * 3000 / 2


def test_a_bound_from_elsewhere_loses_nothing():
    rng = np.random.default_rng(2)
    vectors = rng.integers(-9, 10, (500, 3))
    tree = mtree.Tree(mtree._build(8, 4)(__import__("pyarrow").table(
        {"tree": [0] * 500, "vec_id": list(range(500)), "v": vectors.tolist()})).to_pylist())
    for q in range(0, 500, 25):
        scores = vectors @ vectors[q]
        order = [(int(scores[i]), int(i)) for i in np.lexsort((np.arange(500), -scores)) if i != q]
        for least in (order[0][0], order[4][0], order[9][0], order[30][0]):
            got = tree.search(q, vectors[q], 10, least)
            want = [x for x in order if x[0] >= least][:10]
            assert got[:len(want)] == want
