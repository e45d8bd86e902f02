"""Exact top-k inner products by best-first search in paged M-trees.

Vectors are routed to cells, each to its nearest of a bounded sample of pivots, and a cell's rows are dealt by hash into trees
of at most about ``tree_rows`` vectors. Within a tree, greatest inner product is nearest neighbour once every vector x gains
the component sqrt(M^2 - |x|^2), M the greatest norm of its tree, and queries gain a zero: the squared distance is then
|q|^2 + M^2 - 2 q.x. A tree is bulk-loaded into pages: every node has a routing vector, a covering radius, its distance from
the parent's routing vector, and a leaf holds its vectors with their distances from the routing vector. The pages are rows
of a table that is written once and searched by blocks of queries.

A search has two rounds. The first asks one tree of the most promising cell and gives a k-th score. The second asks the trees
of all cells that may hold that score or a better one: with pivot p and radius r no member's product exceeds q.p + |q| r.
Both keep a queue of nodes ordered by the least distance they can hold. Stored distances give triangle-inequality bounds,
|d(q, parent) - d(parent, child)| - radius, that discard nodes and vectors before their distance to the query is computed. A
tree is left when its nearest node can't improve on the k-th score. Bounds carry a slack for rounding, scores are exact
integers, and ties go to the smaller vec_id, so results are exact. Each (tree, query block) is one group of bounded size;
the k best of each tree meet in a window by query.

What is saved depends on the data: vectors in clusters leave most cells and pages out; of vectors without structure (far
apart in many dimensions, all about equally near) no bound discards any, and every query meets every row.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vantage.llm.common import batch_udf, settle, ship, tasks_for

PAGES = ("tree int, node int, parent int, leaf boolean, dim int, norm2 double, router array<long>, radius double, "
         "parent_distance double, ids array<long>, vectors array<long>, distances array<double>, cell int, "
         "pivot array<long>, cell_radius double")
SLACK = 1e-9


def quantized(rows: DataFrame, scale: int = 1024) -> DataFrame:
    """(vec_id, v): components as floor(scale * x). Rows without an id, null vectors and vectors that hold a null or
    non-finite component are left out. A component that no long can hold is an error."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    fine = ~F.exists(x, lambda c: F.coalesce(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(True)))
    return (rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine)
            .select(F.col("vec_id").cast("long").alias("vec_id"),
                    F.transform(x, lambda c: F.when(F.abs(c * scale) < 2.0 ** 63, F.floor(c * scale).cast("long"))
                                .otherwise(F.raise_error(F.lit("a vector component is too large")).cast("long"))).alias("v")))


def dots(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact integer inner products; by floating point only while every partial sum is below 2^53, by long integers while
    these hold every sum. OverflowError if a product itself does not fit a long."""
    if vectors.size == 0:
        return np.zeros(len(vectors), np.int64)
    bound = float(np.abs(vectors.astype(np.float64)).max()) * float(np.abs(query.astype(np.float64)).max()) * vectors.shape[1]
    if bound < 2 ** 53:
        return (vectors.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    if bound < 2 ** 62:
        return vectors @ query
    return np.array([int(x) for x in vectors.astype(object) @ query.astype(object)], np.int64)


class _Builder:
    """Bulk load: routers are evenly spaced members, members go to the nearest router, down to one page."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, page: int, fan: int) -> None:
        order = np.lexsort((*vectors.T[::-1], ids)) if vectors.shape[1] else np.argsort(ids)
        self.ids, self.vectors = ids[order], vectors[order]
        norms = (self.vectors.astype(np.float64) ** 2).sum(axis=1)
        self.norm2 = float(norms.max())
        self.points = np.column_stack([self.vectors.astype(np.float64), np.sqrt(np.maximum(self.norm2 - norms, 0))])
        self.page, self.fan, self.nodes = page, fan, []
        self._load(np.arange(len(ids)), 0, -1)

    def _distances(self, rows: np.ndarray, to: int) -> np.ndarray:
        return np.sqrt(((self.points[rows] - self.points[to]) ** 2).sum(axis=1))

    def _load(self, rows: np.ndarray, router: int, parent: int) -> None:
        node, away = len(self.nodes), self._distances(rows, router)
        far = float(self._distances(np.array([router]), self.nodes[parent]["at"])[0]) if parent >= 0 else 0.0
        leaf = len(rows) <= self.page
        self.nodes.append({"at": router, "parent": parent, "leaf": leaf, "radius": float(away.max()), "far": far,
                           "rows": rows if leaf else rows[:0], "away": away if leaf else away[:0]})
        if leaf:
            return
        count = min(self.fan, -(-len(rows) // self.page))
        routers = rows[np.linspace(0, len(rows) - 1, max(2, count)).astype(np.int64)]
        nearest = np.stack([self._distances(rows, r) for r in routers]).argmin(axis=0)
        parts = [(r, rows[nearest == i]) for i, r in enumerate(routers)]
        if max(len(p) for _, p in parts) > 0.9 * len(rows):  # copies, or nearly so: no router tells them apart
            parts = [(p[0], p) for p in np.array_split(rows, max(2, count))]
        for r, part in parts:
            if len(part):
                self._load(part, int(r), node)


def _build(page: int, fan: int, pivots: list[list[int]] | None = None):
    def run(rows: pa.Table) -> pa.Table:
        tree = rows.column("tree")[0].as_py()
        cell = rows.column("cell")[0].as_py() if pivots else len(pivots or [])
        pivot = pivots[cell] if pivots and cell < len(pivots) else None
        radius = None if pivot is None else max(rows.column("away").to_pylist())
        by_dim: dict[int, list] = defaultdict(list)
        for i, v in zip(rows.column("vec_id").to_pylist(), rows.column("v").to_pylist()):
            by_dim[len(v)].append((i, v))
        out: dict[str, list] = defaultdict(list)
        for dim, members in sorted(by_dim.items()):
            base = len(out["tree"])
            b = _Builder(np.array([i for i, _ in members], np.int64),
                         np.array([v for _, v in members], np.int64).reshape(len(members), dim), page, fan)
            for n, x in enumerate(b.nodes):
                row = (tree, base + n, base + x["parent"] if n else -1, x["leaf"], dim, b.norm2,
                       b.vectors[x["at"]].tolist(), x["radius"], x["far"], b.ids[x["rows"]].tolist(),
                       b.vectors[x["rows"]].ravel().tolist(), x["away"].tolist(), cell,
                       None if n else pivot, None if n else radius)
                for name, value in zip(_PAGE_NAMES, row):
                    out[name].append(value)
        return pa.table({f.name: pa.array(out[f.name], f.type) for f in _PAGE_SCHEMA}, schema=_PAGE_SCHEMA)

    return run


_PAGE_SCHEMA = pa.schema([("tree", pa.int32()), ("node", pa.int32()), ("parent", pa.int32()), ("leaf", pa.bool_()),
                          ("dim", pa.int32()), ("norm2", pa.float64()), ("router", pa.list_(pa.int64())),
                          ("radius", pa.float64()), ("parent_distance", pa.float64()), ("ids", pa.list_(pa.int64())),
                          ("vectors", pa.list_(pa.int64())), ("distances", pa.list_(pa.float64())), ("cell", pa.int32()), ("pivot", pa.list_(pa.int64())),
                          ("cell_radius", pa.float64())])
_PAGE_NAMES = _PAGE_SCHEMA.names


def _matrices(pivots: list[list[int] | None]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per dimension the cells that have a pivot of it, and these pivots."""
    by: dict[int, list[int]] = defaultdict(list)
    for cell, p in enumerate(pivots):
        if p is not None:
            by[len(p)].append(cell)
    return {d: (np.array(cells), np.array([pivots[c] for c in cells], np.float64).reshape(len(cells), d))
            for d, cells in by.items()}


def _by_dimension(lists: pa.Array):
    """(dimension, rows, matrix) of a batch of vectors."""
    sizes = np.array([len(x) for x in lists], np.int64)
    for d in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == d)
        yield d, rows, lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), d)


def _route(pivots: list[list[int]]):
    """Per vector its nearest pivot's cell and the distance from it; dimensions without a pivot share one further cell."""

    def make():
        known = _matrices(pivots)

        def work(batch: pa.Array) -> pa.Array:
            cell, away = np.full(len(batch), len(pivots), np.int32), np.zeros(len(batch))
            for d, rows, x in _by_dimension(batch):
                if d in known:
                    cells, at = known[d]
                    near = ((at ** 2).sum(axis=1) - 2 * (x @ at.T)).argmin(axis=1)
                    cell[rows], away[rows] = cells[near], np.sqrt(((x - at[near]) ** 2).sum(axis=1))
            return pa.StructArray.from_arrays([pa.array(cell), pa.array(away)], ["cell", "away"])

        return work

    return batch_udf(make, "struct<cell: int, away: double>")


def _promising(cells: list[tuple[int, list[int] | None, float]]):
    """Per query (v, least): the cells that may hold a product of ``least`` or more; without ``least`` the likeliest one."""

    def make():
        known = _matrices([p for _, p, _ in cells])
        names, radii = np.array([c for c, _, _ in cells], np.int32), np.array([r or 0.0 for _, _, r in cells])
        rest = [c for c, p, _ in cells if p is None]

        def work(batch: pa.Array) -> pa.Array:
            out: list[list[int]] = [[] for _ in range(len(batch))]
            least = batch.field("least").to_pylist()
            for d, rows, x in _by_dimension(batch.field("v")):
                if d not in known:
                    for i in rows.tolist():
                        out[i] = rest
                    continue
                at, pivots = known[d]
                products, norms = x @ pivots.T, np.sqrt((x ** 2).sum(axis=1))[:, None]
                reach = np.sqrt((pivots ** 2).sum(axis=1)) + radii[at]
                most = products + norms * radii[at] + 1e-9 * (1 + norms * reach)
                for i, product, bound in zip(rows.tolist(), products, most):
                    low = least[i]
                    chosen = at[[product.argmax()]] if low is None else at[bound >= low * (1 - 1e-15 * np.sign(low))]
                    out[i] = names[chosen].tolist()
            return pa.array(out, pa.list_(pa.int32()))

        return work

    return batch_udf(make, "array<int>")


def build(vectors: DataFrame, tree_rows: int = 8192, page: int = 64, fan: int = 32, cell_rows: int = 1024,
          most_cells: int = 1024) -> DataFrame:
    """The index of (vec_id, v): one row per node, written to the shared checkpoint folder.

    A pivot for every ``cell_rows`` vectors is drawn by hash, at most ``most_cells``; they are all that the driver sees. Every
    vector is indexed. A cell, however many of the rows it holds, is dealt into trees of ``tree_rows``."""
    spark = vectors.sparkSession
    ship(spark)
    wanted = max(1, min(most_cells, -(-vectors.count() // cell_rows)))
    drawn = vectors.select("v", F.xxhash64("vec_id", "v").alias("h")).orderBy("h").limit(wanted)
    pivots = [list(v) for v in sorted({tuple(r.v) for r in drawn.collect()})]
    routed = settle(vectors.select("vec_id", "v", _route(pivots)(F.col("v")).alias("at"))
                    .select("vec_id", "v", "at.cell", "at.away"), "routed")
    trees, first = [], 0
    for r in routed.groupBy("cell").count().orderBy("cell").collect():  # a row per cell
        trees.append((r.cell, first, -(-r["count"] // tree_rows)))
        first += trees[-1][2]
    plan = spark.createDataFrame(trees, "cell int, first int, trees int")
    dealt = (routed.join(F.broadcast(plan), "cell")  # most_cells + 1 rows at most
             .withColumn("tree", F.col("first") + F.pmod(F.xxhash64("vec_id", "v"), F.col("trees")).cast("int"))
             .drop("first", "trees").repartition(tasks_for(vectors, max(1, first), first << 22), "tree"))
    return settle(dealt.groupBy("tree").applyInArrow(_build(page, fan, pivots), PAGES), "m-tree")


class Tree:
    """One M-tree of one dimension, read from its pages. ``computed`` counts distances to queries."""

    def __init__(self, nodes: list[dict]) -> None:
        self.nodes = {n["node"]: n for n in nodes}
        self.root = next(n["node"] for n in nodes if n["parent"] not in self.nodes)
        self.norm2, dim = nodes[0]["norm2"], nodes[0]["dim"]
        self.children: dict[int, tuple] = {}
        below: dict[int, list[dict]] = defaultdict(list)
        for n in nodes:
            below[n["parent"]].append(n)
            n["v"] = np.array(n["vectors"], np.int64).reshape(len(n["ids"]), dim)
            n["i"], n["d"] = np.array(n["ids"], np.int64), np.array(n["distances"])
        for n, kids in below.items():
            self.children[n] = ([k["node"] for k in kids], np.array([k["router"] for k in kids], np.int64).reshape(
                len(kids), dim), np.array([k["radius"] for k in kids]), np.array([k["parent_distance"] for k in kids]))
        self.computed = 0

    def search(self, own: int, query: np.ndarray, k: int, least: int | None = None) -> list[tuple[int, int]]:
        """The k best (score, vec_id), without rows of id ``own``; scores under ``least`` may be missing."""
        norm = float((query.astype(np.float64) ** 2).sum())
        span = norm + self.norm2
        exact = span < 2 ** 52  # beyond, the root of a rounded difference is off by the root of the rounding
        slack = (SLACK if exact else 2.0 ** -24 * (len(query) + 4) ** 0.5) * (1 + span) ** 0.5 + 1e-6

        def distance(scores: np.ndarray) -> np.ndarray:
            self.computed += len(scores)
            return np.sqrt(np.maximum(span - 2.0 * scores, 0))

        best: list[tuple[int, int]] = []  # heap of (score, -vec_id), the worst first
        limit = np.inf if least is None else max(0.0, span - 2.0 * least) ** 0.5
        root = self.nodes[self.root]
        at = float(distance(dots(np.array([root["router"]], np.int64).reshape(1, len(query)), query))[0])
        queue = [(max(0.0, at - root["radius"]), self.root, at)]
        while queue:
            bound, name, at = heapq.heappop(queue)
            if bound > limit + slack:
                break
            node = self.nodes[name]
            if node["leaf"]:
                near = np.abs(at - node["d"]) <= limit + slack
                ids, scores = node["i"][near], dots(node["v"][near], query)
                self.computed += len(scores)
                for score, i in zip(scores.tolist(), ids.tolist()):
                    if i == own:
                        continue
                    if len(best) < k:
                        heapq.heappush(best, (score, -i))
                    elif (score, -i) > best[0]:
                        heapq.heapreplace(best, (score, -i))
                if len(best) == k:
                    limit = min(limit, max(0.0, span - 2.0 * best[0][0]) ** 0.5)
                continue
            kids, routers, radii, far = self.children[name]
            near = np.flatnonzero(np.abs(at - far) - radii <= limit + slack)
            away = distance(dots(routers[near], query))
            for j, d in zip(near.tolist(), away.tolist()):
                if (low := max(0.0, d - radii[j])) <= limit + slack:
                    heapq.heappush(queue, (low, kids[j], d))
        return sorted(((s, -i) for s, i in best), key=lambda x: (-x[0], x[1]))


def _search(k: int):
    out_schema = pa.schema([("query_id", pa.int64()), ("query_key", pa.int64()), ("vec_id", pa.int64()),
                            ("score", pa.int64())])

    def run(pages: pa.Table, queries: pa.Table) -> pa.Table:
        if not pages.num_rows or not queries.num_rows:
            return out_schema.empty_table()
        by_dim: dict[int, list[dict]] = defaultdict(list)
        for n in pages.to_pylist():
            by_dim[n["dim"]].append(n)
        trees = {dim: Tree(nodes) for dim, nodes in by_dim.items()}
        rows = []
        for q in queries.to_pylist():
            if (tree := trees.get(len(q["v"]))) is not None:
                rows += [(q["vec_id"], q["query_key"], i, s)
                         for s, i in tree.search(q["vec_id"], np.array(q["v"], np.int64), k, q["least"])]
        columns = list(zip(*rows)) if rows else [[]] * 4
        return pa.table([pa.array(c, pa.int64()) for c in columns], schema=out_schema)

    return run


def top_k(pages: DataFrame, queries: DataFrame, k: int = 10, block: int = 8192) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: of each query (vec_id, v) the k highest inner products in the index.

    A query meets vectors of its own dimension only, and never a row of its own id. Fewer than k candidates are all
    returned. Queries go against trees in blocks of ``block``; a repeated query row counts once. No query or an empty
    index gives no rows. A product that no long can hold is an error."""
    spark = queries.sparkSession
    ship(spark)
    asked = queries.select("vec_id", "v", F.xxhash64("v").alias("query_key")).distinct()
    blocks = max(1, -(-asked.count() // block))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    known = (pages.groupBy("cell").agg(F.max("pivot").alias("pivot"), F.max("cell_radius").alias("radius"),
                                       F.min("tree").alias("first"), F.max("tree").alias("last")).orderBy("cell").collect())
    cells = [(r.cell, r.pivot, r.radius) for r in known]  # as many as pivots, and one
    trees = spark.createDataFrame([(r.cell, r.first, r.last) for r in known], "cell int, first int, last int")
    tasks = tasks_for(pages, blocks * max([r.last + 1 for r in known], default=1), (blocks * len(known)) << 22)
    spread = pages.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).drop("cell", "pivot", "cell_radius")
    promising = _promising(cells)

    def ask(wanted: DataFrame) -> DataFrame:
        return (spread.repartition(tasks, "tree", "block").groupBy("tree", "block")
                .cogroup(wanted.repartition(tasks, "tree", "block").groupBy("tree", "block"))
                .applyInArrow(_search(k), "query_id long, query_key long, vec_id long, score long"))

    def placed(wanted: DataFrame) -> DataFrame:
        at = F.explode(promising(F.struct("v", "least"))).alias("cell")
        return wanted.select("*", at).join(F.broadcast(trees), "cell")

    tree = F.col("first") + F.pmod("query_key", F.col("last") - F.col("first") + 1).cast("int")
    home = settle(placed(asked.withColumn("least", F.lit(None).cast("long"))).withColumn("home", tree), "queries")
    found = settle(ask(home.withColumnRenamed("home", "tree")), "first-round")
    bounds = (found.groupBy("query_id", "query_key")
              .agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(-2 ** 63).alias("least")))
    again = (home.drop("cell", "first", "last", "least")
             .join(bounds.withColumnRenamed("query_id", "vec_id"), ["vec_id", "query_key"], "left")
             .withColumn("least", F.coalesce("least", F.lit(-2 ** 63))))
    again = (placed(again).withColumn("tree", F.explode(F.sequence("first", "last"))).where("tree <> home")
             .withColumn("least", F.when(F.col("least") > -2 ** 63, F.col("least"))))
    best = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return (found.unionByName(ask(again)).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def search_table(rows: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """Index all vectors of ``rows`` (vec_id, embedding) and ask with those whose id is divisible by ``every``."""
    vectors = settle(quantized(rows), "quantized")
    return top_k(build(vectors), vectors.where(F.col("vec_id") % every == 0), k)


ORACLE_SQL = """WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""
