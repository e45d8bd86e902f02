"""Connected components of an edge list by alternating star contraction, as DataFrame joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.llm.common import settle


def with_least(rows: DataFrame, key: str, value: str, within: str, out: str) -> DataFrame:
    """``rows`` with ``out``, the least ``value`` among the rows of its ``key``.

    A key is dealt out over as many parts as there are shuffle partitions, by the hash of ``within``: minima are taken per
    part, then per key, and go back by part. No task meets all rows of a key that many rows share."""
    parts = max(64, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.withColumn("part", F.pmod(F.xxhash64(within), F.lit(parts)))
    partial = dealt.groupBy(key, "part").agg(F.min(value).alias(out))
    least = partial.groupBy(key).agg(F.min(out).alias(out))
    return dealt.join(partial.select(key, "part").join(least, key), [key, "part"]).drop("part")


def _mark(edges: DataFrame) -> tuple:
    """What two equal sets of edges share: one row to the driver."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")),
                           F.sum(F.xxhash64("b", "a").cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """From edges (a, b) of longs to (node, root), root the least node of its component; the roots' own rows included.

    Nodes without an edge to another node don't occur in the result. Each round is written to the shared checkpoint
    folder. The large star links every greater neighbour of a node to its least neighbour, the small star links the
    lesser neighbours and the node itself; rounds grow with the logarithm of the longest chain."""
    now = settle(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                 "edges")
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = (with_least(both, "a", "b", "b", "m").where("b > a")
                 .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct())
        large = settle(large, "large-star")
        small = (with_least(large, "a", "b", "b", "m")
                 .select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
                                           F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
                 .select("e.a", "e.b").where("a <> b").distinct())
        now = settle(small, "small-star")
        last, mark = mark, _mark(now)
        if mark == last:
            break
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
