"""Sharding by a hierarchical weighted hash tree (regions, racks, shards).

A row descends from the root: at each node every child draws ``-ln(u) / weight`` with ``u`` from XXH64 of the row's
key and the child's name, and the least draw wins. A child's chance is its weight's share of its siblings' weights.
A child's draw depends on its own name and weight alone, so a change moves rows only into (or out of) subtrees whose
weight changed, and leaves the order among all other children as it was.

A shard added by ``grown()`` opens a region of its own. No other region's weight changes, so rows move only into the
new shard. Everything is DataFrame expressions; the tree is one literal, bounded by the number of shards.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vantage.llm.common import col, free_name


@dataclass(frozen=True)
class Leaf:
    region: str
    rack: str
    shard: int
    weight: float = 1.0


@dataclass(frozen=True)
class HashTree:
    leaves: tuple[Leaf, ...]

    def __post_init__(self) -> None:
        if not any(x.weight > 0 for x in self.leaves):
            raise ValueError("a tree needs a shard of positive weight")
        if any(x.weight < 0 or not math.isfinite(x.weight) for x in self.leaves):
            raise ValueError("weights are finite and not negative")
        if len({x.shard for x in self.leaves}) != len(self.leaves):
            raise ValueError("shard numbers are distinct")

    @classmethod
    def uniform(cls, regions: int, racks: int, shards: int) -> HashTree:
        """``regions`` x ``racks`` x ``shards`` leaves of weight 1, numbered from 0."""
        return cls(tuple(Leaf(f"region{n // (racks * shards)}", f"rack{n // shards % racks}", n)
                         for n in range(regions * racks * shards)))

    def grown(self, weight: float = 1.0) -> HashTree:
        """One more shard, in a new region of its own."""
        n = max(x.shard for x in self.leaves) + 1
        return HashTree((*self.leaves, Leaf(f"region+{n}", "rack0", n, weight)))

    def reweighted(self, shard: int, weight: float) -> HashTree:
        return HashTree(tuple(replace(x, weight=weight) if x.shard == shard else x for x in self.leaves))

    def nodes(self) -> list[list[tuple[str, float, int]]]:
        """Per inner node its children (name, weight, next); node 0 is the root, a rack's children lead to shards."""
        regions: dict[str, dict[str, list[Leaf]]] = defaultdict(lambda: defaultdict(list))
        for x in self.leaves:
            if x.weight > 0:
                regions[x.region][x.rack].append(x)
        out: list[list[tuple[str, float, int]]] = [[]]
        for region, racks in sorted(regions.items()):
            at = len(out)
            out.append([])
            out[0].append((region, math.fsum(x.weight for r in racks.values() for x in r), at))
            for rack, leaves in sorted(racks.items()):
                out[at].append((f"{region}/{rack}", math.fsum(x.weight for x in leaves), len(out)))
                out.append([(f"{region}/{rack}/{x.shard}", x.weight, x.shard) for x in leaves])
        return out

    def place(self, *key: Column) -> Column:
        """The shard (int) of each row. Null keys take part like any other value: equal keys share a shard."""
        tree = F.array(*(F.array(*(F.struct(F.lit(name).alias("name"), F.lit(float(weight)).alias("weight"),
                                            F.lit(to).alias("to")) for name, weight, to in node))
                         for node in self.nodes()))

        def draw(child: Column) -> Column:
            u = (F.shiftrightunsigned(F.xxhash64(*key, child["name"]), 11) + F.lit(0.5)) * F.lit(2.0 ** -53)
            return F.struct((-F.log(u) / child["weight"]).alias("draw"), child["to"].alias("to"))

        at = F.lit(0)
        for _ in range(3):
            at = F.array_min(F.transform(F.element_at(tree, at + 1), draw))["to"]
        return at


def with_slots(df: DataFrame, shard: str, order: list[str], out: str = "slot", buckets: int = 1024) -> DataFrame:
    """Add ``out``: gapless numbers from 0 within each value of ``shard``.

    A shard is numbered by hash buckets of the ``order`` columns: rows within a bucket by a window, buckets by the
    running sum of their counts (at most shards x ``buckets`` rows, whatever the input). So no shard meets in one task."""
    if out in df.columns:
        raise ValueError(f"column {out} exists")
    bucket, base, rows = (free_name(df, x) for x in ("bucket", "base", "n_rows"))
    dealt = df.withColumn(bucket, F.pmod(F.xxhash64(*map(col, order)), F.lit(buckets)))
    before = Window.partitionBy(shard).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    bases = (dealt.groupBy(shard, bucket).agg(F.count(F.lit(1)).alias(rows))
             .select(shard, bucket, F.coalesce(F.sum(rows).over(before), F.lit(0)).alias(base)))
    within = F.row_number().over(Window.partitionBy(shard, bucket).orderBy(*map(col, order)))
    return (dealt.withColumn(out, within.cast("long")).join(bases, [shard, bucket])
            .withColumn(out, col(out) - 1 + col(base)).drop(bucket, base))


def shard_documents(docs: DataFrame, tree: HashTree | None = None) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    A null text counts as empty (size 1, CRC 0). Equal doc_ids, nulls among themselves too, share a shard. Repeated
    rows keep a slot each. An empty table gives no rows; other columns are ignored."""
    tree = tree or HashTree.uniform(2, 2, 4)
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.col("doc_id")
    rows = docs.select(
        key, (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"), tree.place(key).alias("shard"), tree.grown().place(key).alias("grown_shard"))
    return (with_slots(rows, "shard", ["doc_id", "text_crc32", "size"])
            .select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"))
