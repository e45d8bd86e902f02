"""SimHash near-dedup with anchor-point covering.

A fingerprint is cut into ``bands`` runs of bits. Two fingerprints at most ``distance`` bits apart are, in one band at
least, at most ``distance // bands`` apart. The anchors of a band are a linear covering code of radius 1 (parity check
columns: all non-zero 4-bit syndromes, repeated over the band's width). A fingerprint is replicated to every anchor
within covering radius + band threshold of its band value: if x and y lie within the threshold, both reach the anchor
nearest to x. Fingerprints that share an anchor are compared on all 64 bits. With 21 + 21 + 22 bits and distance 4 that
is about 44 anchors per distinct fingerprint; an anchor sees 1 in 9,000 of unrelated fingerprints. One code over all 64
bits would need thousands of anchors per fingerprint, or anchors that each see most of the table.

Copies share one fingerprint and are compared once. An anchor with over ``most`` members is dealt out over pairs of
blocks, so no group is unbounded. Of an anchor's links a spanning forest is kept, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vantage.llm.common import batch_udf, col, free_name, raw, settle, settle_in, ship, tasks_for
from vantage.llm.components import components, with_least

CHECK_BITS = 4


def fingerprint(text: bytes | None, words: int = 4, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash of UTF-8 text; 0 for a null or wordless text."""
    from xxhash import xxh64_intdigest as xx

    tokens = (text or b"").lower().split()  # of bytes: A-Z only, and \x20 \x09-\x0D only
    if not tokens:
        return 0
    flat = b" ".join(tokens)
    if len(tokens) <= words:
        return xx(flat, seed)
    ends = list(accumulate(len(t) + 1 for t in tokens))
    hashes = np.fromiter((xx(flat[s:e - 1], seed) for s, e in zip([0, *ends], ends[words - 1:])), np.uint64,
                         len(tokens) - words + 1)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 15):
        part = np.ascontiguousarray(hashes[i:i + (1 << 15)]).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(words: int):
    def make():
        return lambda batch: pa.array(np.array([fingerprint(t, words) for t in raw(batch)], np.uint64).view(np.int64))

    return batch_udf(make, "long")


@lru_cache
def coset_patterns(width: int, radius: int) -> list[list[int]]:
    """Per syndrome the error patterns of at most ``radius`` bits: x ^ pattern runs through the codewords near x."""
    out: list[list[int]] = [[] for _ in range(1 << CHECK_BITS)]
    for k in range(radius + 1):
        for bits in combinations(range(width), k):
            syndrome = 0
            for b in bits:
                syndrome ^= check_column(b)
            out[syndrome].append(sum(1 << b for b in bits))
    return out


def check_column(bit: int) -> int:
    return bit % ((1 << CHECK_BITS) - 1) + 1


def band_widths(bands: int) -> list[int]:
    return [64 * (i + 1) // bands - 64 * i // bands for i in range(bands)]


def _around(band: int, value: Column):
    return lambda pattern: F.struct(F.lit(band).alias("band"), value.bitwiseXOR(pattern.cast("long")).alias("anchor"))


def anchored(prints: DataFrame, distance: int = 4, bands: int = 3) -> DataFrame:
    """From distinct fingerprints (fp) to rows (band, anchor, fp)."""
    parts, shift = [], 0
    for band, width in enumerate(band_widths(bands)):
        value = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1))
        syndrome = F.lit(0)
        for i in range(CHECK_BITS):
            mask = sum(1 << b for b in range(width) if check_column(b) >> i & 1)
            syndrome = syndrome + F.bit_count(value.bitwiseAND(F.lit(mask))) % 2 * (1 << i)
        patterns = coset_patterns(width, 1 + distance // bands)
        near = F.element_at(F.array(*(F.array(*map(F.lit, p)) for p in patterns)), (syndrome + 1).cast("int"))
        parts.append(F.transform(near, _around(band, value)))
        shift += width
    return prints.select("fp", F.explode(F.concat(*parts)).alias("at")).select("at.band", "at.anchor", "fp")


def _forest(fps: np.ndarray, ends: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows sorted by group; ``ends[i]`` is where row i's group ends. Index pairs that span the links of each group."""
    label = np.arange(len(fps))
    left, right = [], []
    rows = np.arange(len(fps))
    step = 0
    while True:
        step += 1
        rows = rows[rows + step < ends[rows]]
        if not len(rows):
            break
        hit = rows[np.bitwise_count(fps[rows] ^ fps[rows + step]) <= distance]
        hit = hit[label[hit] != label[hit + step]]
        if not len(hit):
            continue
        left.append(hit)
        right.append(hit + step)
        a, b = hit, hit + step
        while len(a):
            low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
            np.minimum.at(label, high, low)
            while (deeper := label[label] != label).any():
                label[deeper] = label[label[deeper]]
            apart = label[a] != label[b]
            a, b = a[apart], b[apart]
    none = np.array([], np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _links(distance: int, chunk: int = 1 << 16):
    """Over partitions sorted by (band, anchor, i, j): edges (a, b) of each group's spanning forest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle_in(__name__)
        held: list[np.ndarray] = []

        def edges(rows: np.ndarray) -> pa.RecordBatch:
            cut = np.flatnonzero((rows[:-1, :4] != rows[1:, :4]).any(axis=1)) + 1
            bounds = np.concatenate([[0], cut, [len(rows)]])
            ends = np.repeat(bounds[1:], np.diff(bounds))
            fps = np.ascontiguousarray(rows[:, 4]).view(np.uint64)  # bitwise_count takes absolute values
            a, b = _forest(fps, ends, distance)
            return pa.RecordBatch.from_arrays([pa.array(fps[a].view(np.int64)), pa.array(fps[b].view(np.int64))], ["a", "b"])

        size = 0
        for batch in batches:
            held.append(np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
                                  for c in batch.columns], axis=1))
            size += len(held[-1])
            if size < chunk:
                continue
            rows = np.concatenate(held)
            new = np.flatnonzero((rows[:-1, :4] != rows[1:, :4]).any(axis=1))
            if len(new):  # the last group may go on in the next batch
                yield edges(rows[:new[-1] + 1])
                rows = rows[new[-1] + 1:]
            held, size = [rows], len(rows)
        if size:
            yield edges(np.concatenate(held))

    return run


def links(prints: DataFrame, distance: int = 4, bands: int = 3, most: int = 4096) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (fp) that connect whatever lies within ``distance`` bits.

    ``most``: members of an anchor that are compared in one group; a larger anchor is dealt out over pairs of blocks,
    each pair a group of its own, so every pair of members still meets."""
    ship(prints.sparkSession)
    copies = sum(max(map(len, coset_patterns(w, 1 + distance // bands))) for w in band_widths(bands))
    count = prints.count()
    near = anchored(prints.repartition(tasks_for(prints, count, count * copies * 32), "fp"), distance, bands)
    hot = near.groupBy("band", "anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)
    hot = settle(hot.select("band", "anchor", F.ceil(F.col("n") * 2 / most).cast("int").alias("blocks")), "hot-anchors")
    block = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(
        F.least(block, j).alias("i"), F.greatest(block, j).alias("j")))
    whole = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))
    dealt = (near.join(hot, ["band", "anchor"], "left")
             .select("band", "anchor", F.explode(F.when(F.col("blocks").isNull(), whole).otherwise(pairs)).alias("g"), "fp")
             .select("band", "anchor", "g.i", "g.j", "fp"))
    return (dealt.repartition("band", "anchor", "i", "j").sortWithinPartitions("band", "anchor", "i", "j", "fp")
            .mapInArrow(_links(distance), "a long, b long").distinct())


def grouped(docs: DataFrame, words: int = 4, distance: int = 4, key: str = "doc_id") -> DataFrame:
    """(key, fp, component): component is the smallest key reachable over fingerprints within ``distance`` bits.

    Null and wordless texts have fingerprint 0 and link like any other. Repeated rows stay rows of their own. A null
    key counts as the largest. Other columns are ignored; an empty table gives no rows."""
    rows = settle(docs.select(col(key).alias("k"), _fingerprints(words)(F.col("text")).alias("fp")), "fingerprints")
    return (rows.join(_named(rows, "k", "component", distance), "fp")
            .select(F.col("k").alias(key), "fp", "component"))


def _named(rows: DataFrame, rank: str, out: str, distance: int) -> DataFrame:
    """(fp, ``out``): of each distinct fingerprint of ``rows`` the least ``rank`` in its component."""
    prints = settle(rows.groupBy("fp").agg(F.min(rank).alias(rank)), "prints")
    roots = components(links(prints.select("fp"), distance)).withColumnRenamed("node", "fp")
    linked = settle(prints.join(roots, "fp"), "linked")
    best = with_least(linked, "root", rank, "fp", out).select("fp", out)
    return prints.join(best, "fp", "left").select("fp", F.coalesce(out, rank).alias(out))


def hex_fingerprint(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def deduplicate(docs: DataFrame, words: int = 4, distance: int = 4) -> DataFrame:
    """The rows of ``docs``, all columns, of which one of each group stays: that with the smallest doc_id (null counts
    as the largest; of repeated rows, any one).

    The rows are numbered and written once. What goes is an anti-join on that number, whose smaller side Spark
    broadcasts only if its size on disk allows."""
    rid, fp = free_name(docs, "rid"), free_name(docs, "fp")
    marked = settle(docs.withColumn(rid, F.monotonically_increasing_id())
                    .withColumn(fp, _fingerprints(words)(F.col("text"))), "dedup-rows")
    rank = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("doc_id"), col(rid).alias("rid"))
    rows = marked.select(rank.alias("rank"), col(fp).alias("fp"))
    gone = settle(rows.join(_named(rows, "rank", "best", distance), "fp").where("rank.rid <> best.rid").select(F.col("rank.rid").alias(rid)), "dedup-gone")
    return marked.join(gone, rid, "left_anti").select(*map(col, docs.columns))
