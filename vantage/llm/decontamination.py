"""Benchmark decontamination: windows of benchmark words found in documents.

The benchmark's distinct windows (13 consecutive words; a shorter item is one window) are broadcast as a hash set over
word numbers. Its size is counted first. Beyond ``most_windows`` pairs of an item and a window, each distinct window gets an
id, the ids are dealt by hash into sets within the bound, and the documents pass by each set in turn, with what was found
written in between; the items of the windows found are joined at the end. So a window that every item shares is broadcast
once, and nothing that the driver or a worker holds grows with the benchmark.

A document is scanned once per set with numpy: words become numbers (0 for a word no window has), all windows of a
batch get a polynomial rolling hash at once, and what falls in the set is verified against the window's own words.
Nothing of the documents is shuffled, but for the windows found in the case of several sets.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.llm.common import batch_udf, col, free_name, plain_words, raw, settle, slices

BASE = np.uint64(0x9E3779B97F4A7C15)
WIDTH = 13
FOUND = "n_words long, starts array<int>, sizes array<int>, items array<string>"


def item_windows(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """Distinct (item, window) of (item_id, text): words joined by a space. Items without a word have none."""

    def make():
        def work(batch: pa.Array) -> pa.Array:
            out = []
            for text in raw(batch):
                words = [w.decode() for w in plain_words(text)]
                out.append([" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))] if words else [])
            return pa.array(out, pa.list_(pa.string()))

        return work

    return (benchmark.select(F.col("item_id").cast("string").alias("item"),
                             F.explode(batch_udf(make, "array<string>")(F.col("text"))).alias("window")).distinct())


class WindowSet:
    def __init__(self, rows: list[tuple[str | None, str]]) -> None:
        items: dict[bytes, set[str | None]] = {}
        for item, window in rows:
            items.setdefault(window.encode(), set()).add(item)
        self.numbers: dict[bytes, int] = {}
        self.items: dict[bytes, list[str]] = {}
        hashes: dict[int, list[int]] = {}
        for window, named in items.items():
            words = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in window.split(b" ")]
            line = np.array(words, np.int32)
            self.items[line.tobytes()] = [x for x in named if x is not None]
            hashes.setdefault(len(words), []).append(int(rolling(line, len(words))[0]))
        self.hashes = {n: np.unique(np.array(h, np.uint64)) for n, h in hashes.items()}

    def scan(self, line: np.ndarray) -> list[tuple[int, int, list[str]]]:
        """Verified occurrences (start, words, items) in a line of word numbers."""
        out = []
        for n, known in sorted(self.hashes.items()):
            if len(line) < n:
                continue
            gaps = np.concatenate([[0], np.cumsum(line == 0)])
            whole = np.flatnonzero(gaps[n:] == gaps[:-n])
            if not len(whole):
                continue
            keys = rolling(line, n)[whole]
            at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            for start in whole[known[at] == keys].tolist():
                if (items := self.items.get(line[start:start + n].tobytes())) is not None:
                    out.append((start, n, items))
        return out


def rolling(line: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hashes, modulo 2^64, of all windows of n numbers."""
    line = line.astype(np.uint64)
    span = len(line) - n + 1
    total = line[:span].copy()
    for j in range(1, n):
        total *= BASE
        total += line[j:j + span]
    return total


def _scan(spec):
    def make():
        known = spec.value
        number = known.numbers.get

        def work(batch: pa.Array) -> pa.Array:
            rows = []
            for part in slices(batch):
                docs = [plain_words(t) for t in raw(part)]
                ends = np.cumsum([len(d) + 1 for d in docs])  # a 0 after each document, which no window spans
                line = np.zeros(int(ends[-1]), np.int32)
                for d, end in zip(docs, ends.tolist()):
                    if d:
                        line[end - 1 - len(d):end - 1] = [number(w, 0) for w in d]
                found: dict[int, list] = {}
                for start, n, items in known.scan(line):
                    found.setdefault(int(np.searchsorted(ends, start, "right")), []).append((start, n, items))
                for i, d in enumerate(docs):
                    base = int(ends[i]) - len(d) - 1
                    hits = found.get(i, [])
                    rows.append({"n_words": len(d), "starts": [s - base for s, _, _ in hits],
                                 "sizes": [n for _, n, _ in hits],
                                 "items": sorted({x for _, _, named in hits for x in named})})
            return pa.array(rows, pa.struct([("n_words", pa.int64()), ("starts", pa.list_(pa.int32())),
                                             ("sizes", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))]))

        return work

    return make


def _covered(starts: list[int], sizes: list[int]) -> list[tuple[int, int]]:
    """The union of spans as disjoint (start, end), in order."""
    out: list[tuple[int, int]] = []
    for s, n in sorted(zip(starts, sizes)):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], s + n))
        else:
            out.append((s, s + n))
    return out


def _summary(found: pa.Array) -> pa.Array:
    rows = []
    for x in found.to_pylist():
        spans = _covered(x["starts"], x["sizes"])
        items = sorted(set(x["items"]))
        hit = sum(e - s for s, e in spans)
        rows.append({"n_words": x["n_words"], "n_hit": hit, "n_items": len(items), "items": items,
                     "items_sha256": hashlib.sha256(",".join(items).encode()).hexdigest(),
                     "contaminated": hit > 0 and 20 * hit >= x["n_words"],
                     "spans": [{"first": s, "end": e} for s, e in spans]})
    return pa.array(rows, pa.struct([
        ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items", pa.list_(pa.string())),
        ("items_sha256", pa.string()), ("contaminated", pa.bool_()),
        ("spans", pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())])))]))


SUMMARY = ("n_words long, n_hit long, n_items long, items array<string>, items_sha256 string, contaminated boolean, "
           "spans array<struct<first: int, end: int>>")


def scan(docs: DataFrame, benchmark: DataFrame, out: str = "found", width: int = WIDTH,
         most_windows: int = 500_000) -> DataFrame:
    """``docs`` with a struct column ``out``: n_words, n_hit (words inside any occurrence of a window), n_items and
    items (ids as sorted strings), items_sha256, contaminated (n_hit > 0 and 20 * n_hit >= n_words), spans (word ranges).

    Null and wordless texts have no words and are clean. An item with a null id hits words but isn't listed. An empty
    benchmark hits nothing. Repeated items count once, repeated documents stay."""
    windows = settle(item_windows(benchmark, width), "windows")
    spark = docs.sparkSession
    if windows.count() <= most_windows:  # one set, items included: scan and summary in one go
        search = _scan(spark.sparkContext.broadcast(WindowSet([(r.item, r.window) for r in windows.collect()])))
        return docs.withColumn(out, batch_udf(lambda: _then(search(), _summary), SUMMARY)(F.col("text")))
    # distinct windows get ids, which the scans find; whose windows they are is joined afterwards
    known = settle(windows.select("window").distinct().withColumn("wid", F.monotonically_increasing_id().cast("string")), "window-ids")
    passes = -(-5 * known.count() // (4 * most_windows))  # a quarter more than needed, as a hash deals unevenly
    rid = free_name(docs, "rid")
    got, names = settle(docs.withColumn(rid, F.monotonically_increasing_id()), "window-rows"), []
    for p in range(passes):
        rows = known.where(F.pmod(F.xxhash64("window"), F.lit(passes)) == p).select("wid", "window").collect()
        spec = spark.sparkContext.broadcast(WindowSet([(r.wid, r.window) for r in rows]))
        names.append(free_name(got, f"{out}_part{p}"))
        got = settle(got.withColumn(names[-1], batch_udf(_scan(spec), FOUND)(F.col("text"))), "window-pass")
    hits = got.select(col(rid).alias("r"), F.explode(F.array_distinct(F.concat(*(col(n)["items"] for n in names)))).alias("wid"))
    whose = known.join(windows, "window").where("item is not null").select("wid", "item")
    items = (hits.join(whose, "wid").select("r", "item").distinct().groupBy("r").agg(F.collect_list("item").alias("i"))
             .select(F.col("r").alias(f"{rid}_"), F.col("i").alias(f"{rid}_items")))
    got = got.join(items, col(rid) == col(f"{rid}_"), "left")
    joined = F.struct(col(names[0])["n_words"].alias("n_words"),
                      *(F.concat(*(col(n)[k] for n in names)).alias(k) for k in ("starts", "sizes")),
                      F.coalesce(col(f"{rid}_items"), F.array().cast("array<string>")).alias("items"))
    return got.withColumn(out, batch_udf(lambda: _summary, SUMMARY)(joined)).select(*map(col, docs.columns), col(out))


def _then(first, second):
    return lambda batch: second(first(batch))


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    got = scan(docs.select("doc_id", "text"), benchmark)
    return got.select("doc_id", *(f"found.{k}" for k in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")))


def _cut_spans(batch: pa.Array) -> pa.Array:
    import re

    word = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    out = []
    for x in batch.to_pylist():
        if not x["spans"]:
            out.append(x["text"])
            continue
        text = x["text"].encode()
        at = [(m.start(), m.end()) for m in word.finditer(text)]
        kept, last = [], 0
        for s in x["spans"]:
            kept.append(text[last:at[s["first"]][0]])
            last = at[s["end"] - 1][1]
        out.append(b"".join([*kept, text[last:]]).decode())
    return pa.array(out, pa.string())


def clean(docs: DataFrame, benchmark: DataFrame, spans: bool = False) -> DataFrame:
    """``docs``, all columns, without its contaminated documents; with ``spans``, documents stay and the hit words go
    from their text (from the first word of a span to its last, whatever stands between)."""
    name = free_name(docs, "found")
    got = scan(docs, benchmark, name)
    if not spans:
        return got.where(~col(name)["contaminated"]).select(*map(col, docs.columns))
    cut = batch_udf(lambda: _cut_spans, "string")(F.struct(F.col("text").alias("text"), col(name)["spans"].alias("spans")))
    return got.withColumn("text", cut).select(*map(col, docs.columns))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE_SQL = rf"""WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, CASE WHEN len(w) < 13 THEN w ELSE w[i:i + 12] END AS win
       FROM b, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT len(win) AS n FROM bw),
d AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents),
dw AS (SELECT r, i, n, w[i:i + n - 1] AS win
       FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT DISTINCT dw.r, dw.i, dw.n, bw.item FROM dw JOIN bw ON dw.win = bw.win),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
named AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN named USING (r)"""
