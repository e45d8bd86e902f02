"""Cross-tokenizer alignment with corpus-wide link counts by external spill counting.

Two tokenizers A and B cut the same bytes. Where a token of A and one of B end together, they are linked, and such ends cut
both sequences into groups. How often a pair (a, b) is linked in the whole corpus is counted outside of memory, and what
each document's links count goes back to the document:

1. Spill. A task aligns its texts and collects (b, a, document) records. Every ``spill`` records make a *slice*: one sort
   radix-partitions them by B's id and orders each part side-major, by (b, a, document). Each part is a run: its pairs with
   their counts, and the documents behind them, in zstd. Runs are rows of a table in the shared folder.
2. Merge. The runs of one radix are merged by a heap, at most about ``fan`` at a time and in as many passes as that takes.
   Pairs are added up, so a pair that a third of all links share is one entry a run. In side-major order all pairs of a B
   id stand together, which gives the id's highest count as the last pass ends.
3. Stream back. The merged counts go down the same tree of merges: each run gets its own pairs' totals from the run it went
   into. At the bottom a slice adds up its runs' totals by document; documents meet them by (slice, place in the slice).

No step gathers a pair's documents or a document's pairs beyond one slice, and only pairs, not records, are shuffled up and
down. A task lost on the way is done again from the written runs; a slice is known by a name that only its task's committed
attempt has.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import uuid
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vantage.llm.bpe import byte_symbols
from vantage.llm.common import col, fresh_path, resident, settle, settle_in, ship, slices, tokenizer_path, uncollected

#: Records of a slice; a text's records stay together.
SPILL = 2_000_000
#: Parts that a slice is dealt into by B's id (a power of two).
RADICES = 32
#: Runs merged at a time, about.
FAN = 64
#: Bytes of text that are aligned at a time; a longer text whole.
PART = 4 << 20
#: Chunks remembered at a time, twice: what was used since the last turn, and before; and how many are encoded at once.
CACHE, AT_ONCE = 150_000, 20_000
#: Entries of a run that a merge holds unpacked.
BLOCK = 4096

ID_BITS, DOC_BITS = 21, 22
SPACE_MARK = "▁"
_LOOSE = regex.compile(r"\A | (?=\s)|(?<=\s) | \Z")
_SINGLE = regex.compile(r"(?<=\S) (?=\S)")
#: n_a, n_b, links, the links as int64 bytes, and the groups written out; nothing of a chunk that doesn't join.
Chunk = tuple[int, int, int, bytes, str]


# ------------------------------------------------------------------ the two tokenizers
class Tokenizers:
    """A (byte-level, a ``tokenizers`` file's content) and B (sentence pieces, a model file's content)."""

    def __init__(self, a: bytes, b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_str(a.decode())
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        value = {c: b for b, c in enumerate(byte_symbols())}
        size = self.a.get_vocab_size(with_added_tokens=True)
        self.a_bytes = [b""] * size
        for token, i in self.a.get_vocab(with_added_tokens=True).items():
            self.a_bytes[i] = bytes(value[c] for c in token) if all(c in value for c in token) else token.encode()
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace(SPACE_MARK, " ").encode())
        if max(len(self.a_bytes), len(self.b_bytes)) > 1 << ID_BITS:
            raise ValueError(f"vocabularies of more than {1 << ID_BITS} tokens")
        self.a_len = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], np.int64)
        self.a_text = [str(i) for i in range(len(self.a_bytes))]
        self.b_text = [str(i) for i in range(len(self.b_bytes))]
        pieces = [self.b.id_to_piece(i) for i in range(len(self.b_bytes))]
        every = " ".join(chr(c) for c in range(0x21, 0x110000) if not (0xD800 <= c < 0xE000 or chr(c).isspace()))
        # no piece goes on over a space and B keeps every character: then texts may be cut before single spaces
        self.cuttable = (not any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in pieces)
                         and self.b.normalize(every).replace(SPACE_MARK, " ").strip() == every.replace(SPACE_MARK, " ").strip())
        self.young: dict[str, Chunk] = {}
        self.old: dict[str, Chunk] = {}

    def chunks(self, text: str | None) -> list[str]:
        """A text cut at its single spaces. Both encode such a chunk, with a space before it, as they do within the text,
        and their tokens end together at its end."""
        if not text:
            return []
        if not self.cuttable:
            return [text]
        return text.split(" ") if _LOOSE.search(text) is None else _SINGLE.split(text)

    def encode(self, chunks: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """Both token sequences of every chunk; none of one whose tokens don't join to a space and the chunk."""
        a = self.a.encode_batch_fast([" " + c for c in chunks], add_special_tokens=False)
        for chunk, x, ids_b in zip(chunks, a, self.b.encode(chunks, num_threads=1)):
            own, ids_a = b" " + chunk.encode(), x.ids
            same = b"".join([self.a_bytes[i] for i in ids_a]) == own == b"".join([self.b_bytes[i] for i in ids_b])
            yield (ids_a, ids_b) if same else ([], [])

    def aligned(self, chunks: list[str]) -> list[Chunk]:
        """What the chunks contribute to their texts, all aligned at once."""
        coded = list(self.encode(chunks))
        n_a, n_b = np.array([len(x) for x, _ in coded], np.int64), np.array([len(x) for _, x in coded], np.int64)
        a = np.fromiter((i for x, _ in coded for i in x), np.int64, int(n_a.sum()))
        b = np.fromiter((i for _, x in coded for i in x), np.int64, int(n_b.sum()))
        # one after another: both sequences reach a chunk's end together, so ends are compared over all of them
        end_a, end_b = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        common, at_a, at_b = np.intersect1d(end_a, end_b, assume_unique=True, return_indices=True)
        owner = np.searchsorted(np.concatenate([[0], end_a])[np.cumsum(n_a)], common)
        links = np.bincount(owner, minlength=len(chunks))
        edge = np.concatenate([[0], np.cumsum(links)]).tolist()
        pairs = b[at_b] << ID_BITS | a[at_a]
        return [(x, y, z, pairs[lo:hi].tobytes(), said) for x, y, z, lo, hi, said in zip(
            n_a.tolist(), n_b.tolist(), links.tolist(), edge, edge[1:], self._written(a, b, at_a, at_b, links))]

    def align(self, texts: list[str | None]) -> tuple[dict[str, object], np.ndarray]:
        """Per text n_a, n_b, n_groups, n_links and the groups written out; and all links in order, b << 21 | a."""
        cut = [self.chunks(t) for t in texts]
        here = dict.fromkeys(c for parts in cut for c in parts)
        fresh = []
        for c in here:
            if (found := self.young.get(c) or self.old.get(c)) is None:
                fresh.append(c)
            here[c] = found
        for at in range(0, len(fresh), AT_ONCE):
            here.update(zip(some := fresh[at:at + AT_ONCE], self.aligned(some)))
        if len(self.young) > CACHE:
            self.old, self.young = self.young, {}
        self.young.update((c, x) for c, x in here.items() if len(c) <= 64)
        n_a, n_b, links, pairs, written = [], [], [], [], []
        for parts in cut:
            found = [here[c] for c in parts]
            x, y, z, p, said = zip(*found) if found else ((0,), (0,), (0,), (), ())
            if not all(x):  # a chunk's tokens don't join to it, so the text's don't
                x, y, z, p, said = (0,), (0,), (0,), (), ()
            n_a.append(sum(x))
            n_b.append(sum(y))
            links.append(sum(z))
            pairs += p
            written.append(";".join(said))
        columns = {"n_a": np.array(n_a, np.int64), "n_b": np.array(n_b, np.int64), "n_groups": np.array(links, np.int64),
                   "n_links": np.array(links, np.int64), "alignment": written}
        return columns, np.frombuffer(b"".join(pairs), np.int64)

    def _written(self, a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray, groups: np.ndarray) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` per text."""
        say_a, say_b = self.a_text, self.b_text
        a, b, out, i, j = a.tolist(), b.tolist(), [], 0, 0
        ends = zip(at_a.tolist(), at_b.tolist())
        for n in groups.tolist():
            said = []
            for _, (x, y) in zip(range(n), ends):
                left = say_a[a[x]] if x == i else ",".join([say_a[t] for t in a[i:x + 1]])
                right = say_b[b[y]] if y == j else ",".join([say_b[t] for t in b[j:y + 1]])
                said.append(f"{left}|{right}")
                i, j = x + 1, y + 1
            out.append(";".join(said))
        return out


def _tokenizers(spec) -> Tokenizers:
    a, b, key = spec.value
    return resident(__name__, key, lambda: Tokenizers(a, b))


# ------------------------------------------------------------------ runs
def pack(values: np.ndarray) -> bytes:
    """Values as zstd over their bytes, all first bytes first."""
    return zstandard.ZstdCompressor(level=1).compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes())


def unpack(blob: bytes, dtype=np.int64) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(np.dtype(dtype).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=0))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob))


def spill(pairs: np.ndarray, doc: np.ndarray, radices: int) -> Iterator[dict]:
    """The runs of a slice from its links. A run's ``keys`` are its pairs, b << 21 | a, ascending; ``counts`` their links;
    ``docs_each`` the number of documents of each pair, and ``places`` and ``links`` each one's place in the slice and its
    links."""
    b, a = pairs >> ID_BITS, pairs & (1 << ID_BITS) - 1
    bits = radices.bit_length() - 1
    turned = (b & radices - 1) << ID_BITS - bits | b >> bits  # the radix on top, else in b's order
    records = np.sort((turned << ID_BITS | a).astype(np.uint64) << np.uint64(DOC_BITS) | doc.astype(np.uint64))
    first = np.flatnonzero(np.diff(records, prepend=np.uint64(~records[0])) != 0) if len(records) else np.zeros(0, np.int64)
    links = np.diff(first, append=len(records))
    records = records[first]
    pair = (records >> np.uint64(DOC_BITS)).astype(np.int64)
    place = (records & np.uint64((1 << DOC_BITS) - 1)).astype(np.uint32)
    turned = pair >> ID_BITS
    key = ((turned & (1 << ID_BITS - bits) - 1) << bits | turned >> ID_BITS - bits) << ID_BITS | pair & (1 << ID_BITS) - 1
    radix = turned >> ID_BITS - bits
    edges = np.searchsorted(radix, np.arange(radices + 1))
    for r, (lo, hi) in enumerate(zip(edges.tolist(), edges[1:].tolist())):
        if lo < hi:
            keys = key[lo:hi]
            new = np.flatnonzero(np.diff(keys, prepend=-1))
            yield {"radix": r, "keys": pack_sorted(keys[new]), "counts": pack(np.add.reduceat(links[lo:hi], new)),
                   "docs_each": pack(np.diff(new, append=hi - lo).astype(np.uint32)), "places": pack(place[lo:hi]),
                   "links": pack(links[lo:hi].astype(np.uint32))}


def _entries(keys: bytes, counts: bytes) -> Iterator[tuple[int, int]]:
    """A run's (pair, count) in order, a block at a time."""
    k, c = unpack_sorted(keys), unpack(counts)
    for at in range(0, len(k), BLOCK):
        yield from zip(k[at:at + BLOCK].tolist(), c[at:at + BLOCK].tolist())


def merged(runs: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs and their counts over all the runs: a k-way heap merge that adds up equal pairs."""
    stream = heapq.merge(*(_entries(*r) for r in runs))
    out = [(key, sum(c for _, c in same)) for key, same in groupby(stream, itemgetter(0))] if len(runs) > 1 else list(stream)
    both = np.array(out, np.int64).reshape(-1, 2)
    return np.ascontiguousarray(both[:, 0]), np.ascontiguousarray(both[:, 1])


def highest(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether each pair has its B id's highest count; the pairs of a B id stand together."""
    if not len(keys):
        return np.zeros(0, bool)
    side = keys >> ID_BITS
    first = np.flatnonzero(np.diff(side, prepend=-1))
    return counts == np.repeat(np.maximum.reduceat(counts, first), np.diff(first, append=len(keys)))


# ------------------------------------------------------------------ Spark
RUN = "radix int, keys binary, counts binary, docs_each binary, places binary, links binary"
DOC = "place int, n_a long, n_b long, n_groups long, n_links long, alignment string"


def _spec(docs: DataFrame, a_path: str | None, b_path: str | None):
    """Both files' content (1.6 and 0.5 MB here, whatever the documents)."""
    parts = []
    for path in (a_path or tokenizer_path("byte_bpe_50k.json"), b_path or tokenizer_path("piece_bpe_32k.model")):
        with open(path, "rb") as f:
            parts.append(f.read())
    return docs.sparkSession.sparkContext.broadcast((*parts, hashlib.sha256(b"".join(parts)).hexdigest()))


def spilled(docs: DataFrame, spec, text: str, keep: tuple[str, ...], spill_records: int, radices: int) -> DataFrame:
    """Step 1: rows of two kinds, documents (0) and runs (1), each with its slice."""
    rows = docs.select(*map(col, keep), col(text))
    names = [f"_keep{i}" for i in range(len(keep))]
    fields = [f"{n} {f.dataType.simpleString()}" for n, f in zip(names, rows.schema.fields)]
    schema = ", ".join(["kind int", "slice string", *fields, DOC, RUN])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle_in(__name__)
        both = _tokenizers(spec)
        name, placed, held, parts = uuid.uuid4().hex, 0, 0, []
        types: pa.Schema | None = None

        def batch_of(n: int, **columns) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in types],
                                              schema=types)

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal name, placed, held, parts
            pairs, doc = (np.concatenate(x) for x in zip(*parts))
            for r in spill(pairs, doc, radices):
                yield batch_of(1, kind=pa.array([1], pa.int32()), slice=pa.array([name]), radix=pa.array([r["radix"]], pa.int32()),
                               **{k: pa.array([v], pa.binary()) for k, v in r.items() if k != "radix"})
            name, placed, held, parts = uuid.uuid4().hex, 0, 0, []

        for batch in batches:
            if types is None:
                kept = [pa.field(n, batch.column(i).type) for i, n in enumerate(names)]
                types = pa.schema([("kind", pa.int32()), ("slice", pa.string()), *kept, ("place", pa.int32()),
                                   *((n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")), ("alignment", pa.string()),
                                   ("radix", pa.int32()), *((n, pa.binary()) for n in ("keys", "counts", "docs_each", "places", "links"))])
            at = 0
            for part in slices(batch.column(len(keep)), PART):
                with uncollected():
                    found, pairs = both.align(part.to_pylist())
                n = len(part)
                yield batch_of(n, kind=pa.array(np.zeros(n, np.int32)), slice=pa.array([name] * n),
                               place=pa.array(np.arange(placed, placed + n, dtype=np.int32)),
                               **{k: pa.array(v) for k, v in found.items()},
                               **{names[i]: batch.column(i).slice(at, n) for i in range(len(keep))})
                parts.append((pairs, np.repeat(np.arange(placed, placed + n), found["n_links"])))
                at, placed, held = at + n, placed + n, held + len(pairs)
                if held >= spill_records or placed >= 1 << DOC_BITS - 1:
                    yield from close()
        if placed:
            yield from close()

    return rows.mapInArrow(run, schema)


def _fold(table: pa.Table, last: bool) -> pa.Table:
    keys, counts = merged(list(zip(table["keys"].to_pylist(), table["counts"].to_pylist())))
    best = highest(keys, counts) if last else np.zeros(0, bool)
    return pa.table({"radix": table["radix"][:1].cast(pa.int32()), "run": table["parent"][:1].cast(pa.int64()),
                     "keys": pa.array([pack_sorted(keys)], pa.binary()), "counts": pa.array([pack(counts)], pa.binary()),
                     "best": pa.array([pack(best)], pa.binary())})


def _merge(runs: DataFrame, last: bool) -> DataFrame:
    """Step 2, one pass: the runs with the same radix and parent become one run, named like the parent."""
    return (runs.select("radix", "parent", "keys", "counts").groupBy("radix", "parent")
            .applyInArrow(lambda t: _fold(t, last), "radix int, run long, keys binary, counts binary, best binary"))


def _answer(children: pa.Table, parent: pa.Table) -> pa.Table:
    row = parent.select(["keys", "counts", "best"]).to_pylist()[0]
    keys, counts, best = unpack_sorted(row["keys"]), unpack(row["counts"]), unpack(row["best"], np.bool_)
    out = []
    for own in children["keys"].to_pylist():
        at = np.searchsorted(keys, unpack_sorted(own))
        out.append((pack(counts[at]), pack(best[at])))
    return pa.table({"run": children["run"], "radix": children["radix"].cast(pa.int32()), "keys": children["keys"].cast(pa.binary()),
                     "counts": pa.array([x for x, _ in out], pa.binary()), "best": pa.array([y for _, y in out], pa.binary())})


def _answered(children: DataFrame, parents: DataFrame) -> DataFrame:
    """Step 3, one pass down: each child run's pairs with the totals and marks of the run it went into."""
    kind = dict(children.dtypes)["run"]
    return (children.select("run", "radix", "parent", "keys").groupBy("radix", "parent")
            .cogroup(parents.withColumnRenamed("run", "parent").groupBy("radix", "parent"))
            .applyInArrow(_answer, f"run {kind}, radix int, keys binary, counts binary, best binary"))


def _sums(behind: pa.Table, answers: pa.Table) -> pa.Table:
    """A slice's contributions by document."""
    by_radix = {r: (c, m) for r, c, m in zip(answers["radix"].to_pylist(), answers["counts"].to_pylist(), answers["best"].to_pylist())}
    n_best, total = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for r, each, places, links in zip(*(behind[c].to_pylist() for c in ("radix", "docs_each", "places", "links"))):
        each, places, links = (unpack(x, np.uint32).astype(np.int64) for x in (each, places, links))
        if len(places) and (most := int(places.max()) + 1) > len(total):
            n_best, total = (np.concatenate([x, np.zeros(most - len(x), np.int64)]) for x in (n_best, total))
        counts, best = by_radix[r]
        np.add.at(total, places, np.repeat(unpack(counts), each) * links)
        np.add.at(n_best, places, np.repeat(unpack(best, np.bool_).astype(np.int64), each) * links)
    name = behind["slice"][0].as_py() if len(behind) else None
    return pa.table({"slice": pa.array([name] * len(total), pa.string()), "place": pa.array(np.arange(len(total), dtype=np.int32)),
                     "n_best": pa.array(n_best), "count_sum": pa.array(total)})


class Counted:
    """Aligned documents with corpus-wide counts. ``documents()`` and ``pairs()`` are DataFrames.

    ``keep`` are columns of ``docs`` to carry; ``derive`` names further columns made of n_a, n_b, n_groups, n_links and
    alignment before anything is written (default: the alignment itself, ``a1,a2|b1;a3|b2,b3``). ``a_path`` is
    a byte-level ``tokenizers`` file, applied to a space and the text; ``b_path`` a sentence-piece model, applied to the
    text. No string is a special token. A text that is null or empty, or whose tokens don't join to a space and the text
    in both (white space or characters that a tokenizer changes), has no tokens: zeros and an empty alignment. Repeated
    rows each count. A text's records stay in one slice, so ``spill`` bounds a slice but for its last few megabytes of text.
    """

    def __init__(self, docs: DataFrame, a_path: str | None = None, b_path: str | None = None, text: str = "text",
                 keep: tuple[str, ...] = ("doc_id",), derive: dict[str, Column] | None = None, spill: int = SPILL,
                 radices: int = RADICES, fan: int = FAN):
        if radices & radices - 1 or not 0 < radices <= 1 << ID_BITS:
            raise ValueError("radices must be a power of two")
        spark = docs.sparkSession
        ship(spark)
        self.keep, self.derive, self.fan = keep, dict(derive or {"alignment": F.col("alignment")}), fan
        rows = spilled(docs, _spec(docs, a_path, b_path), text, keep, spill, radices)
        rows = rows.withColumns({f"_own{i}": c for i, c in enumerate(self.derive.values())}).drop("alignment")
        path = fresh_path(spark, "alignment")
        rows.write.partitionBy("kind").parquet(path)
        self.written = spark.read.schema(rows.schema).parquet(path)
        self.levels = self._count()

    def _count(self) -> list[DataFrame]:
        """All passes up: the runs, then each pass's result; in the last one a radix is one run."""
        runs = self.written.where("kind = 1").select(F.col("slice").alias("run"), "radix", "keys", "counts")
        groups = -(-runs.select("run").distinct().count() // self.fan) or 1  # one number; slices are some millions of records
        levels = [runs.withColumn("parent", F.pmod(F.xxhash64("run"), F.lit(groups)))]
        while True:
            made = settle(_merge(levels[-1], groups == 1), "alignment-merged")
            if groups == 1:
                return [*levels, made]
            groups = -(-groups // self.fan)
            levels.append(made.withColumn("parent", F.pmod("run", F.lit(groups))))

    def pairs(self) -> DataFrame:
        """a, b, count, best (whether it is b's highest) of every linked pair of the corpus."""
        def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k, c, m in zip(*(batch.column(i).to_pylist() for i in range(3))):
                    keys = unpack_sorted(k)
                    yield pa.RecordBatch.from_arrays([pa.array(keys & (1 << ID_BITS) - 1), pa.array(keys >> ID_BITS),
                                                      pa.array(unpack(c)), pa.array(unpack(m, np.bool_))], ["a", "b", "count", "best"])

        return self.levels[-1].select("keys", "counts", "best").mapInArrow(tell, "a long, b long, count long, best boolean")

    def documents(self) -> DataFrame:
        """``keep``, n_a, n_b, n_groups, n_links, the derived columns, n_best and count_sum of every row."""
        down = self.levels[-1]
        for level in self.levels[-2::-1]:
            down = _answered(level, down)
        behind = self.written.where("kind = 1").select("slice", "radix", "docs_each", "places", "links")
        sums = (behind.groupBy("slice").cogroup(down.select(F.col("run").alias("slice"), "radix", "counts", "best").groupBy("slice"))
                .applyInArrow(_sums, "slice string, place int, n_best long, count_sum long"))
        docs = self.written.where("kind = 0")
        own = [F.col(f"_keep{i}").alias(k) for i, k in enumerate(self.keep)]
        more = [F.col(f"_own{i}").alias(k) for i, k in enumerate(self.derive)]
        return docs.join(sums, ["slice", "place"], "left").select(
            *own, "n_a", "n_b", "n_groups", "n_links", *more, *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_best", "count_sum")))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 ('' without tokens) of every row."""
    said = F.when(F.col("n_a") == 0, "").otherwise(F.sha2(F.col("alignment"), 256))
    return Counted(docs, derive={"groups_sha256": said}).documents().select(
        F.col("doc_id").cast("long").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
