"""Byte-level BPE as a tree reduction over a monoid.

The elements are token sequences, each the encoding of its own bytes; the neutral element is the empty one. Two
neighbours are joined by encoding a window around their seam anew: at first one token of each, then more on a side where
the window's outermost token came out changed. A piece of text is encoded by halving it down to single bytes and joining
upwards; ids are decoded by concatenating their bytes up such a tree.

Why unchanged outermost tokens prove the rest. Merging takes the pair of least rank, the leftmost of equals, until no pair
has a rank.

* If every two neighbours of a sequence encode to themselves, so does the whole: the first merge across a token boundary
  would be the least of its two tokens' span as well, where no earlier merge came in from outside, and it would have
  happened in that span on its own.
* If a sequence is an encoding, every two neighbours encode to themselves: no merge ever crossed the boundaries around them,
  so what happened within is what happens in the span on its own.

After a join, neighbours inside an old part or inside the window are in an encoding. A window whose first token is the left
part's token of that place meets the token before it as the left part did; likewise on the right. Those are all the pairs.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.llm.common import col, resident, settle_in, ship, slices, tokenizer_path, uncollected

#: Pieces, parts of pieces and seams remembered at a time, each kind twice: what was used since the last turn, and before.
CACHE = 250_000
#: Longest part, in bytes, whose encoding is remembered.
SHORT = 24
#: Windows up to this many bytes are merged by scanning, longer ones with a heap.
SCAN = 64
#: Tokens per leaf of the decoding tree.
LEAF = 4096
# Fixed value: the pattern of the rank files.
SPACED = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_LOOSE = regex.compile(r" (?=\p{White_Space})")
_SPACE = regex.compile(r"(?= (?=\P{White_Space}))")
#: Stands for the rank of bytes that are no token.
NONE = 1 << 62
_ENDS = frozenset(".,;:!?")


class Turning:
    """A mapping that forgets what was not used for a while: at ``size`` new entries the older half goes."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def get(self, key):
        found = self.young.get(key)
        if found is None and (found := self.old.pop(key, None)) is not None:
            self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value


class Monoid:
    """Encodings under ``join``. ``ranks`` maps a token's bytes to its id, which is its rank too."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, cache: int | None = None):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"no token for byte {missing[0]}")
        self.ranks = ranks
        self.labels = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.labels[i] = token
        self.byte = [ranks[bytes([b])] for b in range(256)]
        # white space as the rank files' own library knows it: the Unicode property
        self.pieces = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\S", r"\P{White_Space}")
                                    .replace(r"\s", r"\p{White_Space}"))
        # this pattern's matches never run over a space before a character that is none: texts may be split there first
        self.spaced = pattern == SPACED
        size = CACHE if cache is None else cache
        self.whole, self.parts, self.seams = Turning(size), Turning(size), Turning(size)

    # ------------------------------------------------------------- merging of a window
    def merge(self, window: bytes) -> list[int]:
        """The encoding of few bytes by its definition."""
        if len(window) > SCAN:
            return self._merge_long(window)
        ranks = self.ranks.get
        tokens = [window[i:i + 1] for i in range(len(window))]
        found = [ranks(window[i:i + 2], NONE) for i in range(len(window) - 1)]
        while found and (best := min(found)) != NONE:
            at = found.index(best)
            made = tokens[at] + tokens[at + 1]
            tokens[at:at + 2] = [made]
            del found[at]
            if at < len(found):
                found[at] = ranks(made + tokens[at + 1], NONE)
            if at:
                found[at - 1] = ranks(tokens[at - 1] + made, NONE)
        return [self.ranks[t] for t in tokens]

    def _merge_long(self, window: bytes) -> list[int]:
        """The same with a heap of pairs and links between tokens, in n log n steps."""
        n, ranks = len(window), self.ranks.get
        end = list(range(1, n + 1))  # a token starts at i and ends at end[i]; 0: no token starts here
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks(window[i:i + 2])) is not None]
        heapq.heapify(heap)

        def offer(i: int) -> None:
            if i >= 0 and (j := end[i]) < n and (r := ranks(window[i:end[j]])) is not None:
                heapq.heappush(heap, (r, i, end[j]))

        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if not j or j >= n or end[j] != stop:
                continue  # one of the pair's tokens is gone
            end[i], end[j] = stop, 0
            if stop < n:
                before[stop] = i
            offer(i)
            offer(before[i])
        out, i = [], 0
        while i < n:
            out.append(self.ranks[window[i:end[i]]])
            i = end[i]
        return out

    # ------------------------------------------------------------- the monoid
    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the bytes of two encodings in a row."""
        if not left or not right:
            return left or right
        labels, seam = self.labels, (left[-1], right[0])
        i = j = 1
        window = self.seams.young.get(seam)
        if window is None and (window := self.seams.get(seam)) is None:
            window = self.merge(labels[seam[0]] + labels[seam[1]])
            self.seams.put(seam, window)
        while True:
            firm = i == len(left) or window[0] == left[-i]
            firm_right = j == len(right) or window[-1] == right[j - 1]
            if firm and firm_right:
                return left[:-i] + window + right[j:]
            if not firm:
                i = min(2 * i, len(left))
            if not firm_right:
                j = min(2 * j, len(right))
            data = b"".join([labels[t] for t in left[-i:] + right[:j]])
            window = self.parts.young.get(data)
            if window is None and (window := self.parts.get(data)) is None:
                window = self.merge(data)
                if len(data) <= SHORT:
                    self.parts.put(data, window)

    def reduce(self, part: bytes) -> list[int]:
        """The encoding of bytes: of their halves, joined. Short parts are remembered."""
        n = len(part)
        if n == 1:
            return [self.byte[part[0]]]
        if n > SHORT:
            return self.join(self.reduce(part[:n // 2]), self.reduce(part[n // 2:]))
        found = self.parts.young.get(part)
        if found is None and (found := self.parts.get(part)) is None:
            found = self.join(self.reduce(part[:n // 2]), self.reduce(part[n // 2:]))
            self.parts.put(part, found)
        return found

    def spell(self, ids: np.ndarray) -> bytes:
        """The bytes of ids: of their halves, concatenated."""
        n = len(ids)
        if n <= LEAF:
            labels = self.labels
            return b"".join([labels[i] for i in ids.tolist()])
        return self.spell(ids[:n // 2]) + self.spell(ids[n // 2:])

    # ------------------------------------------------------------- texts
    def piece(self, piece: str) -> bytes:
        """int32 ids of a match of the pattern. A whole token is its own encoding, as in the rank files' library."""
        found = self.whole.get(piece)
        if found is None:
            data = piece.encode()
            if (token := self.ranks.get(data)) is not None:
                found = array("i", [token]).tobytes()
            else:
                half = len(data) // 2
                found = array("i", self.join(self.reduce(data[:half]), self.reduce(data[half:]))).tobytes()
            if len(data) <= 4 * SHORT:
                self.whole.put(piece, found)
        return found

    def chunk(self, chunk: str) -> bytes:
        """int32 ids of a run of text that ends where matches end."""
        known = self.whole.young.get
        if chunk[-1] in _ENDS and chunk[-2:-1].isalnum():  # a match of its own, since no letter is before it
            body, end = chunk[:-1], chunk[-1]
            return (known(body) or self.chunk(body)) + (known(end) or self.piece(end))
        pieces = self.pieces.findall(chunk)
        if len(pieces) == 1:
            return self.piece(chunk)
        return b"".join([known(p) or self.piece(p) for p in pieces])

    def chunks(self, text: str | None) -> list[str]:
        """A text cut where matches of the pattern surely end: before each space whose next character is none."""
        if not text:
            return []
        if not self.spaced:
            return self.pieces.findall(text)
        if _LOOSE.search(text) is None and text[-1] != " ":
            first, *rest = text.split(" ")
            return [first, *[" " + r for r in rest]] if first else [" " + r for r in rest]
        return [c for c in _SPACE.split(text) if c]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """int32 ids of each text (null: none). A chunk that occurs often is looked up once."""
        cut = [self.chunks(t) for t in texts]
        here = dict.fromkeys(c for chunks in cut for c in chunks)
        take = self.chunk if self.spaced else self.piece
        known = self.whole.young.get
        for c in here:
            here[c] = known(c) or take(c)
        return [b"".join(map(here.__getitem__, chunks)) for chunks in cut]

    def encode(self, text: str | None) -> bytes:
        """int32 ids of a text (null: none)."""
        return self.encode_all([text])[0]

    @classmethod
    def from_bytes(cls, content: bytes, pattern: str) -> Monoid:
        """From a rank file: a base64 token and its rank a line."""
        return cls({base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines() if line)}, pattern)


def _broadcast(docs: DataFrame, path: str | None, pattern: str | None):
    """The rank file (under 1 MB here, whatever the documents) and the pattern."""
    if pattern is None:
        import public_tokenizers

        pattern = public_tokenizers.PATTERN
    with open(path or tokenizer_path("byte_bpe_50k.tiktoken"), "rb") as f:
        content = f.read()
    return docs.sparkSession.sparkContext.broadcast((content, pattern, hashlib.sha256(content + pattern.encode()).hexdigest()))


def _monoid(spec) -> Monoid:
    content, pattern, key = spec.value
    return resident(__name__, key, lambda: Monoid.from_bytes(content, pattern))


def round_trip(docs: DataFrame, path: str | None = None, pattern: str | None = None, text: str = "text",
               keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of ``docs`` with ids (array<int>) and decoded (binary, from the ids), in one pass.

    Each match of ``pattern`` in the whole text is encoded by itself with the ranks of the file ``path``; a null or empty
    text has no ids and decodes to no bytes. No string is a special token. Repeated rows stay, an empty table gives no
    rows. Texts are taken a few megabytes at a time, a long one whole. ``keep`` must not name ids or decoded."""
    ship(docs.sparkSession)
    spec = _broadcast(docs, path, pattern)
    rows = docs.select(*map(col, keep), col(text))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle_in(__name__)
        bpe = _monoid(spec)
        for batch in batches:
            at = 0
            for part in slices(batch.column(len(keep)), 2 << 20):
                with uncollected():
                    coded = bpe.encode_all(part.to_pylist())
                ids = np.frombuffer(b"".join(coded), np.int32)
                ends = np.cumsum([0, *(len(c) // 4 for c in coded)])
                decoded = pa.array([bpe.spell(ids[a:b]) for a, b in zip(ends, ends[1:])], pa.binary())
                kept = [c.slice(at, len(part)) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)), decoded],
                    [*keep, "ids", "decoded"])
                at += len(part)

    return rows.mapInArrow(run, ", ".join([*fields, "ids array<int>", "decoded binary"]))


def token_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row."""
    return round_trip(docs, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
