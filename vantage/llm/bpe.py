"""BPE encoding and decoding by a tokenization automaton.

The automaton reads tokens. Its states are "the last token read"; it accepts exactly the token sequences that merging
gives. It starts with one arc per base symbol from every state, and each merge u + v -> w, in order, is one gadget:

* state w leaves as state v does (arcs out of v, before the merge);
* an arc w enters wherever an arc u does (after the next line);
* the arc v out of state u goes away: u followed by v is now w.

``compile`` applies the gadgets in turn. Of 49,000 x 49,000 arcs nearly all exist, so a state's row of the transition table
holds the arcs it lacks. Tokens are numbered so that these are few intervals: a token comes right after the tokens that
begin with it (those made of it and a right neighbour, in order of their merges, each after its own). Taking arc v out of
state u at merge k also keeps out every token that later merges build on v, which is one interval that ends at v.

A pre-split word is encoded by transitions alone, from left to right and without going back: from the state at each place,
a trie names the tokens that spell what comes next, and those with an arc enter the places where they end. A place is
entered once, because a prefix of a merged sequence is the merged sequence of its own string. Decoding emits the arcs'
labels.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.llm.common import batch_udf, col, resident, settle_in, ship, slices, tokenizer_path

# Fixed values of the file format's word-end vocabulary.
WORD_END = "</w>"
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Runs of text kept at a time, twice: what was used since the last turn, and before.
CACHE = 150_000


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if it prints in Latin-1, else one from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = iter(range(256, 512))
    return [chr(b if b in set(shown) else next(other)) for b in range(256)]


def _numbering(left: list[int], step: list[int], order: list[int]) -> tuple[list[int], list[int], list[list[int]]]:
    """Per token its number, the least number among the tokens that begin with it, and those one merge away (oldest first).

    ``order``: the merged tokens by merge."""
    size = len(left)
    built: list[list[int]] = [[] for _ in range(size)]
    for w in order:
        built[left[w]].append(w)
    number, least, count = [0] * size, [0] * size, 0
    for root in (t for t in range(size) if step[t] < 0):
        least[root] = count
        walk = [(root, 0)]
        while walk:
            token, done = walk.pop()
            if done < len(built[token]):
                walk.append((token, done + 1))
                least[built[token][done]] = count
                walk.append((built[token][done], 0))
            else:
                number[token] = count
                count += 1
    return number, least, built


def _without(cuts: list[int], low: int, high: int) -> list[int]:
    """``cuts`` (borders of disjoint intervals, ascending) with low <= x < high taken in as well."""
    i, j = bisect_left(cuts, low), bisect_right(cuts, high)
    return [*cuts[:i], *([] if i & 1 else [low]), *([] if j & 1 else [high]), *cuts[j:]]


@dataclass
class Automaton:
    """Compiled from (vocab, merges); ``special`` are the added tokens, matched in raw text.

    States and arcs go by the numbers of ``_numbering``. State s lacks arc t if an odd number of ``cuts[first[s]:last[s]]``
    is at most t. States with equal rows by construction share them."""

    labels: list[str]
    special: dict[str, int]
    ids: list[int]
    first: array
    last: array
    cuts: array
    trie: dict = field(default_factory=dict)
    young: dict[str, bytes] = field(default_factory=dict)
    old: dict[str, bytes] = field(default_factory=dict)

    @classmethod
    def compile(cls, vocab: dict[str, int], merges: list[tuple[str, str]], special: dict[str, int]) -> Automaton:
        size = max([*vocab.values(), *special.values()]) + 1
        labels = [""] * size
        for text, i in [*vocab.items(), *special.items()]:
            labels[i] = text
        left, step, gadgets = [-1] * size, [-1] * size, []
        for k, (u, v) in enumerate(merges):
            a, b, w = vocab[u], vocab[v], vocab[u + v]
            if step[w] >= 0:
                raise ValueError(f"two merges make {u + v!r}")
            if any(len(x) > 1 and x[1:] != WORD_END and step[vocab[x]] < 0 for x in (u, v)):
                raise ValueError(f"{u!r} + {v!r} uses a token that no earlier merge makes")
            left[w], step[w] = a, k
            gadgets.append((a, b, w))
        number, least, built = _numbering(left, step, [w for _, _, w in gadgets])
        whole: list[int] = []
        rows = [whole] * size  # per token the borders of what its state lacks; rows are replaced, never changed
        lost = set()  # tokens whose gadget finds no arc v after an arc u: nothing is ever merged to them
        for k, (a, b, w) in enumerate(gadgets):
            if a in lost or b in lost or bisect_right(rows[a], number[b]) & 1:
                lost.add(w)
                continue
            rows[w] = rows[b]
            later = bisect_left(built[b], k, key=step.__getitem__)
            low = least[built[b][later]] if later < len(built[b]) else number[b]
            rows[a] = _without(rows[a], low, number[b] + 1)
        ids, first, last, cuts = [0] * size, array("i", [0]) * size, array("i", [0]) * size, array("i")
        filed: dict[int, tuple[int, int]] = {}
        for token, row in enumerate(rows):
            if id(row) not in filed:
                filed[id(row)] = (len(cuts), len(cuts) + len(row))
                cuts.extend(row)
            n = number[token]
            ids[n] = token
            first[n], last[n] = filed[id(row)]
        made = cls(labels, special, ids, first, last, cuts)
        for text, i in vocab.items():
            if (step[i] >= 0 and i not in lost) or (step[i] < 0 and len(text.removesuffix(WORD_END)) == 1):
                node = made.trie
                for symbol in symbols(text):
                    node = node.setdefault(symbol, {})
                node[""] = number[i]
        return made

    @classmethod
    def from_file(cls, path: str) -> Automaton:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        return cls.compile(spec["model"]["vocab"], merges, special)

    def run(self, word: list[str]) -> list[int]:
        """The arcs that spell a pre-split word's symbols."""
        n = len(word)
        trie, cuts, first, last = self.trie, self.cuts, self.first, self.last
        state = [-1] * (n + 1)  # per place the token that ends there
        come = [0] * (n + 1)  # and where it begins
        for at in range(n):
            if at:
                if (now := state[at]) < 0:
                    continue
                low, high = first[now], last[now]
            else:
                low = high = 0  # the start lacks no arc
            node = trie
            for end in range(at, n):
                node = node.get(word[end])
                if node is None:
                    break
                end += 1
                token = node.get("")
                if token is not None and state[end] < 0 and not (bisect_right(cuts, token, low, high) - low) & 1:
                    state[end], come[end] = token, at
            if state[n] >= 0:
                break
        else:
            if n:
                raise ValueError(f"no path spells {''.join(word)!r}")
        path = []
        while n:
            path.append(self.ids[state[n]])
            n = come[n]
        return path[::-1]

    def chunk(self, text: str) -> bytes:
        """int32 ids of a run of normalised text without white space."""
        got = self.young.get(text)
        if got is not None:
            return got
        if len(text) > 1 and text[-1] in _ENDS and text[-2].isalnum():  # a piece of its own, since no letter is before it
            return self.chunk(text[:-1]) + self.chunk(text[-1])
        got = self.old.pop(text, None)
        if got is None:
            ids: list[int] = []
            for piece in _PIECES.findall(text):
                spelled = [_SYMBOLS[b] for b in piece.encode()]
                spelled[-1] += WORD_END
                ids += self.run(spelled)
            got = np.array(ids, np.int32).tobytes()
        if len(self.young) >= CACHE:
            self.old, self.young = self.young, {}
        if len(text) <= 64:
            self.young[text] = got
        return got

    def encode(self, text: str | None) -> bytes:
        """int32 ids of a text (null: none)."""
        if not text:
            return b""
        if self.special and any(s in text for s in self.special):
            marks = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
            return b"".join(np.array([self.special[part]], np.int32).tobytes() if part in self.special
                            else self.encode(part) for part in marks.split(text))
        text = lowered(unicodedata.normalize("NFC", text))
        runs = text.split() if _SEPARATORS.search(text) is None else filter(None, _SPACE.split(text))
        take, known = self.chunk, self.young.get
        return b"".join([known(r) or take(r) for r in runs])

    def decode(self, ids: np.ndarray) -> str:
        return spell(ids, self.labels)


_PIECES = regex.compile(PIECES.replace(r"\s", r"\p{White_Space}"))
_SPACE = regex.compile(r"\p{White_Space}+")
_SEPARATORS = regex.compile("[\x1c-\x1f]")  # str.split() takes them for white space, the file's pattern does not
_SYMBOLS = byte_symbols()
_ENDS = frozenset(".,;:!?")


def spell(ids: np.ndarray, labels: list[str]) -> str:
    """Arc labels joined by a space, as the file names no decoder."""
    return " ".join([labels[i] for i in ids.tolist()])


def lowered(text: str) -> str:
    """Each character's lower case by itself (a final sigma is no exception)."""
    return text.replace("Σ", "σ").lower()


def symbols(token: str) -> list[str]:
    """A token's base symbols; the word end belongs to the last one."""
    body = token.removesuffix(WORD_END)
    return [*body[:-1], body[-1] + token[len(body):]] if body else [token]


def _automaton(spec) -> Automaton:
    """One automaton per worker process and vocabulary, tables included."""
    vocabulary, merges, special, key = spec.value
    return resident(__name__, key, lambda: Automaton.compile(dict(vocabulary), merges, dict(special)))


def _broadcast(docs: DataFrame, path: str | None):
    """The vocabulary file's parts; its size is that of the file (under 2 MB here), whatever the documents."""
    with open(path or tokenizer_path(), encoding="utf-8") as f:
        text = f.read()
    spec = json.loads(text)
    merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
    special = [(t["content"], t["id"]) for t in spec["added_tokens"]]
    key = hashlib.sha256(text.encode()).hexdigest()
    return docs.sparkSession.sparkContext.broadcast((list(spec["model"]["vocab"].items()), merges, special, key))


def encode(docs: DataFrame, path: str | None = None, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with an array<int> column ``out``: the token ids of the whole text.

    A null or empty text has no ids. Special tokens written in a text count as such. ``path`` is the vocabulary file."""
    spec = _broadcast(docs, path)

    def make():
        bpe = _automaton(spec)

        def work(batch: pa.Array) -> pa.Array:
            parts = [bpe.encode(t) for t in batch.to_pylist()]
            ends = np.concatenate([[0], np.cumsum([len(p) // 4 for p in parts])])
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                            pa.array(np.frombuffer(b"".join(parts), np.int32)))

        return work

    return docs.withColumn(out, batch_udf(make, "array<int>")(col(text)))


def decode(docs: DataFrame, path: str | None = None, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with a string column ``out``: the labels of the ids, joined by a space. Null ids give a null."""
    spec = _broadcast(docs, path)

    def make():
        vocabulary, _, special, _ = spec.value
        labels = [""] * (max(i for _, i in [*vocabulary, *special]) + 1)
        for label, i in [*vocabulary, *special]:
            labels[i] = label

        def work(batch: pa.Array) -> pa.Array:
            return pa.array([None if not x.is_valid else spell(x.values.to_numpy(zero_copy_only=False), labels)
                             for x in batch], pa.string())

        return work

    return docs.withColumn(out, batch_udf(make, "string")(col(ids)))


def round_trip(docs: DataFrame, path: str | None = None, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of ``docs`` with ids (array<int>) and decoded (string, from the ids), in one pass.

    Texts are taken a few megabytes at a time and each such part is a batch of the result, so long texts need no more
    memory than that. ``keep`` must not name ids or decoded."""
    ship(docs.sparkSession)
    spec = _broadcast(docs, path)
    rows = docs.select(*map(col, keep), col(text))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle_in(__name__)
        bpe = _automaton(spec)
        for batch in batches:
            at = 0
            for part in slices(batch.column(len(keep)), 2 << 20):
                coded = [bpe.encode(t) for t in part.to_pylist()]
                ids = np.frombuffer(b"".join(coded), np.int32)
                ends = np.cumsum([0, *(len(c) // 4 for c in coded)])
                decoded = pa.array([bpe.decode(ids[a:b]) for a, b in zip(ends, ends[1:])], pa.string())
                kept = [c.slice(at, len(part)) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)), decoded],
                    [*keep, "ids", "decoded"])
                at += len(part)

    return rows.mapInArrow(run, ", ".join([*fields, "ids array<int>", "decoded string"]))


def token_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row; repeated rows stay, an empty table gives no rows."""
    return round_trip(docs, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
