"""Language identification by a byte convolutional network.

A text's UTF-8 bytes (A-Z lower-cased) are cut into fixed windows, zero-padded at the end. Filters of several widths
slide over byte embeddings, each filter keeps its maximum over the window, and a softmax layer gives the languages.
A text's log-probabilities are the mean over all its windows, weighted by their bytes. Training is plain numpy (Adam)
on the driver, on a bounded sample of labelled rows; prediction runs in batches of windows inside Arrow UDFs.

For speed, a filter of width w over embeddings is a sum of table look-ups: one row per pair of bytes (65,536 rows) and
one per single byte for odd widths, so no embedding is multiplied at prediction time.
"""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vantage.llm.common import batch_udf, col, free_name, raw, settle, slices

UNDETERMINED = "und"


@dataclass(frozen=True)
class Settings:
    """``languages``, ``rows_per_language`` and ``excerpt`` bound the training sample: labels learned (the most frequent),
    rows of a language, characters of a row."""

    window: int = 256
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 8
    embedding: int = 8
    languages: int = 200
    rows_per_language: int = 400
    excerpt: int = 1024
    epochs: int = 8
    batch: int = 64
    rate: float = 0.01
    seed: int = 7


@dataclass
class Network:
    languages: list[str]
    settings: Settings = field(default_factory=Settings)
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def start(self) -> None:
        s, rng = self.settings, np.random.default_rng(self.settings.seed)
        w = {"embed": rng.normal(0, 0.5, (256, s.embedding))}
        w["embed"][0] = 0
        for k in s.widths:
            w[f"conv{k}"] = rng.normal(0, 1 / np.sqrt(k * s.embedding), (k, s.embedding, s.filters))
        w["bias"] = np.zeros(len(s.widths) * s.filters)
        w["dense"] = rng.normal(0, 0.1, (len(s.widths) * s.filters, len(self.languages)))
        w["offset"] = np.zeros(len(self.languages))
        self.weights = {k: v.astype(np.float32) for k, v in w.items()}

    def pooled(self, windows: np.ndarray, where: bool = False):
        """Per window and filter the greatest response (and where it is)."""
        best, at = [], []
        for k in self.settings.widths:
            conv = self.weights[f"conv{k}"]
            span = windows.shape[1] - k + 1
            out = (self.weights["embed"] @ conv[0])[windows[:, :span]]
            for j in range(1, k):
                out += (self.weights["embed"] @ conv[j])[windows[:, j:j + span]]
            if where:
                a = out.argmax(axis=1)
                at.append(a)
                best.append(np.take_along_axis(out, a[:, None, :], axis=1)[:, 0])
            else:
                best.append(out.max(axis=1))
        return np.concatenate(best, axis=1), at

    def fit(self, windows: np.ndarray, labels: np.ndarray) -> None:
        s, rng = self.settings, np.random.default_rng(self.settings.seed + 1)
        self.start()
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.weights.items()}
        step = 0
        for _ in range(s.epochs):
            order = rng.permutation(len(windows))
            for i in range(0, len(order), s.batch):
                pick = order[i:i + s.batch]
                step += 1
                for name, g in self._gradients(windows[pick], labels[pick]).items():
                    m, v = moments[name]
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    self.weights[name] -= (s.rate * m / (1 - 0.9 ** step)
                                           / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)

    def _gradients(self, windows: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        s, w, n = self.settings, self.weights, len(windows)
        best, at = self.pooled(windows, where=True)
        active = best + w["bias"]
        hidden = np.maximum(active, 0)
        p = softmax(hidden @ w["dense"] + w["offset"])
        p[np.arange(n), labels] -= 1
        p /= n
        out = {"dense": hidden.T @ p, "offset": p.sum(axis=0)}
        back = (p @ w["dense"].T) * (active > 0)
        out["bias"] = back.sum(axis=0)
        out["embed"] = np.zeros_like(w["embed"])
        rows = np.arange(n)[:, None]
        for i, k in enumerate(s.widths):
            g = back[:, i * s.filters:(i + 1) * s.filters]
            out[f"conv{k}"] = np.empty_like(w[f"conv{k}"])
            for j in range(k):
                seen = windows[rows, at[i] + j]  # only the winning positions carry gradient
                out[f"conv{k}"][j] = np.einsum("nfe,nf->ef", w["embed"][seen], g)
                np.add.at(out["embed"], seen, g[:, :, None] * w[f"conv{k}"][j].T[None])
        out["embed"][0] = 0
        return out

    def tables(self) -> list[list[tuple[int, np.ndarray]]]:
        """Per width its look-ups (offset, table): pairs of bytes first, then a single byte for odd widths."""
        out = []
        for k in self.settings.widths:
            one = [np.ascontiguousarray(self.weights["embed"] @ c) for c in self.weights[f"conv{k}"]]
            pairs = [(j, (one[j][:, None] + one[j + 1][None]).reshape(1 << 16, -1)) for j in range(0, k - 1, 2)]
            out.append(pairs + ([(k - 1, one[k - 1])] if k % 2 else []))
        return out


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def cut(texts: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all texts, the text each belongs to, and its bytes. An empty text has none."""
    counts = np.array([-(-len(t) // window) for t in texts], np.int64)
    flat = np.zeros((int(counts.sum()), window), np.uint8)
    sizes = np.full(len(flat), window, np.int64)
    line, at = flat.reshape(-1), 0
    for t, n in zip(texts, counts):
        line[at:at + len(t)] = np.frombuffer(t.lower(), np.uint8)
        at += n * window
        if n:
            sizes[at // window - 1] = len(t) - (n - 1) * window
    return flat, np.repeat(np.arange(len(texts)), counts), sizes


class Predictor:
    def __init__(self, net: Network, chunk: int = 256) -> None:
        self.net, self.chunk, self.tables = net, chunk, net.tables()

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        w, out = self.net.weights, []
        for i in range(0, len(windows), self.chunk):
            part = windows[i:i + self.chunk]
            pair = (part[:, :-1].astype(np.int32) << 8) | part[:, 1:]
            best = []
            for k, looks in zip(self.net.settings.widths, self.tables):
                span = part.shape[1] - k + 1
                total = None
                for offset, table in looks:
                    keys = pair if len(table) == 1 << 16 else part
                    got = table.take(keys[:, offset:offset + span], axis=0)
                    total = got if total is None else np.add(total, got, out=total)
                best.append(total.max(axis=1))
            z = np.maximum(np.concatenate(best, axis=1) + w["bias"], 0) @ w["dense"] + w["offset"]
            out.append(z - np.log(np.exp(z - z.max(axis=1, keepdims=True)).sum(axis=1, keepdims=True))
                       - z.max(axis=1, keepdims=True))
        return np.concatenate(out) if out else np.zeros((0, len(self.net.languages)), np.float32)

    def __call__(self, texts: list[bytes | None]) -> tuple[list[str], np.ndarray]:
        """Per text the language and its probability; undetermined, with 0, without a letter."""
        known = [t if t and has_letter(t) else b"" for t in texts]
        windows, owner, sizes = cut(known, self.net.settings.window)
        total = np.zeros((len(texts), len(self.net.languages)))
        logs = self.log_probabilities(windows).astype(np.float64) * sizes[:, None]
        np.add.at(total, owner, logs)
        held = np.bincount(owner, weights=sizes, minlength=len(texts))
        p = softmax(total / np.maximum(held, 1)[:, None])
        best = p.argmax(axis=1)
        names = [self.net.languages[b] if t else UNDETERMINED for b, t in zip(best, known)]
        return names, np.where(held > 0, p.max(axis=1), 0.0)


def has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode("utf-8", "ignore"))


def sample(docs: DataFrame, s: Settings) -> list[tuple[str, str]]:
    """At most ``rows_per_language`` (lang, excerpt) rows of each language, chosen by hash; the excerpt starts at a
    place chosen by hash.

    Languages are counted first and rows pass by a hash threshold set for about a third more than are wanted, so what
    meets for the final choice doesn't grow with the table or its tasks."""
    known = docs.where("text is not null and lang is not null and text <> ''")
    frequent = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(s.languages)
    share = settle(frequent.select("lang", (F.lit(1.3 * s.rows_per_language + 50) / F.col("n")).alias("share")), "language-shares")
    start = F.pmod(F.xxhash64("doc_id"), F.greatest(F.length("text") - s.excerpt, F.lit(0)) + 1) + 1
    rows = (known.select("lang", F.xxhash64("doc_id", "text").alias("h"), "doc_id", "text").join(share, "lang")
            .where(F.shiftrightunsigned("h", 11) * 2.0 ** -53 < F.col("share"))
            .select("lang", "h", F.substr("text", start.cast("int"), F.lit(s.excerpt)).alias("part"))
            .withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h", "part")))
            .where(F.col("n") <= s.rows_per_language))
    return [(r.lang, r.part) for r in rows.orderBy("lang", "n").select("lang", "part").collect()]


def train(docs: DataFrame, settings: Settings | None = None) -> Network:
    """Fit on rows of ``docs`` (doc_id, text, lang). Without a labelled row the network knows no language."""
    s = settings or Settings()
    rows = sample(docs, s)
    net = Network(sorted({lang for lang, _ in rows}), s)
    if not rows:
        return net
    rng = np.random.default_rng(s.seed + 2)
    texts, labels = [], []
    for lang, part in rows:
        data = part.encode()
        for _ in range(1 + len(data) // s.window):  # a crop of any length, so that short texts are known too
            size = int(rng.integers(8, s.window + 1))
            at = int(rng.integers(0, max(1, len(data) - size + 1)))
            texts.append(data[at:at + size])
            labels.append(net.languages.index(lang))
    windows, owner, _ = cut(texts, s.window)
    net.fit(windows, np.array(labels)[owner])
    return net


def identify(docs: DataFrame, net: Network, text: str = "text", out: str = "language") -> DataFrame:
    """``docs`` with a struct column ``out`` of lang_pred (string) and score (double, 0 to 1).

    A null, empty or letterless text is undetermined with score 0, as is every text if no language was learned. Every
    byte of a long text counts. Ties go to the language first in order. Repeated rows are scored alike."""
    if not net.languages:
        return docs.withColumn(out, F.struct(F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score")))

    def make():
        predict = Predictor(net)

        def work(batch: pa.Array) -> pa.Array:
            names, scores = [], []
            for part in slices(batch):
                n, p = predict(raw(part))
                names += n
                scores += p.tolist()
            return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                              ["lang_pred", "score"])

        return work

    return docs.withColumn(out, batch_udf(make, "lang_pred string, score double")(col(text)))


def held_out(modulus: int, remainder: int) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")),
                  F.lit(modulus)) == remainder


def predictions(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; learned from the rows that are not held out."""
    net = train(docs.where(~held_out(4, 2)), settings)
    got = identify(docs.select("doc_id", held_out(4, 2).alias("held_out"), "text"), net)
    return got.select("doc_id", "held_out", "language.lang_pred", "language.score")


#: How much likelier than chance a text's language must be to be told.
OVER_CHANCE = 1.2


def accepted(docs: DataFrame, settings: Settings | None = None, languages: Collection[str] | None = None,
             least: float | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, whose predicted language is one of ``languages`` (all learned ones) with a score of
    ``least`` at least; learned as in ``predictions``.

    By default ``least`` is 1.2 times what a guess among the learned languages scores, so texts go that the network can't
    place. Null and letterless texts have no language and go. Without any labelled row nothing can be judged: then every
    text with a letter stays, unless ``languages`` are asked for, which none can be shown to be in. Rows of an empty
    table are none; repeated rows have the same fate."""
    net = train(docs.where(~held_out(4, 2)), settings)
    if not net.languages:
        return docs.where(F.col("text").rlike(r"\p{L}")) if languages is None else docs.limit(0)
    if least is None:
        least = OVER_CHANCE / len(net.languages) if len(net.languages) > 1 else 0.0
    name = free_name(docs, "language")
    got = identify(docs, net, out=name)
    found = col(name)
    kept = (found["lang_pred"] != UNDETERMINED) & (found["score"] >= least)
    if languages is not None:
        kept = kept & found["lang_pred"].isin(*languages)
    return got.where(kept).drop(found)
