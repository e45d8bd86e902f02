"""Toxicity by a support vector machine over a gapped subsequence kernel with Nyström landmarks.

The kernel of two strings sums over their common subsequences of ``order`` characters, each weighted by ``decay`` to the
power of the span it takes in either string (at most ``span``), and is normalised to 1 for equal strings. So an insult with characters put
in or left out stays close to itself. A text is scored by its worst sentence and a sentence by its worst unit: a word, a
word without its punctuation, with look-alike digits read as letters, the parts of a compound, or a run of single
characters ("s c u m"). A word longer than ``longest`` is read in overlapping windows.

Labels are per document, so training is multiple-instance: landmarks are units (or their first letters) that tell
toxic documents from clean ones, and common clean units. Ones that chance may have brought stay in, with less weight. With
Nyström features K(unit, landmarks) K(landmarks)^-1/2, a linear SVM is fitted to the worst unit of each toxic document and
to units of clean ones, the hardest among them, weighed by their documents; both are then chosen anew, a few rounds. A
logistic curve fitted to the documents' decision values gives the score. Training is numpy on the driver, on a sample
bounded by ``Settings``.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from itertools import combinations
from math import exp, lgamma, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vantage.llm.common import batch_udf, col, free_name, resident, settle, settle_in, slices
from vantage.llm.langid import held_out

_LOOKALIKE = str.maketrans("013457@$!", "oieastasi")
_PART = re.compile(r"[^\W_]{3,}")
_SINGLES = re.compile(r"(?<!\S)\S(?:\s+\S){2,}(?!\S)")
#: Words whose decision a worker keeps, twice: since the last turn, and before.
CACHE = 200_000


@dataclass(frozen=True)
class Settings:
    """``toxic`` and ``clean`` bound the training documents, ``longest_text`` their mean length. ``landmarks`` bounds the
    toxic landmarks, which are in ``support`` toxic documents. ``contrast`` weighs clean documents against toxic ones: a
    unit whose share of toxic documents is so many times its share of clean ones speaks for neither."""

    order: int = 3
    span: int = 5
    decay: float = 0.6
    landmarks: int = 200
    background: int = 40
    stems: tuple[int, ...] = (4, 5, 6)
    negatives: int = 3000
    contrast: float = 8.0
    support: int = 2
    seed: int = 11
    toxic: int = 1000
    clean: int = 2000
    longest_text: int = 20_000
    longest: int = 24
    rounds: int = 4
    margin: float = 2000.0


def units(word: str, longest: int = 24) -> list[str]:
    """The strings that stand for a lower-cased word."""
    whole = re.sub(r"^[\W_]+|[\W_]+$", "", word)
    out = {whole, "".join(c for c in whole if c.isalnum()), "".join(c for c in word.translate(_LOOKALIKE) if c.isalnum()),
           *(p for p in _PART.findall(word) if p != whole)}
    cut: set[str] = set()
    for u in out:
        if len(u) <= longest:
            cut.add(u)
        else:
            cut.update(u[i:i + longest] for i in range(0, len(u) - longest // 2, longest // 2))
    return sorted(u for u in cut if u)


def words(text: str | None) -> set[str]:
    """The distinct lower-cased words of a whole text, runs of single characters joined to one."""
    low = (text or "").lower()
    found = {w.strip(".,;:!?()[]\"'|") for w in set(low.split())}
    for run in _SINGLES.findall(low):
        found.add("".join(run.split()))
    return found


def features(strings: list[str], order: int, span: int, decay: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, weight), one per string and subsequence of ``order`` characters that takes at most ``span``; a weight
    is the sum of decay^span over its occurrences. Keys are 40-bit hashes of the characters."""
    sizes = np.array([len(s) for s in strings], np.int64)
    if not len(sizes) or sizes.max() < order:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0)
    flat = np.frombuffer("".join(strings).encode("utf-32-le"), np.uint32).astype(np.uint64)
    row = np.repeat(np.arange(len(strings)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(flat))  # characters from here to the string's end
    keys, weights = [], []
    for places in combinations(range(1, span), order - 1):
        at = np.flatnonzero(left > places[-1])
        key = flat[at]
        for p in places:
            key = key * np.uint64(0x9E3779B97F4A7C15) + flat[at + p]
        key = (key ^ key >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(24)
        keys.append(row[at].astype(np.uint64) << np.uint64(40) | key)
        weights.append(np.full(len(at), decay ** (places[-1] + 1)))
    found, back = np.unique(np.concatenate(keys), return_inverse=True)
    return ((found >> np.uint64(40)).astype(np.int64), found & np.uint64((1 << 40) - 1),
            np.bincount(back, np.concatenate(weights)))


@dataclass
class Marks:
    """Landmarks as unit vectors over the subsequences that occur in them."""

    strings: list[str]
    order: int
    span: int
    decay: float

    def __post_init__(self) -> None:
        row, key, weight = features(self.strings, self.order, self.span, self.decay)
        norm = np.sqrt(np.bincount(row, weight ** 2, minlength=len(self.strings)))
        self.keys, column = np.unique(key, return_inverse=True)
        self.vectors = np.zeros((len(self.keys), len(self.strings)))
        self.vectors[column, row] = weight / norm[row]

    def project(self, strings: list[str], onto: np.ndarray) -> np.ndarray:
        """Per string the products of its unit vector with the columns of ``onto`` (one row per key)."""
        out = np.zeros((len(strings), onto.shape[1]))
        step = 20_000 if onto.shape[1] == 1 else 2_000
        for at in range(0, len(strings), step):
            part = strings[at:at + step]
            row, key, weight = features(part, self.order, self.span, self.decay)
            norm = np.sqrt(np.bincount(row, weight ** 2, minlength=len(part)))
            place = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
            hit = np.flatnonzero(self.keys[place] == key) if len(self.keys) else place[:0]
            row, place, weight = row[hit], place[hit], weight[hit] / norm[row[hit]]
            if onto.shape[1] == 1:
                out[at:at + len(part), 0] = np.bincount(row, weight * onto[place, 0], minlength=len(part))
            else:
                dense = np.zeros((len(part), len(self.keys)))
                dense[row, place] = weight
                out[at:at + len(part)] = dense @ onto
                del dense  # else the next part's is made beside it
        return out

    def kernel(self, strings: list[str]) -> np.ndarray:
        """(strings, landmarks) normalised kernel values; 0 where a string has no such subsequence."""
        return self.project(strings, self.vectors)


@dataclass
class Model:
    settings: Settings
    marks: Marks
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0
    young: dict[str, float] = field(default_factory=dict)
    old: dict[str, float] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.direction = (self.marks.vectors @ self.weights)[:, None]

    def decide(self, strings: list[str]) -> np.ndarray:
        return self.marks.project(strings, self.direction)[:, 0] + self.bias

    def learn_words(self, new: set[str]) -> None:
        """File the decision of each word, that of its worst unit."""
        spelled = {w: units(w, self.settings.longest) for w in new}
        strings = sorted({u for us in spelled.values() for u in us})
        value = dict(zip(strings, self.decide(strings).tolist())) if strings else {}
        for w, us in spelled.items():
            self.young[w] = max((value[u] for u in us), default=self.bias)

    def worst(self, texts: list[str | None]) -> np.ndarray:
        """Per text the decision of its worst unit; the bias alone without one."""
        bags = [words(t) for t in texts]
        if len(self.young) > CACHE:
            self.old, self.young = self.young, {}
        unknown = set()
        for bag in bags:
            for w in bag:
                if w not in self.young:
                    if w in self.old:
                        self.young[w] = self.old[w]
                    else:
                        unknown.add(w)
        self.learn_words(unknown)
        known = self.young
        return np.array([max([known[w] for w in bag], default=self.bias) for bag in bags])

    def score(self, decisions: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * decisions + self.shift, -50, 50)))


def _svm(x: np.ndarray, y: np.ndarray, c: np.ndarray, steps: int = 60) -> tuple[np.ndarray, float]:
    """Squared-hinge linear SVM by Newton steps with step halving; ``c`` weighs each row's loss."""
    a = np.column_stack([x, np.ones(len(x))])
    hold = np.eye(a.shape[1])
    hold[-1, -1] = 1e-6

    def loss(w: np.ndarray) -> float:
        return float(0.5 * w @ hold @ w + 0.5 * (c * np.maximum(1 - y * (a @ w), 0) ** 2).sum())

    w, now = np.zeros(a.shape[1]), float(0.5 * c.sum())
    for _ in range(steps):
        bad = y * (a @ w) < 1
        own = a[bad]
        sub = own * c[bad, None]
        step = np.linalg.solve(hold + sub.T @ own, sub.T @ y[bad]) - w
        del own, sub
        size = 1.0
        while size > 1e-4 and loss(w + size * step) > now:
            size /= 2
        new = loss(w + size * step)
        if new > now - 1e-9 * now:
            break
        w, now = w + size * step, new
    return w[:-1], float(w[-1])


def _apart(texts: list[str], width: int = 4, hashes: int = 8, alike: int = 4) -> list[int]:
    """The documents that aren't near copies of earlier ones, by equal least hashes of their word shingles."""
    from zlib import crc32

    mixed = [np.uint64(0x9E3779B1 * (2 * i + 1) & 0xFFFFFFFF) for i in range(hashes)]
    seen: list[set[int]] = [set() for _ in mixed]
    out = []
    for i, text in enumerate(texts):
        line = text.lower().split()
        own = np.array([crc32(" ".join(line[j:j + width]).encode()) for j in range(max(1, len(line) - width + 1))], np.uint64)
        least = [int(((own ^ m) * m & np.uint64(0xFFFFFFFF)).min()) for m in mixed]
        if sum(x in s for x, s in zip(least, seen)) < alike:
            out.append(i)
        for x, s in zip(least, seen):
            s.add(x)
    return out


def fit(rows: list[tuple[str, int]], s: Settings) -> Model | None:
    """From (text, toxic) rows; None without both classes, or if no toxic text has a unit of ``order`` characters."""
    toxic = np.array([bool(t) for _, t in rows], bool)
    if toxic.all() or not toxic.any():
        return None
    kept: list[int] = []  # copies would vouch for each other's rare words; both classes stay
    for kind in (False, True):
        own = np.flatnonzero(toxic == kind)
        kept += own[_apart([rows[i][0] for i in own])].tolist()
    rows, toxic = [rows[i] for i in kept], toxic[kept]
    spelled: dict[str, list[str]] = {}
    one: dict[str, str] = {}  # words share units: each is kept once
    bags = []
    for t, _ in rows:
        new = words(t)
        spelled |= {w: [one.setdefault(u, u) for u in units(w, s.longest) if len(u) >= s.order] for w in new if w not in spelled}
        bags.append({u for w in new for u in spelled[w]})
    del one
    chosen = _landmarks(bags, toxic, s)
    if not chosen:
        return None
    strings = sorted(set().union(*bags))
    number = {u: i for i, u in enumerate(strings)}
    held = [np.array(sorted(number[u] for u in bag), np.int64) for bag in bags]
    seen = np.zeros((2, len(strings)))
    for h, t in zip(held, toxic):
        seen[int(t), h] += 1
    rate = seen / np.array([[(~toxic).sum()], [toxic.sum()]])
    able = (rate[1] > s.contrast * rate[0]) | np.array([u in chosen for u in strings])
    common = _common(bags, toxic, s, list(chosen))
    del bags, spelled, number  # sets of strings, larger than all that follows
    settle_in(__name__)
    marks = Marks([*chosen, *common], s.order, s.span, s.decay)
    values, vectors = np.linalg.eigh(marks.vectors.T @ marks.vectors)
    whiten = vectors / np.sqrt(np.maximum(values, 1e-2)) @ vectors.T
    phi = np.zeros((len(strings), len(marks.strings)), np.float32)
    belief = np.zeros(len(strings))  # before the first round: how close to a trusted toxic landmark
    trust = np.zeros(len(strings))  # that of the nearest toxic landmark
    sure = np.array(list(chosen.values())) / max(chosen.values())
    step = 2_000  # what a part takes besides phi is memory of the driver
    for at in range(0, len(strings), step):
        near = marks.kernel(strings[at:at + step])
        belief[at:at + step] = (near[:, :len(chosen)] * sure).max(axis=1) - 0.6
        trust[at:at + step] = sure[near[:, :len(chosen)].argmax(axis=1)]
        phi[at:at + step] = near @ whiten
    rng = np.random.default_rng(s.seed)
    negative = np.flatnonzero(~able & (seen[0] > 0))
    some = rng.permutation(negative)[:s.negatives]
    nothing = np.zeros((1, phi.shape[1]), np.float32)  # a text without units isn't toxic
    for _ in range(s.rounds):
        belief_able = np.where(able, belief, -np.inf)
        worst = [h[belief_able[h].argmax()] for h, t in zip(held, toxic) if t and len(h)]
        worst = [i for i in worst if able[i]]
        good = np.union1d([i for i in worst if belief[i] > -0.3] or worst, np.flatnonzero(belief_able > 0)).astype(np.int64)
        hard = negative[np.argsort(-belief[negative], kind="stable")[:s.negatives]]
        bad = np.unique(np.concatenate([some, hard]))
        both = good[seen[0, good] > 0]  # units of clean documents too speak against themselves
        vote, against = seen[1, good] * trust[good], s.contrast * rate[0] * toxic.sum()
        x = np.concatenate([phi[good], phi[bad], nothing, phi[both]])
        y = np.repeat([1.0, -1.0], [len(good), len(x) - len(good)])
        weight = np.concatenate([vote, against[bad], [1.0], against[both] * trust[both]])
        w, b = _svm(x, y, s.margin / vote.sum() * weight)
        belief = phi @ w + b
    model = Model(s, marks, whiten @ w, b)
    top = np.array([belief[h].max() if len(h) else b for h in held])
    model.slope, model.shift = _logistic(np.clip(top, -1, 1), toxic)  # outside the margin a value says no more
    return model


def _landmarks(bags: list[set[str]], toxic: np.ndarray, s: Settings) -> dict[str, float]:
    """Units and their beginnings that tell toxic documents, each with how far it is trusted (0 to 1).

    First those that most likely aren't chance by all documents, by their share of the toxic documents less ``contrast`` times that
    of the clean ones. Then always the next that explains most of the toxic documents without a landmark so far: a rare
    insult counts by the documents that have no other, whatever the size of the sample. It is in ``support`` of
    them, or in one if none is in more."""
    grown = [{u[:n] for u in bag for n in (*s.stems, len(u)) if len(u) >= n} for bag in bags]
    names = sorted(set().union(*grown), key=lambda u: (-len(u), u))
    number = {u: i for i, u in enumerate(names)}
    inside = [np.array([number[u] for u in g], np.int64) for g in grown]
    clean, left = np.zeros(len(names)), np.zeros(len(names))
    for h, t in zip(inside, toxic):
        (left if t else clean)[h] += 1
    if not left.any():
        return {}
    n0, n1 = int((~toxic).sum()), int(toxic.sum())
    support = s.support if (left >= s.support).any() else 1
    cost = s.contrast * (clean + 0.5) / n0
    told = np.flatnonzero((left >= support) & (left / n1 > s.contrast * clean / n0))
    trust = _trust(left, clean, told, n1, n0)
    found: dict[str, float] = {}
    for i in told[np.argsort(cost[told] - left[told] / n1, kind="stable")]:
        u = names[i]
        if trust[i] > 0.5 and len(found) < s.landmarks and not any(u.startswith(f) or f.startswith(u) for f in found):
            found[u] = trust[i]
    marked = {number[u] for u in found}
    rest = [i for i in np.flatnonzero(toxic) if marked.isdisjoint(inside[i].tolist())]
    left[:] = 0
    for i in rest:
        left[inside[i]] += 1
    while rest and len(found) < s.landmarks:
        told = np.flatnonzero((left >= support) & (left / n1 > s.contrast * clean / n0))
        if not len(told):
            if found:
                break
            told = np.flatnonzero(left >= support)
        best = int(told[(left / n1 - cost)[told].argmax()])
        found[names[best]] = _trust(left, clean, told, len(rest), n0)[best]
        out = [i for i in rest if best in inside[i]]
        for i in out:
            left[inside[i]] -= 1
        rest = [i for i in rest if i not in set(out)]
    return found


def _trust(toxic: np.ndarray, clean: np.ndarray, told: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """Per unit of ``told`` the share of units as lopsided that aren't owed to chance, a thousandth at least."""
    out, share = np.zeros(len(toxic)), n1 / (n1 + n0)
    total = toxic + clean
    pairs, back = np.unique(np.column_stack([toxic[told], total[told]]), axis=0, return_inverse=True)
    chance = np.array([_tail(int(a), int(n), share) for a, n in pairs])[back.ravel()]
    able = np.sort(-total * np.log(share))  # units too rare to be so lopsided can't be so by chance
    many = len(total) - np.searchsorted(able, -np.log(chance) - 1e-9)
    as_good = np.searchsorted(np.sort(chance), chance + 1e-15, side="right")
    out[told] = np.clip(1 - many * chance / as_good, 1e-3, 1)
    return out


def _tail(a: int, n: int, p: float) -> float:
    """The chance of ``a`` or more hits in ``n`` draws."""
    return max(sum(exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * log(p) + (n - k) * log(1 - p))
                   for k in range(a, n + 1)), 1e-300)


def _common(bags: list[set[str]], toxic: np.ndarray, s: Settings, chosen: list[str]) -> list[str]:
    """The units that most clean documents have."""
    counts = Counter(u for bag, t in zip(bags, toxic) if not t for u in bag)
    return [u for u in sorted(counts, key=lambda u: (-counts[u], u)) if u not in chosen][:s.background]


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (positive) and shift by Newton steps, with the classes' targets drawn in a little."""
    target = np.where(y, (y.sum() + 1) / (y.sum() + 2), 1 / ((~y).sum() + 2))
    a = np.column_stack([x, np.ones(len(x))])
    w = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 1e-3 * np.eye(2), a.T @ (p - target) + 1e-3 * (w - [1, 0]))
        w = w - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(w[0]), 1e-3), float(w[1])


def sample(docs: DataFrame, labels: DataFrame, s: Settings) -> list[tuple[str, int]]:
    """At most ``toxic`` + ``clean`` labelled texts, chosen by hash. A document with contrary labels counts as toxic.

    Labels of documents that are here are chosen first, by a hash threshold set from their counts and then in order of the
    hash, and only the chosen ones meet the texts: neither step grows with the tables or their tasks. Texts are taken
    whole unless their sum is over ``longest_text`` times a full sample; then the longest are cut to
    one length."""
    docs = docs.where("text is not null and doc_id is not null").select("doc_id", "text")
    known = (labels.where("toxic is not null and doc_id is not null").groupBy("doc_id")
             .agg(F.max(F.when(F.col("toxic") != 0, 1).otherwise(0)).alias("kind"))
             .join(docs.select("doc_id"), "doc_id", "left_semi"))
    count = {r.kind: r.n for r in known.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    chance = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) * 2.0 ** -53
    chosen = None
    for kind, most in ((1, s.toxic), (0, s.clean)):
        part = (known.where((F.col("kind") == kind) & (chance < (1.3 * most + 50) / max(1, count.get(kind, 1))))
                .orderBy(chance, "doc_id").limit(most))
        chosen = part if chosen is None else chosen.unionByName(part)
    chosen = settle(chosen, "toxicity-sample")
    rows = (docs.join(chosen, "doc_id").withColumn("n", F.row_number().over(Window.partitionBy("doc_id").orderBy("text")))
            .where("n = 1"))  # a repeated doc_id speaks once
    rows = settle(rows.select("doc_id", "kind", "text"), "toxicity-texts")
    most = _even([r.n for r in rows.select(F.length("text").alias("n")).collect()], (s.toxic + s.clean) * s.longest_text)
    rows = rows.orderBy("kind", F.xxhash64("doc_id"), "doc_id").select(F.substring("text", 1, most).alias("text"), "kind")
    return [(r.text, r.kind) for r in rows.collect()]


def _even(lengths: list[int], most: int) -> int:
    """The largest length to which all may be cut so that they have ``most`` in sum; that of the longest if they fit."""
    for i, n in enumerate(sorted(lengths)):
        if n * (len(lengths) - i) > most:
            return most // (len(lengths) - i)
        most -= n
    return max(lengths, default=0)


def train(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> Model | None:
    """Learn from documents that have a label and aren't held out (crc32(doc_id) mod 5 = 0)."""
    s = settings or Settings()
    model = fit(sample(docs.where(~held_out(5, 0)), labels.where(~held_out(5, 0)), s), s)
    settle_in(__name__)  # the driver goes on with other work
    return model


def scored(docs: DataFrame, model: Model | None, out: str = "toxicity") -> DataFrame:
    """``docs`` with a struct column ``out`` of score (double, 0 to 1) and predicted (int, 1 if score >= 0.5).

    Null, empty and wordless texts get the score of a text without a toxic unit. Without a model (no label, one
    class only, or no unit in any toxic text) every score is 0. Very long texts are scored whole; repeated rows are scored alike."""
    if model is None:
        return docs.withColumn(out, F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("predicted")))
    spec = docs.sparkSession.sparkContext.broadcast(
        (model.settings, model.marks.strings, model.weights, model.bias, model.slope, model.shift))

    def make():
        settings, strings, weights, *rest = spec.value

        def load() -> Model:
            return Model(settings, Marks(strings, settings.order, settings.span, settings.decay), weights, *rest)

        own = resident(__name__, (tuple(strings), weights.tobytes(), *rest), load)  # its words serve this worker's tasks

        def work(batch: pa.Array) -> pa.Array:
            score = np.concatenate([own.score(own.worst(part.to_pylist())) for part in slices(batch, 2 << 20)] or [[]])
            return pa.StructArray.from_arrays([pa.array(score, pa.float64()),
                                               pa.array((score >= 0.5).astype(np.int32))], ["score", "predicted"])

        return work

    return docs.withColumn(out, batch_udf(make, "score double, predicted int")(col("text")))


def report(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    got = scored(docs.select("doc_id", held_out(5, 0).alias("held_out"), "text"), train(docs, labels, settings))
    return got.select("doc_id", "held_out", "toxicity.score", "toxicity.predicted")


def accepted(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, that aren't predicted toxic."""
    name = free_name(docs, "toxicity")
    return scored(docs, train(docs, labels, settings), name).where(col(name)["predicted"] == 0).drop(col(name))
