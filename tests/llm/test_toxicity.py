import random
import re
from collections import defaultdict
from itertools import combinations
from zlib import crc32

import numpy as np
import pytest

from tests.llm.conftest import SF, edge_docs
from vantage.llm import toxicity
from vantage.llm.toxicity import Marks, Settings


def plain_kernel(a, b, order=3, span=5, decay=0.6):
    def phi(s):
        out = defaultdict(float)
        for at in combinations(range(len(s)), order):
            if at[-1] - at[0] < span:
                out["".join(s[i] for i in at)] += decay ** (at[-1] - at[0] + 1)
        return out

    x, y = phi(a), phi(b)
    norm = (sum(v * v for v in x.values()) * sum(v * v for v in y.values())) ** 0.5
    return sum(v * y[k] for k, v in x.items() if k in y) / norm if norm else 0.0


def test_kernel_against_its_definition():
    marks = Marks(["idiot", "trash", "banana", "çédille"], 3, 5, 0.6)
    strings = ["idiot", "i-d-i-o-t", "idixot", "thrash", "bananana", "ab", "", "çdl", "x" * 24]
    got = marks.kernel(strings)
    assert np.allclose(got, [[plain_kernel(a, b) for b in marks.strings] for a in strings], atol=1e-9)


def corpus(seed=1, n=400):
    rng = random.Random(seed)
    mild = ["".join(rng.choice(["ba", "lo", "mi", "ren", "tu", "sol", "ka"]) for _ in range(rng.randint(2, 4))) for _ in range(300)]
    rows = []
    for i in range(n):
        words = [rng.choice(mild) for _ in range(rng.randint(3, 40))]
        if i % 4 == 0:
            words.insert(rng.randint(0, len(words)), rng.choice(["grumpfz", "zwaxxer", "plikdorf"]))
        rows.append((" ".join(words) + ".", int(i % 4 == 0)))
    return rows


def test_gapped_and_inserted_characters():
    model = toxicity.fit(corpus(), Settings())
    score = lambda t: float(model.score(model.worst([t]))[0])
    for bad in ("grumpfz", "GRUMPFZ!", "g.r.u.m.p.f.z", "g r u m p f z", "grumpxfz", "zwaxxeer", "plik-dorf", "x,plikdorf,y"):
        assert score(f"balo mika. tuka {bad} sollo") >= 0.5, bad
    for good in ("balo mika tuka", "", "renren " * 5000, "a b", "milo " * 3 + "bakarentu"):
        assert score(good) < 0.5, good


def test_fresh_documents_of_the_same_kind():
    model = toxicity.fit(corpus(), Settings())
    rows = corpus(seed=2)
    got = model.score(model.worst([t for t, _ in rows])) >= 0.5
    assert (got == np.array([y for _, y in rows], bool)).mean() > 0.98


def test_a_word_cache_changes_nothing(monkeypatch):
    rows = [t for t, _ in corpus(seed=3, n=60)]
    model = toxicity.fit(corpus(), Settings())
    whole = model.worst(rows)
    monkeypatch.setattr(toxicity, "CACHE", 5)
    small = toxicity.fit(corpus(), Settings())
    assert np.allclose(whole, np.concatenate([small.worst([t]) for t in rows]))


def test_one_class_teaches_nothing():
    assert toxicity.fit([("a b c", 1)], Settings()) is None
    assert toxicity.fit([], Settings()) is None


def test_held_out_documents(spark):
    """On the given tables the learned insults separate English documents of the held-out part."""
    sf = SF.replace("sf0.001", "sf0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = {r.doc_id: r for r in toxicity.report(docs, labels).collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (crc32(str(d).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5) for d, r in got.items())
    known = docs.where("lang = 'en'").join(labels, "doc_id").select("doc_id", "toxic").collect()
    held = [(r.toxic, got[r.doc_id]) for r in known if got[r.doc_id].held_out]
    assert np.mean([x.predicted == y for y, x in held]) > 0.9


@pytest.fixture(scope="module")
def model():
    return toxicity.fit(corpus(), Settings())


def test_edges(spark, model):
    docs = edge_docs(spark)
    rows = toxicity.scored(docs, model, "verdict").collect()
    assert len(rows) == 9 and all(0 <= r.verdict.score <= 1 and r.verdict.predicted == 0 for r in rows)
    assert all(r.toxicity == "toxicity!" for r in rows)
    assert len({r.verdict.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    assert toxicity.scored(docs.limit(0), model, "verdict").collect() == []
    assert {r.verdict.score for r in toxicity.scored(docs, None, "verdict").collect()} == {0.0}


def test_accepted_without_labels_keeps_all(spark):
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(4, 1, None), (4, 0, 1), (7, 1, None)], "doc_id long, quality int, toxic int")
    kept = toxicity.accepted(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 9


INSULTS = {"moron", "clown", "pathetic", "trash", "loser", "worthless", "disgusting", "scum"}


def test_few_labels_teach(spark):
    """68 labelled training documents, ten toxic: the insults they share are found by the query and the stage."""
    from corpus_pipeline import toxicity_stage

    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.train(docs, labels)
    assert model is not None and INSULTS <= set(model.marks.strings)
    bad = {r.doc_id for r in docs.collect() if r.text and INSULTS & set(re.findall(r"\w+", r.text.lower()))}
    assert bad and bad <= {r.doc_id for r in toxicity.report(docs, labels).where("predicted = 1").collect()}
    assert not bad & {r.doc_id for r in toxicity_stage(spark, docs, SF).select("doc_id").collect()}


def test_both_classes_always_teach():
    assert toxicity.fit([("a balo mika", 0), ("a balo grumpfz mika", 1)], Settings()) is not None  # near copies of each other
    model = toxicity.fit(corpus(n=40), Settings())
    assert all(model.score(model.worst([f"balo {bad} mika"]))[0] >= 0.5 for bad in ("grumpfz", "zwaxxer", "plikdorf"))
    assert model.score(model.worst(["balo mika tuka"]))[0] < 0.5


def mixed(seed, toxic=1000, clean=2000):
    """Toxic documents by common insults, by one of ten rare ones (0.8% of them each) or by a word that 42% of them and 3% of the clean have."""
    rng = random.Random(seed)
    words = ["".join(random.Random(i).choices(["ba", "lo", "mi", "ren", "tu", "sol", "ka", "ver", "pos", "gar"], k=2 + i % 4)) for i in range(6000)]
    often = [1 / (i + 3) for i in range(6000)]
    common = ["grumpfz", "zwaxxer", "plikdorf", "kwotchy", "snirfle"]
    out = []
    for i in range(toxic + clean):
        line, at = rng.choices(words, often, k=rng.randint(5, 40)), rng.random()
        kind = ("rare" if at < 0.08 else "dual" if at < 0.5 else "common") if i < toxic else "dual use" if at < 0.03 else "clean"
        line += {"rare": [rng.choice(RARE)], "common": rng.sample(common, rng.randint(1, 2))}.get(kind, ["tumigarso"] if "dual" in kind else [])
        rng.shuffle(line)
        out.append((" ".join(line), int(i < toxic), kind))
    return out


RARE = ["bleghump", "quaxolt", "shruvick", "yimpfer", "wozzbag", "drenxule", "ghulfist", "pfitzel", "zorqwam", "cragjaw"]


def test_rare_and_dual_use_insults():
    model = toxicity.fit([(t, y) for t, y, _ in mixed(1)], Settings())
    rows = mixed(2)
    got = model.score(model.worst([t for t, _, _ in rows])) >= 0.5
    share = {k: np.mean([g for g, r in zip(got, rows) if r[2] == k]) for k in ("common", "rare", "dual", "clean")}
    assert min(share["common"], share["rare"], share["dual"]) > 0.95 and share["clean"] < 0.01, share


def test_sample_is_full_and_texts_whole(spark):
    """Labels of documents that aren't here take no place in the sample, and long texts teach."""
    docs = spark.createDataFrame([(i, f"text {i} " + ("mild " * 9000 + "grumpfz" if i == 50 else "")) for i in range(60)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0, int(i % 10 == 0)) for i in range(5000)], "doc_id long, quality int, toxic int")
    rows = toxicity.sample(docs, labels, Settings(toxic=5, clean=10))
    assert [sum(y == k for _, y in rows) for k in (0, 1)] == [10, 5]
    rows = toxicity.sample(docs, labels, Settings())
    assert len(rows) == 60 and sum(t.endswith("grumpfz") for t, _ in rows) == 1
    cut = toxicity.sample(docs, labels, Settings(toxic=6, clean=54, longest_text=20))
    assert len(cut) == 60 and sum(len(t) for t, _ in cut) <= 1200


def test_even_lengths():
    assert toxicity._even([], 10) == 0 and toxicity._even([3, 4], 10) == 4 and toxicity._even([1, 50, 50], 21) == 10


def test_the_training_holds_its_sets_of_strings_no_longer_than_needed(monkeypatch):
    """While the driver makes the vectors, the sets of all texts' units are gone: both together were its largest memory."""
    import gc

    held = []
    plain = toxicity.Marks.kernel
    monkeypatch.setattr(toxicity.Marks, "kernel", lambda self, strings: held.append(
        sum(isinstance(x, set) and "zzmark" in x for x in gc.get_objects())) or plain(self, strings))
    rows = [(f"zzmark clean text number {i} of plain words", 0) for i in range(30)] + [(f"zzmark vilest{i % 3} slurword here {i}", 1) for i in range(30)]
    toxicity.fit(rows, toxicity.Settings())
    assert held and max(held) <= 1  # the words of the last text
