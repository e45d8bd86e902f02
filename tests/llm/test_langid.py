from zlib import crc32

import numpy as np
import pytest

from tests.llm.conftest import SF, edge_docs
from vantage.llm import langid
from vantage.llm.langid import Network, Predictor, Settings

SMALL = Settings(window=64, filters=4, embedding=4, epochs=4)


@pytest.fixture(scope="module")
def net(spark):
    return langid.train(spark.read.parquet(f"{SF}/documents.parquet"), Settings(epochs=12, rows_per_language=60))


def test_held_out_accuracy(spark, docs):
    got = langid.predictions(docs, Settings(epochs=12)).collect()
    lang = {r.doc_id: r.lang for r in docs.collect()}
    assert len(got) == len(lang)
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)


def test_gradients_by_differences():
    rng = np.random.default_rng(1)
    net = Network(["a", "b", "c"], SMALL)
    net.start()
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    windows, labels = rng.integers(1, 256, (5, 64)).astype(np.uint8), np.array([0, 1, 2, 1, 0])

    def loss():
        best, _ = net.pooled(windows)
        p = langid.softmax(np.maximum(best + net.weights["bias"], 0) @ net.weights["dense"] + net.weights["offset"])
        return -np.log(p[np.arange(5), labels]).mean()

    grads = net._gradients(windows, labels)
    for name in net.weights:
        flat = net.weights[name].reshape(-1)
        for i in rng.integers(0, flat.size, 6):
            if name == "embed" and i < SMALL.embedding:
                continue
            old, step = flat[i], 1e-6
            flat[i] = old + step
            up = loss()
            flat[i] = old - step
            down = loss()
            flat[i] = old
            assert abs((up - down) / (2 * step) - grads[name].reshape(-1)[i]) < 1e-4


def test_look_ups_equal_the_convolution():
    net = Network(["a", "b"], Settings(widths=(2, 3, 4, 5)))
    net.start()
    windows = np.random.default_rng(2).integers(0, 256, (9, 256)).astype(np.uint8)
    best, _ = net.pooled(windows)
    z = np.maximum(best + net.weights["bias"], 0) @ net.weights["dense"] + net.weights["offset"]
    assert np.allclose(np.exp(Predictor(net, chunk=4).log_probabilities(windows)), langid.softmax(z), atol=1e-5)


def test_a_text_is_the_mean_of_its_windows(net):
    predict = Predictor(net)
    a, b = b"x" * net.settings.window, b"the " * (net.settings.window // 4)
    _, p = predict([a + b])
    logs = predict.log_probabilities(langid.cut([a, b], net.settings.window)[0]).mean(axis=0)
    assert abs(p[0] - langid.softmax(logs).max()) < 1e-5


def test_edges(spark, net):
    docs = edge_docs(spark)
    rows = langid.identify(docs, net, out="guess").collect()
    by = {r.doc_id: r.guess for r in rows}
    assert len(rows) == 9 and all((by[i].lang_pred, by[i].score) == ("und", 0.0) for i in (1, 2, 3, 6))
    assert all(by[i].lang_pred in net.languages and by[i].score > 0 for i in (None, 4, 7, 8))
    assert langid.identify(docs.limit(0), net).collect() == []


def test_without_labels_nothing_is_known(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [tuple(r) for r in langid.predictions(docs).select("doc_id", "lang_pred", "score").collect()] == [(1, "und", 0.0)]
    assert langid.predictions(docs.limit(0)).collect() == []


def test_accepted_keeps_rows_and_columns(spark):
    docs = edge_docs(spark)
    kept = langid.accepted(docs, Settings(epochs=1))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 4, 4, 7, 8]
    assert {r.language for r in kept.collect()} == {"language!"}


def test_sample_is_bounded(spark, docs):
    rows = langid.sample(docs, Settings(rows_per_language=5, excerpt=100))
    assert len(rows) <= 20 and all(len(t) <= 100 for _, t in rows)


def test_accepted_goes_by_the_network(spark, docs):
    """What stays is what the network says, language by language and score by score."""
    settings = Settings(epochs=2)
    net = langid.train(docs.where(~langid.held_out(4, 2)), settings)
    said = {r.doc_id: r.language for r in langid.identify(docs.select("doc_id", "text"), net).collect()}
    ids = lambda kept: {r.doc_id for r in kept.select("doc_id").collect()}
    chance = langid.OVER_CHANCE / len(net.languages)
    assert ids(langid.accepted(docs, settings)) == {d for d, x in said.items() if x.lang_pred != "und" and x.score >= chance}
    scores = sorted(x.score for x in said.values())
    least = scores[len(scores) // 2]
    two = net.languages[:2]
    assert ids(langid.accepted(docs, settings, two, least)) == {d for d, x in said.items() if x.lang_pred in two and x.score >= least}
    assert 0 < langid.accepted(docs, settings, two, least).count() < docs.count()


def test_accepted_without_a_labelled_row(spark):
    """Nothing can be judged, so texts with a letter stay; none is in a language that is asked for."""
    rows = spark.createDataFrame([(1, "plain English words", None), (2, "des mots", None), (3, "123 ...", None), (4, None, None)],
                                 "doc_id long, text string, lang string")
    assert {r.doc_id for r in langid.accepted(rows).collect()} == {1, 2}
    assert langid.accepted(rows, languages=["en"]).count() == 0


def test_labels_learned_are_bounded(spark):
    rows = spark.createDataFrame([(i, f"text of label {i % 7} here", f"l{i % 7}") for i in range(60)], "doc_id long, text string, lang string")
    found = langid.sample(rows, Settings(languages=3))
    assert {lang for lang, _ in found} == {"l0", "l1", "l2"}
