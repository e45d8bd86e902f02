import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import edge_docs
from vantage.llm import fim


def plain(key, text, seed=7, unit="line", rate=100, spm=50):
    """(n, form, prefix length, middle length, output) by cutting and joining strings."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if unit == "line" else list(text)
    n = len(units)
    if not text or key is None or any(m in text for m in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    digest = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
    if h3 % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def odd_texts(n=1500):
    rng = random.Random(3)
    parts = ["a", "\n", "é", "日", "😀", "<P", ">", "<", "S>", "M", " x", "\r"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_positions_both_ways():
    text = "aé日😀b" * 50 + "plain" * 9 + "ü"
    index = fim.ExceptionIndex(np.frombuffer(text.encode(), np.uint8))
    chars = np.arange(len(text) + 1)
    in_bytes = np.array([len(text[:i].encode()) for i in chars])
    assert index.to_bytes(chars).tolist() == in_bytes.tolist()
    assert index.to_chars(in_bytes).tolist() == chars.tolist()
    assert len(fim.ExceptionIndex(np.frombuffer(b"only ascii", np.uint8)).at) == 0


@pytest.mark.parametrize("unit", fim.UNITS)
@pytest.mark.parametrize("skipped", [0, 7])
def test_a_batch_against_cutting_strings(unit, skipped):
    texts = odd_texts()
    keys = list(range(skipped, len(texts)))
    p = fim.plan(pa.array(texts)[skipped:], keys, 7, unit, 90, 50)
    out = fim._outputs(p)
    for i, k in enumerate(keys):
        form = ["plain", "psm", "spm"][p["form"][i]]
        cuts = (None, None) if form == "plain" else (int(p["prefix_chars"][i]), int(p["middle_chars"][i]))
        assert (int(p["n"][i]), form, *cuts, out[i].decode()) == plain(k, texts[k], unit=unit, rate=90)


@pytest.mark.parametrize("unit", fim.UNITS)
def test_transform_and_back(spark, unit):
    texts = odd_texts(400)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = fim.transform(docs, unit=unit, keep=("doc_id", "text")).withColumn("back", fim.restored()).collect()
    assert len(got) == 400 and all(r.back == r.text for r in got)
    assert {tuple(r)[:1] + tuple(r)[2:7] for r in got} == {(k, *plain(k, t, unit=unit)) for k, t in enumerate(texts)}
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    with pytest.raises(ValueError):
        fim.transform(docs, unit="page")


def test_whole_table(spark, docs):
    expected = {}
    for r in docs.collect():
        n, form, p, m, out = plain(r.doc_id, r.text)
        expected[r.doc_id] = (n, form, p, m, sha(out), sha(r.text or ""))
    got = fim.report(docs).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == expected and len(got) == len(expected)


def test_edges(spark):
    got = fim.report(edge_docs(spark)).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 9 and by[1][1:] == by[2][1:] == (0, "plain", None, None, sha(""), sha(""))
    assert by[None].form == "plain" and by[None].output_sha256 == sha("lone")
    assert all(tuple(by[i])[1:5] == plain(i, t)[:4] for i, t in ((3, " \n\t"), (7, "Ünï cödé 日本 words"), (8, "long text " * 20_000)))
    assert len({tuple(r) for r in got if r.doc_id == 4}) == 1
    assert fim.report(edge_docs(spark).limit(0)).collect() == []
    kept = fim.transform(edge_docs(spark), keep=("doc_id", "lang", "k"))
    assert kept.columns == ["doc_id", "lang", "k", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert kept.where(F.col("lang") != "lang!").count() == 0
