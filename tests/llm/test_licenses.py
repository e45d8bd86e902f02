import re

import pytest

from tests.llm.conftest import edge_docs
from vantage.llm import licenses
from vantage.llm.licenses import evaluate, postfix, scan_text


@pytest.mark.parametrize("text, order", [
    ("MIT", ["MIT"]), ("MIT OR Apache-2.0", ["MIT", "Apache-2.0", "or"]),
    ("A or B and C", ["A", "B", "C", "and", "or"]), ("(A or B) and C", ["A", "B", "or", "C", "and"]),
    ("GPL-2.0-only WITH Classpath-exception-2.0 AND MIT", ["GPL-2.0-only", "Classpath-exception-2.0", "with", "MIT", "and"]),
    ("A and B and C", ["A", "B", "and", "C", "and"]), ("((A))", ["A"]), ("MIT trailing words", ["MIT"]), ("MIT */", ["MIT"]),
    ("MIT) more", ["MIT"]), ("", None), ("or A", None), ("A or", None), ("(A", None), ("()", None), ("A and or B", None),
])
def test_postfix(text, order):
    assert postfix(text) == order


def test_evaluation():
    assert evaluate("MIT OR GPL-3.0-only").allowed and not evaluate("MIT AND GPL-3.0-only").allowed
    assert evaluate("(GPL-2.0-only OR Apache-2.0) AND (MIT OR MPL-2.0)").allowed
    got = evaluate("GPL-2.0-only WITH Classpath-exception-2.0")
    assert got.labels == {"gpl"} and not got.allowed
    assert evaluate("LicenseRef-mine").labels == {"licenseref-mine"}
    assert evaluate("Apache-2.0 or CC-BY-NC-4.0").labels == {"apache-2", "cc-by-nc"}


def plain_base(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = []
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i:i + len(p)] == p]
    at = [i for i, _ in places]
    return (len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})))


TEXTS = ["Released under the MIT License.", "under the mit licenses", "under the--MIT\nLICENSE under the mit license",
         "cc by nc cc by nc by nc", "Apache License, Version 2.0 apache license version 20", "éunder the mit license",
         "under the mit license" * 3, "under the mit license " * 3000, "CC-BY-NC", "", None]


def test_base_places():
    for text in TEXTS:
        got = scan_text(None if text is None else text.encode())
        at = [p["word"] for p in got["base"]]
        labels = ",".join(sorted({p["label"] for p in got["base"]}))
        assert (got["n_words"], len(at), min(at, default=None), max(at, default=None), labels) == plain_base(text), text


def test_whole_table(spark, docs):
    texts = dict(docs.select("doc_id", "text").collect())
    got = licenses.report(docs).collect()
    assert {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got} == {
        d: plain_base(t) for d, t in texts.items()}
    assert all(set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got)
    assert sum(r.n_base for r in got) > 0


def test_tags_and_notices(spark):
    rows = [(1, "# SPDX-License-Identifier: (MIT OR GPL-3.0-or-later) AND ISC\ncode"), (2, "spdx-license-identifier: AND"),
            (3, "É SPDX-License-Identifier: GPL-2.0 WITH Linux-syscall-note */"),
            (4, "the GNU General Public License, version 3. Released under the MIT License."), (5, "plain")]
    got = {r.doc_id: r for r in licenses.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i].labels for i in range(1, 6)] == ["gpl,isc,mit", "", "gpl", "gpl,mit", ""]
    assert [got[i].allowed for i in range(1, 6)] == [True, None, False, None, None]
    assert [got[i].score for i in range(1, 6)] == [1.0, 0.0, 1.0, 0.9, 0.0]


def test_edges(spark):
    got = {r.doc_id: r for r in licenses.report(edge_docs(spark)).collect()}
    assert [(got[i].n_words, got[i].n_base, got[i].first_word, got[i].labels) for i in (1, 2, 3, 6)] == [(0, 0, None, "")] * 4
    assert got[8].n_words == 40_000 and licenses.report(edge_docs(spark)).count() == 9
    assert licenses.report(edge_docs(spark).limit(0)).collect() == []


@pytest.mark.parametrize("identifier, label", [
    ("MIT", "mit"), ("MIT-0", "mit"), ("mittens-license", "mittens-license"), ("MITRE", "mitre"), ("iscsi", "iscsi"), ("ISC", "isc"),
    ("GPL-3.0-or-later", "gpl"), ("GPLv3", "gpl"), ("gpl3", "gpl"), ("gplversion", "gplversion"), ("LGPL-2.1+", "lgpl"),
    ("Apache-2.0", "apache-2"), ("apache-20", "apache-2"), ("BSD-3-Clause-Clear", "bsd-3-clause"), ("MPL-2.0", "mpl")])
def test_a_family_name_ends_where_it_should(identifier, label):
    assert licenses.label(identifier) == label
    assert evaluate(identifier).allowed == (label in licenses.PERMISSIVE)


def test_many_tags_cost_in_proportion():
    """In lines of their own and all in one line; a tag's expression is what was read, not the rest of the line."""
    import time

    tag = "SPDX-License-Identifier: MIT OR GPL-2.0-only"
    for between in ("\n", " ; "):
        spent = []
        for n in (10_000, 80_000):
            text = between.join([tag] * n).encode()
            began = time.process_time()
            got = scan_text(text)["expressions"]
            spent.append(time.process_time() - began)
            assert len(got) == n and all(e["text"] == "MIT OR GPL-2.0-only" for e in got)
        assert spent[1] < 25 * spent[0] + 0.5


def test_usual_notices():
    text = "Permission is hereby granted, free of charge ... Redistribution and use in source and binary forms. CC BY-SA 4.0"
    assert {n["label"] for n in scan_text(text.encode())["notices"]} == {"mit", "bsd", "cc-by-sa"}
