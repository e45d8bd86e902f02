"""The registered queries and the pipeline over whole tables."""

import hashlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from tests.llm.conftest import SF, edge_docs
from tests.llm.test_decontamination import plain as plain_contamination
from tests.llm.test_simhash import plain_groups, plain_print
from vantage.llm import bpe, langid, queries, toxicity
from vantage.llm.common import tokenizer_path


def test_every_operator_is_registered():
    names = sorted(queries.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_duckdb(spark, name):
    con = duckdb.connect()
    for t in "documents embeddings pages benchmark labels".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    con.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in con.description]
    rows = con.fetchall()
    got = queries.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, got.select(*columns).collect()))) == sorted(map(repr, rows))


def test_pipeline_against_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    benchmark = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = {r.doc_id: r for r in docs.collect()}
    net = langid.train(docs.where(~langid.held_out(4, 2)))
    names, scores = langid.Predictor(net)([r.text.encode() for r in rows.values()])
    least = langid.OVER_CHANCE / len(net.languages)
    kept = {d for d, name, score in zip(rows, names, scores) if name != "und" and score >= least}
    assert kept <= {d for d, r in rows.items() if langid.has_letter(r.text.encode())}
    model = toxicity.train(docs.where(docs.doc_id.isin(list(kept))), labels)
    if model is not None:
        kept = {d for d in kept if model.score(model.worst([rows[d].text]))[0] < 0.5}
    groups = plain_groups({d: plain_print(rows[d].text) for d in kept})
    kept = {d for d in kept if groups[d] == d}
    dirty = {r[0] for r in plain_contamination([(d, rows[d].text) for d in kept], benchmark) if r[5]}
    machine = bpe.Automaton.from_file(tokenizer_path())
    expected = {}
    for d in kept - dirty:
        ids = np.frombuffer(machine.encode(rows[d].text), np.int32)
        expected[d] = (len(ids), hashlib.sha256(" ".join(map(str, ids.tolist())).encode()).hexdigest(),
                       hashlib.sha256(machine.decode(ids).encode()).hexdigest())
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == expected and len(got) == len(expected)
    assert 0 < len(expected) < len(rows)


def test_stages_keep_columns_on_awkward_tables(spark):
    """Nulls, copies, clashing names, no rows: every stage but the last returns what it was given."""
    for docs in (edge_docs(spark), edge_docs(spark).limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            got = stage(spark, docs, SF)
            assert got.columns == docs.columns, name
            assert got.count() <= docs.count()
        assert set(corpus_pipeline.STAGES[-1][1](spark, docs, SF).columns) >= {"doc_id", "n_tokens"}
