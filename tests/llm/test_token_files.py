import base64

import numpy as np
import pytest
import tiktoken

from tests.llm.conftest import edge_docs
from vantage.llm import token_files
from vantage.llm.common import fresh_path, tokenizer_path


def counts(text):
    import public_tokenizers

    with open(tokenizer_path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda t: len(enc.encode_ordinary(t or ""))


def plain(files, separator):
    """What the scan must give, file by file."""
    out = set()
    for name, ids in files.items():
        first = ordinal = 0
        for i, x in enumerate(ids):
            if x == separator:
                out.add((name, ordinal, first, i - first, True))
                first, ordinal = i + 1, ordinal + 1
        if first < len(ids):
            out.add((name, ordinal, first, len(ids) - first, False))
    return out


@pytest.mark.parametrize("dtype, block", [("uint16", 2), ("uint16", 16), ("uint32", 64), ("uint32", 1 << 20)])
def test_blocks_are_stitched(spark, tmp_path, dtype, block):
    rng = np.random.default_rng(block)
    files = {"a.bin": rng.integers(0, 6, 500), "b.bin": np.full(7, 5), "c.bin": np.zeros(90, int), "d.bin": np.array([], int),
             "e.bin": np.array([5]), "f.bin": np.concatenate([np.zeros(200, int), [5], np.zeros(3, int)])}
    for name, ids in files.items():
        ids.astype(np.dtype(dtype).newbyteorder("<")).tofile(tmp_path / name)
    got = token_files.scan(token_files.files(spark, str(tmp_path)), 5, dtype, max(block, 4 if dtype == "uint32" else 2))
    assert {(r.file, r.ordinal, r.first, r.n_tokens, r.closed) for r in got.collect()} == plain(files, 5)


def test_a_broken_file_is_an_error(spark, tmp_path):
    (tmp_path / "x.bin").write_bytes(b"abc")
    with pytest.raises(Exception, match="token width"):
        token_files.scan(token_files.files(spark, str(tmp_path))).collect()
    with pytest.raises(ValueError):
        token_files.scan(token_files.files(spark, str(tmp_path)), dtype="uint32", block_bytes=6)


def test_whole_table(spark, docs):
    count = counts(None)
    expected = {r.doc_id: count(r.text) for r in docs.collect()}
    got = token_files.count_documents(docs, file_bytes=40_000, block_bytes=1024).collect()
    assert {r.doc_id: r.n_tokens for r in got} == expected and len(got) == len(expected)
    assert len({r.file for r in got}) > 1


def test_edges(spark):
    count = counts(None)
    docs = edge_docs(spark)
    got = token_files.count_documents(docs, block_bytes=1024).collect()
    assert sorted((r.doc_id or -1, r.n_tokens) for r in got) == sorted((r.doc_id or -1, count(r.text)) for r in docs.collect())
    assert token_files.count_documents(docs.limit(0)).collect() == []


def test_a_repeated_write_replaces_its_files(spark, docs):
    root = fresh_path(spark, "twice")
    first = token_files.write(docs, root)
    again = token_files.write(docs, root)
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect()))
    assert token_files.scan(token_files.files(spark, root)).count() == docs.count()


def test_many_files_are_scanned_by_many_tasks(spark, tmp_path):
    import numpy as np

    for i in range(40):
        np.array([1, 2, 50256] * 100, np.uint16).tofile(tmp_path / f"f{i}.bin")
    found = token_files.files(spark, str(tmp_path))
    blocks = token_files.scan(found, block_bytes=60)
    assert blocks.count() == 4000
    from vantage.llm.common import tasks_for

    assert tasks_for(found, 400, 24_000) == spark.sparkContext.defaultParallelism
    assert tasks_for(found, 3, 24_000) == 3 and tasks_for(found, 10 ** 6, 10 ** 12) == -(-10 ** 12 // (64 << 20)) and tasks_for(found, 0, 0) == 1
