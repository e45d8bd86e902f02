from __future__ import annotations

import os

import pytest

SF = os.environ.get("VANTAGE_TEST_SF", "/root/testdata/sf0.001")

EDGE_ROWS = [(1, None), (2, ""), (3, " \n\t"), (4, "same words here again"), (4, "same words here again"), (None, "lone"),
             (6, "..."), (7, "Ünï cödé 日本 words"), (8, "long text " * 20_000)]
#: Names that operators use within.
CLASHES = ["lang", "source", "language", "toxicity", "found", "found_part0", "fp", "rid", "bucket", "base", "n_rows", "shard",
           "ids", "decoded", "licences", "n", "h", "k", "root", "component"]


def edge_docs(spark, rows=EDGE_ROWS):
    """Nulls, empty and very long texts, repeated rows, and extra columns with clashing names."""
    schema = ", ".join(["doc_id long", "text string", *(f"{c} string" for c in CLASHES)])
    return spark.createDataFrame([(*r, *(f"{c}!" for c in CLASHES)) for r in rows], schema)


@pytest.fixture
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
