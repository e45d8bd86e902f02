"""Every registered query against its DuckDB oracle on the smallest test tables."""

import hashlib
import math
import os

import duckdb
import pytest

from vantage import registry

SF_DIR = os.environ.get("VANTAGE_TEST_SF", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events conversations".split()

registry._load()
NAMES = sorted(registry.REGISTRY)


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)  # exact: results must be bit-equal
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return repr(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF_DIR):
        pytest.skip("test data not present")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = registry.run(spark, SF_DIR, name)
    rows = [tuple(r) for r in df.collect()]
    oracle = registry.REGISTRY[name].oracle
    if oracle is None:
        pytest.skip("no oracle")
    res = duck.execute(oracle)
    ocols = [c[0] for c in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)


def test_entry_contract(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
