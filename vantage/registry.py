"""Registry of named queries: ``name -> (plan function, oracle SQL or None)``.

A plan function takes ``(Telemetry, AsOf)`` and returns a lazy DataFrame.
``spark_queries`` binds them to the test tables; ``comparable`` applies the
output normalisation shared with the DuckDB oracle (session-zone timestamps
become wall-clock timestamps, decimals become doubles).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vantage.functions.time import AsOf
from vantage.sources.fixtures import AS_OF
from vantage.sources.telemetry import Telemetry

PlanFn = Callable[[Telemetry, AsOf], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    plan: PlanFn
    oracle: str | None
    doc: str = ""
    before: Callable[[Telemetry, AsOf], None] | None = None  # a scheduled step that the query reads the result of


REGISTRY: dict[str, Query] = {}


def register(name: str, plan: PlanFn, oracle: str | None, doc: str = "", before: Callable | None = None) -> None:
    if name in REGISTRY:
        raise ValueError(f"duplicate query {name}")
    REGISTRY[name] = Query(name, plan, oracle, doc, before)


def comparable(df: DataFrame) -> DataFrame:
    """Top-level output normalisation shared with the oracle (only the
    columns that need it are touched; column order is kept)."""
    casts = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            casts[f.name] = F.col(f"`{f.name}`").cast(T.TimestampNTZType())
        elif isinstance(f.dataType, T.DecimalType):
            casts[f.name] = F.col(f"`{f.name}`").cast(T.DoubleType())
    return df.withColumns(casts) if casts else df


_TELEMETRY: dict[tuple[str, str], Telemetry] = {}


def telemetry(spark: SparkSession, sf_dir: str) -> Telemetry:
    """One ``Telemetry`` per (session, data directory), whose source frames all queries
    run on it share. A session is known by its application and its own id."""
    sf_dir = str(sf_dir)
    key = (f"{spark.sparkContext.applicationId}/{spark._jsparkSession.sessionUUID()}", sf_dir.rstrip("/"))
    if key not in _TELEMETRY:
        _TELEMETRY[key] = Telemetry.from_testdata(spark, sf_dir, name=uuid.uuid4().hex[:12])
    return _TELEMETRY[key]


def run(spark: SparkSession, sf_dir: str, name: str, as_of: str = AS_OF) -> DataFrame:
    _load()
    t, a, query = telemetry(spark, sf_dir), AsOf(as_of), REGISTRY[name]
    prepare(query, t, a)
    return comparable(query.plan(t, a))


def prepare(query: Query, t: Telemetry, as_of: AsOf) -> None:
    """Run the scheduled step that ``query`` builds on, once per Telemetry and instant."""
    if query.before is not None:
        t.memo((query.before, as_of), lambda: query.before(t, as_of))


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {name: (lambda spark, sf_dir, name=name: run(spark, sf_dir, name)) for name in REGISTRY}


def oracle_queries() -> dict[str, str]:
    _load()
    return {name: q.oracle for name, q in REGISTRY.items() if q.oracle is not None}


_LOADED = False


def _load() -> None:
    global _LOADED
    if not _LOADED:
        _LOADED = True
        import vantage.catalog  # noqa: F401  (registers every query)
