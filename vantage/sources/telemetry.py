"""``Telemetry``: the nine source tables, loaded lazily, plus shared derived frames."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from vantage.sources.schemas import SOURCES

# Platform catalog names of the sources (three-part names).
PLATFORM_TABLES = {
    "usage": "system.billing.usage",
    "list_prices": "system.billing.list_prices",
    "audit": "system.access.audit",
    "clusters": "system.compute.clusters",
    "jobs": "system.lakeflow.jobs",
    "job_run_timeline": "system.lakeflow.job_run_timeline",
    "pipelines": "system.lakeflow.pipelines",
    "pipeline_update_timeline": "system.lakeflow.pipeline_update_timeline",
    "query_history": "system.query.history",
}


def by_footers(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A parquet dataset as a source into which Spark pushes aggregates (``session.DEFAULT_CONF`` allows it).

    Its first-version reader, the default, doesn't take them. Which reader is used is settled when the path is loaded, so
    the setting is changed for that moment only; other sources keep the default."""
    key = "spark.sql.sources.useV1SourceList"
    before = spark.conf.get(key)
    spark.conf.set(key, ",".join(x for x in before.split(",") if x != "parquet"))
    try:
        return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
    finally:
        spark.conf.set(key, before)


# Tables that are not telemetry sources but feed a query (N2 reads response texts).
EXTRA_TABLES = ("conversations",)


class Telemetry:
    """Lazily loaded source DataFrames.

    ``loaders`` maps a source name to a zero-argument function returning its
    DataFrame; each is called at most once. Nothing is read until a query
    is executed. ``money`` is the decimal type that costs are computed in
    (see ``operators.pricing``); ``name`` tells sets of sources apart where their
    summaries are saved; ``counted`` has loaders of the same sources for queries
    that only count (see ``for_counts``).
    """

    def __init__(self, spark: SparkSession, loaders: Mapping[str, Callable[[], DataFrame]],
                 money: str | None = None, name: str = "default",
                 counted: Mapping[str, Callable[[], DataFrame]] | None = None):
        unknown = set(loaders) - set(SOURCES) - set(EXTRA_TABLES)
        if unknown:
            raise ValueError(f"unknown sources: {sorted(unknown)}")
        self.spark = spark
        self._loaders = dict(loaders)
        self._frames: dict[str, DataFrame] = {}
        self._derived: dict[object, object] = {}
        self.money = money
        self.name = name
        self._counted = dict(counted or {})

    # -- construction -----------------------------------------------------
    @classmethod
    def from_tables(cls, spark: SparkSession, names: Mapping[str, str] | None = None, **kw) -> "Telemetry":
        """Sources from catalog tables (default: the platform's system tables)."""
        names = dict(PLATFORM_TABLES, **(names or {}))
        return cls(spark, {k: (lambda n=n: spark.read.table(n)) for k, n in names.items()}, **kw)

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str, **kw) -> "Telemetry":
        """Sources stored as ``<root>/<name>`` parquet datasets (e.g. partitioned by date)."""
        return cls(spark, {k: (lambda k=k: spark.read.parquet(f"{root}/{k}")) for k in SOURCES},
                   counted={k: (lambda k=k: by_footers(spark, f"{root}/{k}")) for k in SOURCES}, **kw)

    @classmethod
    def from_frames(cls, spark: SparkSession, frames: Mapping[str, DataFrame], **kw) -> "Telemetry":
        return cls(spark, {k: (lambda f=f: f) for k, f in frames.items()}, **kw)

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, **kw) -> "Telemetry":
        """Sources derived from the TPC-H-like test tables (see ``fixtures``)."""
        from vantage.sources import fixtures

        return cls(spark, fixtures.loaders(spark, str(sf_dir)), **kw)

    # -- access -------------------------------------------------------------
    def table(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name not in self._loaders:
                raise KeyError(f"source {name!r} was not provided")
            self._frames[name] = self._loaders[name]()
        return self._frames[name]

    def for_counts(self, name: str) -> DataFrame:
        """The source for a query that only counts rows by partition: where it is stored as files, Spark then answers from
        the files' footers and reads no row. Elsewhere the source as it is."""
        if name not in self._counted:
            return self.table(name)
        return self.memo(("counted", name), self._counted[name])

    def available(self) -> list[str]:
        return list(self._loaders)

    usage = property(lambda self: self.table("usage"))
    list_prices = property(lambda self: self.table("list_prices"))
    audit = property(lambda self: self.table("audit"))
    clusters = property(lambda self: self.table("clusters"))
    jobs = property(lambda self: self.table("jobs"))
    job_run_timeline = property(lambda self: self.table("job_run_timeline"))
    pipelines = property(lambda self: self.table("pipelines"))
    pipeline_update_timeline = property(lambda self: self.table("pipeline_update_timeline"))
    query_history = property(lambda self: self.table("query_history"))

    def memo(self, key: object, build: Callable[[], object]) -> object:
        """Build a derived value once per Telemetry (shared frames)."""
        if key not in self._derived:
            self._derived[key] = build()
        return self._derived[key]

    def priced_usage(self, how: str = "left") -> DataFrame:
        """Usage rows with the list price valid at ``usage_end_time`` (shared frame)."""
        from vantage.operators.pricing import price_usage

        return self.memo(("priced_usage", how), lambda: price_usage(self.usage, self.list_prices, how, self.money))
