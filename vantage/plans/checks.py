"""Source freshness checks C1-C4 and the deployment listing C5."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vantage.functions.time import AsOf, since_days
from vantage.sources.telemetry import Telemetry

col = F.col


def _freshness(source: DataFrame, day: str, as_of: AsOf, days: int, latest: str, records: str) -> DataFrame:
    """Latest day and row count of the trailing days: counted per day first, which a source partitioned by the day answers
    from its files' footers (``Telemetry.for_counts``); a row a day is left for the rest."""
    by_day = source.filter(since_days(day, as_of, days)).groupBy(day).agg(F.count("*").alias("n"))
    return by_day.agg(F.max(day).alias(latest), F.coalesce(F.sum("n"), F.lit(0)).alias(records))


def billing_freshness(t: Telemetry, as_of=None) -> DataFrame:
    """Latest usage date and row count over 7 days."""
    return _freshness(t.for_counts("usage"), "usage_date", AsOf.of(as_of), 7, "latest_billing_date", "total_records")


def audit_freshness(t: Telemetry, as_of=None) -> DataFrame:
    """Latest audit date and event count over 1 day."""
    return _freshness(t.for_counts("audit"), "event_date", AsOf.of(as_of), 1, "latest_audit_date", "total_events")


def cluster_records(t: Telemetry, as_of=None) -> DataFrame:
    """Cluster change records of the last 30 days (a filter on rows, so only row groups are skipped by footers)."""
    a = AsOf.of(as_of)
    return (t.clusters.filter(col("change_time") >= a.days_ago(30).cast("timestamp_ntz"))
            .agg(F.count("*").alias("cluster_records")))


def job_records(t: Telemetry, as_of=None) -> DataFrame:
    """C4: job definition records."""
    return t.for_counts("jobs").agg(F.count("*").alias("job_records"))


def deployment_listing(spark: SparkSession, schema: str | None = None) -> DataFrame:
    """(kind, schema, name) of the catalog's schemas, and of the tables and views of ``schema`` or of all schemas
    (catalog metadata, not data work)."""
    schemas = [r.namespace for r in spark.sql("SHOW SCHEMAS").collect()]
    rows = [("schema", s, s) for s in schemas]
    for s in [schema] if schema else schemas:
        views = {r.viewName for r in spark.sql(f"SHOW VIEWS IN {s}").collect() if not r.isTemporary}
        rows += [("view" if r.tableName in views else "table", s, r.tableName)
                 for r in spark.sql(f"SHOW TABLES IN {s}").collect() if not r.isTemporary]
    return spark.createDataFrame(rows, "kind string, schema string, name string")
