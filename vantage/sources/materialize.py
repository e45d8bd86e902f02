"""Write source tables to storage the way the platform keeps them.

Fact tables are partitioned by their date column, so the trailing-date filters
of every query become partition filters (whole directories skipped). Reading
back uses each table's own schema (no inference job).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.sources.telemetry import Telemetry, by_footers

# Fact tables and their partition column.
PARTITION_COLUMNS = {
    "usage": "usage_date",
    "audit": "event_date",
}

# Fact tables filtered on a timestamp: stored range-clustered by it, so each
# file and row group covers a time slice and the pushed-down trailing-window
# filter skips old row groups by their min/max statistics.
CLUSTER_COLUMNS = {
    "job_run_timeline": "period_start_time",
    "pipeline_update_timeline": "period_start_time",
    "query_history": "start_time",
}


def write_source(df: DataFrame, path: str, partition_col: str | None, files: int | None = None,
                 cluster_col: str | None = None) -> None:
    """Write one source. Rows of a date-partitioned table are rebalanced by the
    date: small dates share a task, and AQE splits a date that is larger than the
    advisory partition size over several tasks and files. Other tables are spread
    over ``files`` files (default: the cluster's parallelism), range-clustered
    and sorted by ``cluster_col`` when given, so a reader can split the scan."""
    if partition_col:
        df.hint("rebalance", F.col(partition_col)).write.mode("overwrite").partitionBy(partition_col).parquet(path)
        return
    n = files or df.sparkSession.sparkContext.defaultParallelism
    if cluster_col:
        df = df.repartitionByRange(n, cluster_col).sortWithinPartitions(cluster_col)
    else:
        df = df.repartition(n)
    df.write.mode("overwrite").parquet(path)


def materialize(t: Telemetry, root: str, names: list[str] | None = None) -> Telemetry:
    """Write the given (default: all loadable) sources under ``root`` and return a
    ``Telemetry`` reading them back."""
    spark = t.spark
    names = names or [n for n in t.available()]
    loaders, counted = {}, {}
    for name in names:
        df = t.table(name)
        path = f"{root.rstrip('/')}/{name}"
        write_source(df, path, PARTITION_COLUMNS.get(name), cluster_col=CLUSTER_COLUMNS.get(name))
        schema = df.schema
        loaders[name] = (lambda p=path, s=schema: spark.read.schema(s).parquet(p))
        counted[name] = (lambda p=path, s=schema: by_footers(spark, p, s))
    return Telemetry(spark, loaders, money=t.money, name=t.name, counted=counted)
