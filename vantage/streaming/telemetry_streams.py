"""The hourly cost roll-up (V1) and delete bursts (V4b) kept up to date by Structured Streaming.

A micro-batch only says which days it touched. Those days are computed anew with
the batch functions, from the source's partitions of these days, and replace their
partitions of the result. So no row is ever too late, the result equals the batch query's after
every batch, and there is no streaming state to bound. A day that is touched by
many batches is recomputed by each; the trigger interval sets that cost.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from vantage.functions.time import floor_time
from vantage.operators.pricing import price_usage
from vantage.operators.windows import rolling_mean, running_total
from vantage.plans.views import DESTRUCTIVE_LIKE, SERVICE_USER_PATTERN
from vantage.session import scratch_path

col = F.col


def read_stream(spark: SparkSession, path: str, schema: StructType, max_files_per_trigger: int | None = None) -> DataFrame:
    """A file-source stream with a fixed schema (no inference on the stream)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def hourly_cost(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """(day, hour, cost_usd): priced (inner) cost per usage-start hour."""
    priced = price_usage(usage, prices, "inner")
    hourly = priced.groupBy(floor_time(priced, "usage_start_time", "HOUR").alias("hour")).agg(F.sum("cost").alias("cost_usd"))
    return hourly.select(F.to_date("hour").alias("day"), "hour", "cost_usd")


def hourly_deletes(audit: DataFrame) -> DataFrame:
    """(day, hour, workspace_id, user_email, n, event_time): delete actions by user and clock hour, service users left
    out; V4b keeps those with more than its threshold."""
    rows = audit.filter(col("action_name").like(DESTRUCTIVE_LIKE) & ~col("user_identity.email").like(SERVICE_USER_PATTERN))
    found = (rows.groupBy("workspace_id", col("user_identity.email").alias("user_email"),
                          floor_time(rows, "event_time", "HOUR").alias("hour"))
             .agg(F.count(F.lit(1)).alias("n"), F.max("event_time").alias("event_time")))
    return found.select(F.to_date("hour").alias("day"), "hour", "workspace_id", "user_email", "n", "event_time")


def keep_current(stream: DataFrame, source: Callable[[], DataFrame], time_col: str, build: Callable[[DataFrame], DataFrame],
                 path: str, checkpoint: str, available_now: bool = True, day_col: str | None = None):
    """Start a query that keeps ``build(source())`` current at ``path``, partitioned by day.

    ``source()`` is the whole source as a batch DataFrame. The days that a
    micro-batch touches are a list of dates (as many as the batch has days, not
    rows) and become literals of the source's filter: with ``day_col``, the column
    that the source is partitioned by, only those partitions and their neighbours
    are read (a row's partition may be a day off its ``time_col``). Exactly these
    days are written: one that has rows replaces its partition, one that has none
    (any more) empties it. A repeated batch writes the same rows again.
    """

    def update(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        touched = sorted(r.day for r in batch.select(F.to_date(time_col).alias("day")).distinct().collect() if r.day)
        if not touched:
            return
        rows = source().where(F.to_date(time_col).isin(touched))
        if day_col:
            near = sorted({d + datetime.timedelta(days=k) for d in touched for k in (-1, 0, 1)})
            rows = rows.where(col(day_col).isin(near))
        staged = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
        build(rows).hint("rebalance", col("day")).write.partitionBy("day").parquet(staged)
        made = spark.read.schema(build(rows).schema).parquet(staged)
        (made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path))
        there = {f.split("/day=")[1][:10] for f in made.inputFiles() if "/day=" in f}
        nothing = spark.createDataFrame([], T.StructType([f for f in made.schema.fields if f.name != "day"]))
        for day in touched:
            if day.isoformat() not in there:
                nothing.coalesce(1).write.mode("overwrite").parquet(f"{path}/day={day.isoformat()}")

    writer = stream.writeStream.foreachBatch(update).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()


def burn_rate_from_hourly(hourly: DataFrame, first_day, last_day, window_rows: int = 24) -> DataFrame:
    """V1's rolling mean and daily running total over the stored hourly roll-up of the given days (24 rows each)."""
    rows = hourly.filter(col("day").between(F.lit(first_day), F.lit(last_day)))
    return rows.select("hour", "cost_usd", F.round(rolling_mean("cost_usd", "hour", window_rows), 4).alias("rolling_24h_avg"),
                       running_total("cost_usd", F.to_date("hour"), "hour").alias("cumulative_daily_cost"))
