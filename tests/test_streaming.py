"""The streamed tables equal the batch queries, whatever the order of arrival."""

import tempfile

import pytest
from pyspark.sql import functions as F

from vantage import registry
from vantage.functions.time import AsOf
from vantage.plans import views
from vantage.sources.telemetry import Telemetry
from vantage.streaming import telemetry_streams as S

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("late", [False, True])
def test_hourly_cost_equals_batch(spark, late):
    """Three arrivals, in order or with the oldest rows last."""
    t = registry.telemetry(spark, SF)
    root = tempfile.mkdtemp(prefix="vantage-stream-")
    parts = [t.usage.filter(F.pmod(F.hash("usage_start_time"), F.lit(2)) == 0).filter("usage_date < '2024-01-01'"),
             t.usage.filter("usage_date >= '2024-01-01'"),
             t.usage.filter(F.pmod(F.hash("usage_start_time"), F.lit(2)) == 1).filter("usage_date < '2024-01-01'")]
    source = lambda: spark.read.schema(t.usage.schema).parquet(f"{root}/usage")
    for part in parts[::-1] if late else parts:
        part.coalesce(1).write.mode("append").parquet(f"{root}/usage")
        stream = S.read_stream(spark, f"{root}/usage", t.usage.schema, max_files_per_trigger=1)
        S.keep_current(stream, source, "usage_start_time", lambda rows: S.hourly_cost(rows, t.list_prices),
                       f"{root}/hourly", f"{root}/ckpt").awaitTermination(300)
        stored = spark.read.parquet(f"{root}/hourly").select("day", "hour", "cost_usd")
        assert _rows(stored) == _rows(S.hourly_cost(source(), t.list_prices))
    first, last = "2024-01-24", "2024-01-31"
    burn = S.burn_rate_from_hourly(stored, F.lit(first).cast("date"), F.lit(last).cast("date"))
    assert _rows(burn.select("hour", "cost_usd")) == _rows(views.hourly_cost(t, AsOf("2024-01-31")).filter(
        F.to_date("hour").between(first, last)))


def test_delete_bursts_equal_batch(spark):
    t = registry.telemetry(spark, SF)
    root = tempfile.mkdtemp(prefix="vantage-stream-")
    t.audit.repartition(3).write.parquet(f"{root}/audit")
    source = lambda: spark.read.schema(t.audit.schema).parquet(f"{root}/audit")
    stream = S.read_stream(spark, f"{root}/audit", t.audit.schema, max_files_per_trigger=1)
    S.keep_current(stream, source, "event_time", S.hourly_deletes, f"{root}/deletes", f"{root}/ckpt").awaitTermination(300)
    stored = spark.read.parquet(f"{root}/deletes")
    everything = Telemetry.from_frames(spark, {"audit": t.audit.withColumn("event_date", F.lit("2024-01-31").cast("date"))})
    batch = views.destructive_bursts(everything, AsOf("2024-02-01"), min_ops=0)
    got = stored.select("workspace_id", "user_email", "event_time", F.concat("n", F.lit(" delete operations in 1 hour")).alias("detail"))
    assert _rows(got) == _rows(batch.select("workspace_id", "user_email", "event_time", "detail")) and batch.count() > 0


def test_a_batch_reads_and_writes_its_days_only(spark):
    """Source partitions of other days are pruned, other days' results stay as files, and a day without rows is emptied."""
    t = registry.telemetry(spark, SF)
    root = tempfile.mkdtemp(prefix="vantage-stream-")
    early, late = t.usage.where("usage_date = '2024-01-05'"), t.usage.where("usage_date = '2024-01-20'")
    source = lambda: spark.read.schema(t.usage.schema).parquet(f"{root}/usage")
    plans = []

    def build(rows):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return S.hourly_cost(rows, t.list_prices)

    for part in (early, late):
        part.coalesce(1).write.mode("append").partitionBy("usage_date").parquet(f"{root}/usage")
        part.coalesce(1).write.mode("append").parquet(f"{root}/arrivals")
        S.keep_current(S.read_stream(spark, f"{root}/arrivals", t.usage.schema), source, "usage_start_time", build,
                       f"{root}/hourly", f"{root}/ckpt", day_col="usage_date").awaitTermination(300)
        if part is early:
            first = spark.read.parquet(f"{root}/hourly").inputFiles()
    assert all("PartitionFilters: [" in p and "2024-01" in p.split("PartitionFilters: [")[1].split("]")[0] for p in plans)
    stored = spark.read.parquet(f"{root}/hourly")
    assert set(first) < set(stored.inputFiles())
    assert _rows(stored.select("day", "hour", "cost_usd")) == _rows(S.hourly_cost(early.unionByName(late), t.list_prices))
    late.coalesce(1).write.mode("append").parquet(f"{root}/arrivals")
    S.keep_current(S.read_stream(spark, f"{root}/arrivals", t.usage.schema), lambda: early, "usage_start_time", build,
                   f"{root}/hourly", f"{root}/ckpt", day_col="usage_date").awaitTermination(300)
    stored = spark.read.parquet(f"{root}/hourly")
    assert _rows(stored.select("day", "hour", "cost_usd")) == _rows(S.hourly_cost(early, t.list_prices))
