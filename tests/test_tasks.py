"""How many tasks the rows of large aggregations and of refreshes are dealt to."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import AS_OF, d, money, telemetry
from vantage.functions.time import AsOf
from vantage.plans import panels, summary, views
from vantage.sinks import store
from vantage.sources import fixtures

A = AsOf(AS_OF)
SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


@pytest.fixture(scope="module")
def t(spark):
    """A group for each usage row, small enough for adaptive execution to put all into one task."""
    return telemetry(spark, list_prices=[dict(sku_name=f"SKU_{i}", pricing=((money(2),),)) for i in range(0, 400, 2)],
                     usage=[dict(sku_name=f"SKU_{i}", usage_quantity=money(i), usage_date=d("2024-01-30"),
                                 identity_metadata=(f"u{i % 7}@x.com" if i % 5 else None,)) for i in range(400)])


def test_daily_cost_has_all_tasks_of_the_session(spark, t):
    cost = summary.cost_daily(t, A)
    rows = cost.withColumn("task", F.spark_partition_id()).collect()
    assert len({r.task for r in rows}) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(rows) == 400 and {r.sku_name: (r.estimated_cost_usd, r.unique_users) for r in rows} == {
        f"SKU_{i}": (None if i % 2 else money(2 * i), int(i % 5 > 0)) for i in range(400)}


@pytest.mark.parametrize("build", [views.top_cost_drivers, panels.first_cost_drivers])
def test_cost_drivers_have_all_tasks_of_the_session(spark, t, build):
    top = build(t, A)
    rows = top.collect()
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert f", {spark.conf.get('spark.sql.shuffle.partitions')}), REPARTITION_BY_NUM" in plan
    n = 50 if build is views.top_cost_drivers else 20
    assert [(r.sku_name, r.estimated_cost_usd) for r in rows] == [(f"SKU_{398 - 2 * i}", money(796 - 4 * i)) for i in range(n)]


def test_a_refresh_has_small_tasks(spark, monkeypatch):
    """What a refresh shuffles is dealt to tasks of store.TASK_MB; the session's own setting holds before and after."""
    spark.sql("CREATE SCHEMA IF NOT EXISTS vantage_small_tasks")
    wide = spark.range(60_000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("x"),
                                      F.lit("2024-01-30").cast("date").alias("date"))
    monkeypatch.setattr(store, "TASK_MB", 1)
    store.write_table(wide, "vantage_small_tasks.wide", partition_by=["date"])
    assert len(spark.table("vantage_small_tasks.wide").inputFiles()) > 1  # 4 MB; by Spark's default one task writes a date
    assert spark.table("vantage_small_tasks.wide").select("k").distinct().count() == 60_000
    assert spark.conf.get(SIZE, None) is None
    spark.conf.set(SIZE, "32m")
    try:
        with store.small_tasks(spark):
            assert spark.conf.get(SIZE) == "32m"
        assert spark.conf.get(SIZE) == "32m"
    finally:
        spark.conf.unset(SIZE)


def test_versions_of_one_file_are_read_by_several_tasks(spark):
    raw = fixtures.raw_reader(spark, "/root/testdata/sf0.001")
    held = fixtures.jobs(raw)
    assert held.rdd.getNumPartitions() == len(fixtures.VERSION_KEYS)
    per_job = held.groupBy("job_id").agg(F.countDistinct("change_time").alias("n"), F.count("*").alias("all"))
    assert per_job.where("n <> 5 OR all <> 5").count() == 0 and per_job.count() > 0
