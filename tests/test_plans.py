"""Plan shape: what must hold for the queries to scale (hot keys, broadcast bound)."""

import re

import pytest

from tests.conftest import AS_OF, money, telemetry
from vantage.functions.time import AsOf
from vantage.plans import alerts, summary, views

A = AsOf(AS_OF)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def t(spark):
    return telemetry(spark, usage=[dict(usage_quantity=money(1))], list_prices=[dict(pricing=((money(1),),))],
                     audit=[dict()], job_run_timeline=[dict()], query_history=[dict()], jobs=[dict()])


@pytest.mark.parametrize("build", [summary.cost_daily, summary.job_health, summary.governance_posture,
                                   summary.user_activity, views.top_cost_drivers, views.query_performance,
                                   views.destructive_bursts, alerts.cost_spike])
def test_partial_aggregation_before_first_shuffle(t, build):
    plan = _plan(build(t, A))
    # the operator feeding the first exchange on each fact branch is a partial aggregate
    for m in re.finditer(r"Exchange hashpartitioning[^\n]*\n\s*\+- (\w+)\(keys=[^\n]*functions=\[([^\]]*)", plan):
        assert m.group(1).endswith("Aggregate")
    assert "partial_" in plan


def _jobs(spark) -> int:
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))


def test_planning_runs_no_job(spark, t):
    from vantage import registry

    registry._load()
    before = _jobs(spark)
    for name, q in registry.REGISTRY.items():
        if not name.startswith("n2"):
            q.plan(t, A)
    assert _jobs(spark) == before


def test_price_join_is_one_join_for_every_size(spark):
    """A price list beyond the broadcast threshold: the same join, shuffled on the SKU, over one scan of usage."""
    import tempfile

    from vantage.operators.pricing import price_usage

    root = tempfile.mkdtemp(prefix="vantage-prices-")
    prices = spark.range(60_000).selectExpr(
        "concat('SKU_', id % 20000) AS sku_name",
        "timestamp_seconds(1700000000 + (id div 20000) * 100) AS price_start_time",
        "timestamp_seconds(1700000100 + (id div 20000) * 100) AS price_end_time",
        "named_struct('effective_list', named_struct('default', CAST(id AS DECIMAL(18,2)))) AS pricing")
    usage = spark.range(40_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'SKU_7' ELSE concat('SKU_', id % 25000) END AS sku_name",
        "timestamp_seconds(1700000000 + id % 300) AS usage_end_time", "CAST(1 AS DECIMAL(18,2)) AS usage_quantity")
    prices.write.parquet(f"{root}/prices")
    usage.write.parquet(f"{root}/usage")
    priced = price_usage(spark.read.parquet(f"{root}/usage"), spark.read.parquet(f"{root}/prices"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for threshold in ("10MB", "1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            plan = _plan(priced.select("*"))
            assert plan.count("sku_name") and plan.count("FileScan") == 2
            assert ("SortMergeJoin" in plan) == (threshold == "1")
        assert priced.select("*").count() == 40_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_run_state_and_percentiles_by_hash_aggregates(t):
    raw = _plan(summary.run_summaries(t, A))
    assert "SortAggregate" not in raw and "SortAggregate" not in _plan(summary.job_health(t, A))
    for build in (views.query_performance, summary.run_duration_percentiles):
        assert "percentile(" not in _plan(build(t, A))


def test_two_scans_of_the_audit_day(spark):
    from vantage import registry

    fixture = registry.telemetry(spark, "/root/testdata/sf0.001")
    assert _plan(views.security_anomalies(fixture, A)).count("FileScan") == 2


def test_no_cross_join_anywhere(t):
    from vantage import registry

    registry._load()
    for name, q in registry.REGISTRY.items():
        if name.startswith("n2"):
            continue
        plan = _plan(q.plan(t, A))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_percentiles_read_the_source_once(spark):
    """One scan (A12's source is a join of two tables), and every exchange is on a chain to it."""
    from vantage import registry

    fixture = registry.telemetry(spark, "/root/testdata/sf0.001")
    for build, scans, exchanges in ((views.query_performance, 1, 3), (summary.run_duration_percentiles, 2, 7)):
        plan = _plan(build(fixture, A))
        assert plan.count("FileScan") == scans and plan.count("Exchange") <= exchanges and "Expand" not in plan, plan


def test_monthly_counts_without_expand(spark):
    from vantage import registry
    from vantage.plans import reports

    plan = _plan(reports.monthly_governance(registry.telemetry(spark, "/root/testdata/sf0.001"), A))
    assert "Expand" not in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_saved_tables_are_read_without_a_job(spark):
    """Once the summaries are saved, planning picks their snapshot from the catalog; the plan scans version files."""
    from vantage import registry

    t = registry.telemetry(spark, "/root/testdata/sf0.001")
    registry._load()
    query = registry.REGISTRY["s10_saved_cost_by_product"]
    registry.prepare(query, t, A)
    before = _jobs(spark)
    plan = _plan(query.plan(t, A))
    assert _jobs(spark) == before
    assert plan.count("FileScan") == 1 and "gold_cost_daily__v" in plan and "lineitem" not in plan
    assert "PartitionFilters: [isnotnull(date" in plan


def test_prices_are_not_multiplied(spark):
    """What Spark compares with its broadcast threshold is the price list itself."""
    from vantage import registry

    plan = registry.telemetry(spark, "/root/testdata/sf0.001").priced_usage()._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "explode" not in plan


def test_a_hot_sku_is_split(spark):
    """Both sides beyond the broadcast threshold and one SKU with half of all usage: AQE splits that SKU's partition, and
    prices equal the rule's."""
    import tempfile

    from vantage.operators.pricing import price_usage

    root = tempfile.mkdtemp(prefix="vantage-hot-")
    prices = spark.range(3_000).selectExpr(
        "concat('SKU_', id % 1000) AS sku_name", "timestamp_seconds(1700000000 + (id div 1000) * 100) AS price_start_time",
        "IF(id >= 2000, NULL, timestamp_seconds(1700000100 + (id div 1000) * 100)) AS price_end_time",
        "named_struct('effective_list', named_struct('default', CAST(id AS DECIMAL(18,2)))) AS pricing")
    usage = spark.range(0, 200_000, 1, 16).selectExpr(
        "id", "CASE WHEN id % 2 = 0 THEN 'SKU_7' ELSE concat('SKU_', id % 1200) END AS sku_name",
        "timestamp_seconds(1700000000 + id % 400) AS usage_end_time", "CAST(1 AS DECIMAL(18,2)) AS usage_quantity")
    prices.write.parquet(f"{root}/prices")
    usage.write.parquet(f"{root}/usage")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        priced = price_usage(spark.read.parquet(f"{root}/usage"), spark.read.parquet(f"{root}/prices"))
        rows = priced.select("id", "sku_name", "usage_end_time", "list_price").collect()
        done = priced.select("id", "list_price")
        done.collect()
        plan = _plan(done)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in plan
    assert len(rows) == 200_000
    for r in rows[::97]:
        sku, second = int(r.sku_name[4:]), r.id % 400
        want = None if sku >= 1000 else sku + 1000 * min(second // 100, 2)
        assert (None if r.list_price is None else int(r.list_price)) == want


def test_checks_are_answered_from_footers(spark, tmp_path):
    """Over stored sources C1, C2 and C4 read no rows: counts are pushed into the scan, and other days' files are pruned."""
    from vantage import registry
    from vantage.plans import checks
    from vantage.sources.materialize import materialize
    from vantage.sources.telemetry import Telemetry

    fixture = registry.telemetry(spark, "/root/testdata/sf0.001")
    stored = materialize(fixture, str(tmp_path), ["usage", "audit", "jobs", "clusters"])
    setting = spark.conf.get("spark.sql.sources.useV1SourceList")
    for t in (stored, Telemetry.from_parquet(spark, str(tmp_path))):
        for check, group in ((checks.billing_freshness, "usage_date"), (checks.audit_freshness, "event_date"), (checks.job_records, "")):
            plan = _plan(check(t, A))
            assert "PushedAggregation: [COUNT(*)]" in plan and f"PushedGroupBy: [{group}]" in plan, plan
            assert check(t, A).collect() == check(fixture, A).collect()
        assert checks.cluster_records(t, A).collect() == checks.cluster_records(fixture, A).collect()
        assert "PartitionFilters: [isnotnull(usage_date" in _plan(checks.billing_freshness(t, A))
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == setting and "parquet" in setting
    empty = checks.billing_freshness(stored, AsOf("2030-01-01")).first()
    assert tuple(empty) == (None, 0)
