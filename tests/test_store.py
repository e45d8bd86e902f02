"""Round trip through saved tables, views, the log and parameterised queries."""

import pytest

from tests.conftest import AS_OF, money, telemetry
from vantage.functions.time import AsOf
from vantage.plans import panels
from vantage.plans.gold import Gold
from vantage.sinks import store


@pytest.fixture(scope="module")
def schema(spark):
    store.create_schema(spark, "vantage_test", "observability test schema")
    return "vantage_test"


def test_summary_tables_round_trip(spark, schema):
    t = telemetry(spark, usage=[dict(usage_quantity=money(4))], list_prices=[dict(pricing=((money(2),),))],
                  clusters=[dict()])
    tables = store.refresh_summaries(t, schema, AsOf(AS_OF))
    assert spark.table(tables["gold_cost_daily"]).first().estimated_cost_usd == money(8)
    gold = Gold.from_schema(t, schema, AsOf(AS_OF))
    assert "gold_cost_daily" in gold.saved
    assert panels.cost_by_product(t, AsOf(AS_OF), gold).first().cost == money(8)
    assert panels.cluster_count(t, AsOf(AS_OF), gold, status="IDLE").first().cnt == 1


def test_views_and_parameterised_query(spark, schema):
    t = telemetry(spark, usage=[dict(usage_quantity=money(4))], list_prices=[dict(pricing=((money(2),),))])
    names = store.register_views(t, AsOf(AS_OF))
    assert "v_top_cost_drivers" in names
    df = store.run_query(spark, "SELECT * FROM v_top_cost_drivers WHERE total_dbus >= :q", {"q": 1})
    assert df.count() == 1


def test_termination_log_takes_each_row_of_a_run_once(spark, schema):
    from vantage.plans import actions

    t = telemetry(spark, clusters=[dict(cluster_id="c-1", cluster_name="it's"), dict(cluster_id="c-2")])
    acted = actions.idle_cluster_actions(t, AsOf(AS_OF))
    table = f"{schema}.termination_log"
    for run, rows in (("a", acted.limit(1)), ("a", acted), ("a", acted), ("b", acted)):
        store.append_termination_log(actions.termination_log_rows(rows, AsOf(AS_OF), run), table)
    got = spark.table(table).collect()
    assert sorted((r.run_id, r.cluster_id, r.workspace_id, r.cluster_names[0]) for r in got) == [
        ("a", "c-1", "1", "it's"), ("a", "c-2", "1", "c1"), ("b", "c-1", "1", "it's"), ("b", "c-2", "1", "c1")]


def test_identifiers_are_checked(spark):
    with pytest.raises(ValueError):
        store.create_schema(spark, "x; DROP TABLE y")


def test_refresh_and_cleanup_jobs(spark, schema):
    """The list is written once, and only what was acted on is logged, also when the job is tried again."""
    from vantage import refresh

    t = telemetry(spark, usage=[dict(usage_quantity=money(4))], list_prices=[dict(pricing=((money(2),),))],
                  clusters=[dict(cluster_id="c-1", cluster_name="idle-one"), dict(cluster_id="c-2", cluster_name="spared")])
    tables = refresh.refresh(spark, t, "vantage_jobs", AsOf(AS_OF))
    assert set(tables) == set(store.TABLE_COMMENTS)
    todo = refresh.plan_cleanup(spark, t, "vantage_jobs", as_of=AsOf(AS_OF))
    assert sorted(r.cluster_name for r in todo.collect()) == ["idle-one", "spared"]
    for _ in range(2):
        refresh.log_cleanup(todo.filter("cluster_id = 'c-1'"), "vantage_jobs.termination_log", "run-1", AsOf(AS_OF))
    assert [r.cluster_names for r in spark.table("vantage_jobs.termination_log").collect()] == [["idle-one"]]


def test_zombies_come_from_the_state_aware_inventory(spark, schema):
    from pyspark.sql import types as T

    from tests.conftest import frame
    from vantage import refresh
    from vantage.sources import schemas as S

    t = telemetry(spark)
    with_state = T.StructType([*S.CLUSTERS.fields, T.StructField("state", T.StringType())])
    rows = [dict(cluster_id="c-1", state="RUNNING", cluster_name="z"), dict(cluster_id="c-2", state="TERMINATED")]
    t._frames["clusters"] = frame(spark, "clusters", rows, with_state)
    refresh.refresh(spark, t, "vantage_zombies", AsOf(AS_OF))
    todo = refresh.plan_cleanup(spark, t, "vantage_zombies", "ZOMBIE", AsOf(AS_OF))
    assert [r.cluster_name for r in todo.collect()] == ["z"]


@pytest.mark.parametrize("step", ["write", "before the switch", "after the switch"])
def test_a_refresh_that_dies_leaves_a_whole_table(spark, schema, step, monkeypatch):
    """Readers find the old rows until the switch and the new ones after it; the next refresh clears what is left."""
    from pyspark.sql import functions as F

    table = f"{schema}.keep_{step.replace(' ', '_')}"
    store.write_table(spark.range(3), table, "first")
    bad = spark.range(5)
    if step == "write":
        bad = bad.withColumn("x", F.assert_true(F.col("id") < 2))
    elif step == "before the switch":
        monkeypatch.setattr(store, "_current", lambda *a: 1 / 0)
    else:
        monkeypatch.setattr(store, "versions", lambda *a: 1 / 0)
    with pytest.raises(Exception):
        store.write_table(bad, table, "second")
    monkeypatch.undo()
    assert spark.table(table).count() == (5 if step == "after the switch" else 3)
    store.write_table(spark.range(4), table, "third")
    assert spark.table(table).count() == 4 and len(store.versions(spark, table)) == 2


def test_some_days_are_rebuilt(spark, schema):
    """Late usage of one day: that day changes, the others are carried over, and only it is priced."""
    from tests.conftest import d, ts
    from vantage.plans import summary

    price = [dict(pricing=((money(2),),))]
    day = lambda n, q: dict(usage_date=d(f"2024-01-{n}"), usage_end_time=ts(f"2024-01-{n} 11:00:00"), usage_quantity=money(q))
    before = telemetry(spark, usage=[day(28, 1), day(29, 2)], list_prices=price)
    table = f"{schema}_days.gold_cost_daily"
    store.create_schema(spark, f"{schema}_days")
    store.write_table(summary.cost_daily(before), table, partition_by=["date"])
    after = telemetry(spark, usage=[day(28, 50), day(29, 2), day(29, 3)], list_prices=price)
    store.refresh_cost_days(after, f"{schema}_days", "2024-01-29", "2024-01-31")
    assert sorted((str(r.date), r.total_dbus) for r in spark.table(table).collect()) == [
        ("2024-01-28", money(1)), ("2024-01-29", money(5))]


def test_a_running_reader_keeps_its_version(spark, schema):
    table = f"{schema}.being_read"
    store.write_table(spark.range(3), table)
    reader = spark.table(table).select("id")
    store.write_table(spark.range(9), table)
    assert reader.count() == 3 and spark.table(table).count() == 9


def test_a_foreign_table_is_not_replaced(spark, schema):
    spark.range(2).write.saveAsTable(f"{schema}.foreign_rows")
    with pytest.raises(ValueError):
        store.write_table(spark.range(1), f"{schema}.foreign_rows")
    assert spark.table(f"{schema}.foreign_rows").count() == 2


def test_views_are_there_for_a_second_session(spark, schema):
    t = telemetry(spark, usage=[dict(usage_quantity=money(4))], list_prices=[dict(pricing=((money(2),),))])
    stored = store.refresh_views(t, schema, AsOf(AS_OF))
    other = spark.newSession()
    assert other.table(stored["v_top_cost_drivers"]).first().estimated_cost_usd == money(8)
    assert set(stored) >= {"v_realtime_burn_rate", "v_security_anomalies"} and not any(
        x.name.startswith("v_") and x.isTemporary for x in other.catalog.listTables())


def test_rebalanced_dates_have_few_files(spark, schema, tmp_path):
    """Every task holds rows of every date: one file a date is written, and a date with most rows is split."""
    from vantage.sources.materialize import write_source

    rows = spark.range(0, 40_000, 1, 16).selectExpr("date_add(date'2024-01-01', CAST(id % 20 AS INT)) AS date", "id")
    version = store.write_table(rows, f"{schema}.by_date", partition_by=["date"])
    files = spark.table(version).inputFiles()
    assert 20 <= len(files) <= 40
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        hot = spark.range(0, 400_000, 1, 16).selectExpr(
            "CASE WHEN id % 10 = 0 THEN date'2024-01-01' ELSE date'2024-01-02' END AS day", "id", "uuid() AS u")
        write_source(hot, str(tmp_path / "hot"), "day")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "hot" / "day=2024-01-02").glob("*.parquet"))) > 3


def test_catalog_sources_and_command_line(spark, schema):
    """Production path: sources read from catalog tables, summaries refreshed by the CLI."""
    from vantage import refresh, registry
    from vantage.sources.schemas import SOURCES

    fixture = registry.telemetry(spark, "/root/testdata/sf0.001")
    store.create_schema(spark, "vantage_src")
    args = ["summaries", "--schema", "vantage_cli", "--as-of", AS_OF]
    for name in SOURCES:
        fixture.table(name).write.mode("overwrite").saveAsTable(f"vantage_src.{name}")
        args += ["--source", f"{name}=vantage_src.{name}"]
    assert refresh.main(args) == 0
    assert spark.table("vantage_cli.gold_cost_daily").count() == 5707
    assert refresh.main(["views", *args[1:]]) == 0
    assert spark.newSession().table("vantage_cli.v_top_cost_drivers").count() == 50
    assert refresh.main(["cleanup", *args[1:], "--status", "ZOMBIE"]) == 0
    log = ["--acted", "vantage_cli.pending_cluster_actions", "--log-table", "vantage_cli.termination_log", "--run-id", "1"]
    assert refresh.main(["log", *args[1:], *log]) == refresh.main(["log", *args[1:], *log]) == 0
    assert spark.table("vantage_cli.termination_log").count() == 2
    assert spark.table("vantage_cli.gold_pipeline_health").count() == 25


def test_parquet_sources_round_trip(spark):
    """Sources stored as parquet datasets (date-partitioned facts) give the same results."""
    import tempfile

    from vantage import registry
    from vantage.plans import summary, views
    from vantage.sources.materialize import materialize
    from vantage.sources.telemetry import Telemetry

    fixture = registry.telemetry(spark, "/root/testdata/sf0.001")
    root = tempfile.mkdtemp(prefix="vantage-src-")
    stored = materialize(fixture, root, ["usage", "list_prices", "query_history"])
    reread = Telemetry.from_parquet(spark, root)
    a = AsOf(AS_OF)
    for t in (stored, reread):
        assert sorted(summary.cost_daily(t, a).collect()) == sorted(summary.cost_daily(fixture, a).collect())
        assert sorted(views.query_performance(t, a).collect()) == sorted(views.query_performance(fixture, a).collect())


def test_deployment_listing(spark, schema):
    """Schemas, tables and views (catalog metadata)."""
    from vantage.plans.checks import deployment_listing

    version = store.write_table(spark.range(1), f"{schema}.listed")
    found = {tuple(r) for r in deployment_listing(spark, schema).collect()}
    assert {("schema", schema, schema), ("view", schema, "listed"), ("table", schema, version.split(".")[1])} <= found
    assert ("view", schema, "listed") in {tuple(r) for r in deployment_listing(spark).collect()}
