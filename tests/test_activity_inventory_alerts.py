"""User activity fan-out, inventory fallbacks, alerts, reports, burn rate properties."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import AS_OF, d, frame, money, telemetry, ts
from vantage.functions.time import AsOf
from vantage.plans import alerts, reports, summary, views
from vantage.sources.telemetry import Telemetry

A = AsOf(AS_OF)
PRICE = [dict(pricing=((money(1),),))]


def test_user_in_two_workspaces_repeats_cost(spark):
    logins = [dict(event_id=i, workspace_id=w, action_name="mintOAuthToken", user_identity=("u@x.com",))
              for i, w in enumerate(["1", "2"])]
    t = telemetry(spark, audit=logins, usage=[dict(usage_quantity=money(5))], list_prices=PRICE)
    rows = summary.user_activity(t, A).collect()
    assert sorted(r.workspace_id for r in rows) == ["1", "2"]
    assert all(r.estimated_cost_30d == money(5) for r in rows)


def test_cost_only_user_appears_with_null_logins(spark):
    t = telemetry(spark, usage=[dict(usage_quantity=money(5), identity_metadata=("solo@x.com",))], list_prices=PRICE)
    (row,) = summary.user_activity(t, A).collect()
    assert row.user_email == "solo@x.com" and row.workspace_id is None and row.login_count_30d is None


def test_inventory_missing_columns_fall_back(spark):
    schema = T.StructType([f for f in frame(spark, "clusters", []).schema.fields if f.name != "owned_by"])
    clusters = frame(spark, "clusters", [dict(cluster_id="c-1"), dict(cluster_id="c-2")], schema=schema)
    usage = frame(spark, "usage", [dict(usage_quantity=money(3), usage_metadata=("c-1", None, None))])
    t = Telemetry.from_frames(spark, {"clusters": clusters, "usage": usage})
    got = {r.cluster_id: r for r in summary.compute_inventory(t, A).collect()}
    assert got["c-1"].owner == "Unknown" and got["c-1"].health_status == "ACTIVE"
    assert got["c-2"].health_status == "IDLE" and got["c-2"].dbus_last_7d == 0


def test_inventory_matches_usage_on_cluster_id_only(spark):
    t = telemetry(spark, clusters=[dict(cluster_id="c-1", workspace_id="9")],
                  usage=[dict(usage_quantity=money(2), workspace_id="1", usage_metadata=("c-1", None, None))])
    assert summary.compute_inventory(t, A).first().health_status == "ACTIVE"


def test_stateful_inventory_states(spark):
    schema = frame(spark, "clusters", []).schema.add("state", "string")
    rows = [dict(cluster_id="c-1", state="RUNNING"), dict(cluster_id="c-2", state="RUNNING"),
            dict(cluster_id="c-3", state="TERMINATED")]
    clusters = spark.createDataFrame(
        [("1", r["cluster_id"], "n", "o", "UI", ts("2024-01-01 00:00:00"), r["state"]) for r in rows], schema)
    usage = frame(spark, "usage", [dict(usage_quantity=money(2), usage_metadata=("c-2", None, None))])
    t = Telemetry.from_frames(spark, {"clusters": clusters, "usage": usage})
    got = {r.cluster_id: r.health_status for r in summary.compute_inventory_stateful(t, A).collect()}
    assert got == {"c-1": "ZOMBIE", "c-2": "ACTIVE", "c-3": "TERMINATED"}
    assert alerts.idle_compute(t, A, flag="IDLE").count() == 2  # usage-based: c-1 and c-3


def _daily(spark, costs_by_day: dict[str, int]):
    usage = [dict(usage_date=d(day), usage_end_time=ts(f"{day} 01:00:00"), usage_quantity=money(q))
             for day, q in costs_by_day.items()]
    return telemetry(spark, usage=usage, list_prices=PRICE)


def test_cost_spike_fires_once(spark):
    days = {(dt.date(2024, 1, 31) - dt.timedelta(days=i)).isoformat(): 100 + (i % 2) for i in range(1, 15)}
    days["2024-01-31"] = 500
    (row,) = alerts.cost_spike(_daily(spark, days), A).collect()
    assert row.daily_cost == 500 and round(row.cost_ratio, 3) == round(500 / 100.5, 3)


def test_cost_spike_zero_mean_does_not_raise(spark):
    days = {(dt.date(2024, 1, 31) - dt.timedelta(days=i)).isoformat(): 0 for i in range(1, 15)}
    days["2024-01-31"] = 5
    rows = alerts.cost_spike(_daily(spark, days), A, k=0.0).collect()
    assert len(rows) == 1 and rows[0].cost_ratio is None


def test_failure_spike_threshold(spark):
    rows = [dict(run_id=i, result_state="FAILED", period_start_time=ts("2024-01-30 23:30:00")) for i in range(6)]
    assert alerts.job_failure_spike(telemetry(spark, job_run_timeline=rows), A).first().failures_last_hour == 6
    assert alerts.job_failure_spike(telemetry(spark, job_run_timeline=rows[:5]), A).count() == 0


def test_week_over_week_spans(spark):
    usage = [dict(usage_date=d("2024-01-17"), usage_quantity=money(10)),  # day -14: previous span
             dict(usage_date=d("2024-01-23"), usage_quantity=money(5)),   # day -8: previous span
             dict(usage_date=d("2024-01-24"), usage_quantity=money(30)),  # day -7: current span
             dict(usage_date=d("2024-01-31"), usage_quantity=money(0))]
    (row,) = reports.week_over_week(telemetry(spark, usage=usage), A).collect()
    assert (row.prev_week_dbus, row.this_week_dbus, row.growth_pct) == (money(15), money(30), 100.0)


def test_burn_rate_running_total_ends_at_day_sum(spark):
    usage = [dict(usage_date=d("2024-01-30"), usage_start_time=ts(f"2024-01-30 {h:02d}:00:00"),
                  usage_end_time=ts(f"2024-01-30 {h:02d}:30:00"), usage_quantity=money(h + 1)) for h in range(24)]
    usage += [dict(usage_date=d("2024-01-31"), usage_start_time=ts("2024-01-31 00:00:00"),
                   usage_end_time=ts("2024-01-31 00:30:00"), usage_quantity=money(7))]
    t = telemetry(spark, usage=usage, list_prices=PRICE)
    rows = views.burn_rate(t, A).orderBy("hour").collect()
    assert rows[23].cumulative_daily_cost == sum(range(1, 25))
    assert rows[24].cumulative_daily_cost == 7  # restarts each day
    assert float(rows[24].rolling_24h_avg) == round(sum(range(2, 25), 7) / 24, 4)


def test_empty_inputs_every_query_runs(spark):
    from vantage import registry

    registry._load()
    t = telemetry(spark)
    conv = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    t = Telemetry.from_frames(spark, {**{n: t.table(n) for n in t.available()}, "conversations": conv})
    for name, q in registry.REGISTRY.items():
        rows = q.plan(t, A).collect()
        assert len(rows) <= 1, name  # global aggregates give one row; everything else none
    assert F is not None


@pytest.mark.parametrize("lost", ["cluster_name", "owned_by", "cluster_source", "change_time", "all"])
@pytest.mark.parametrize("build", [summary.compute_inventory, summary.compute_inventory_stateful])
def test_any_optional_column_may_be_missing(spark, lost, build):
    optional = {"cluster_name", "owned_by", "cluster_source", "change_time"}
    t = telemetry(spark, clusters=[dict(cluster_id="c-1"), dict(cluster_id="c-1"), dict(cluster_id="c-2")])
    t._frames["clusters"] = t.clusters.drop(*(optional if lost == "all" else {lost}))
    rows = build(t, AsOf(AS_OF)).collect()
    assert sorted(r.cluster_id for r in rows) == ["c-1", "c-2"]


def test_as_of_with_an_offset_is_refused():
    with pytest.raises(ValueError, match="wall-clock"):
        AsOf("2024-01-31T00:00:00+05:00").sql_ts()
    assert AsOf("2024-01-31T00:00:00").sql_date() == "DATE '2024-01-31'"
