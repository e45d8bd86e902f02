"""Dashboard panel queries D1-D19 over the gold frames.

Every top-k orders by a unique key after the displayed sort column, so the
rows kept by the limit are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.functions.numeric import exact_mean
from vantage.functions.time import AsOf, since_days
from vantage.plans.gold import Gold
from vantage.plans.views import anomaly_order, driver_order
from vantage.sources.telemetry import Telemetry

col = F.col


def _gold(t: Telemetry, as_of, gold: Gold | None) -> Gold:
    return gold if gold is not None else Gold(t, as_of)


def today_cost(t: Telemetry, as_of=None, gold=None) -> DataFrame:
    """Priced (inner) cost of usage dated today."""
    a = AsOf.of(as_of)
    return (t.priced_usage("inner").filter(col("usage_date") == a.date())
            .agg(F.sum("cost").alias("cost")))


def month_to_date_cost(t: Telemetry, as_of=None, gold=None) -> DataFrame:
    """Priced (inner) cost since the first of the month."""
    a = AsOf.of(as_of)
    return (t.priced_usage("inner").filter(col("usage_date") >= a.month_start())
            .agg(F.sum("cost").alias("cost")))


def cluster_count(t: Telemetry, as_of=None, gold=None, status: str = "ACTIVE") -> DataFrame:
    """D3 (ACTIVE) / D4 (IDLE or ZOMBIE): distinct clusters with a health status."""
    inv = _gold(t, as_of, gold).inventory(status)
    return inv.filter(col("health_status") == status).agg(F.countDistinct("cluster_id").alias("cnt"))


def burn_series(t: Telemetry, as_of=None, gold=None) -> DataFrame:
    """The burn-rate series, oldest first."""
    return _gold(t, as_of, gold)["v_realtime_burn_rate"].select("hour", "cost_usd", "rolling_24h_avg").orderBy("hour")


def cost_by_product(t: Telemetry, as_of=None, gold=None) -> DataFrame:
    """30-day cost per product, highest first."""
    a = AsOf.of(as_of)
    return (_gold(t, a, gold)["gold_cost_daily"].filter(since_days("date", a, 30))
            .groupBy("product").agg(F.sum("estimated_cost_usd").alias("cost"))
            .orderBy(col("cost").desc_nulls_last(), col("product").asc_nulls_last()))


def first_cost_drivers(t: Telemetry, as_of=None, gold=None, limit: int = 20) -> DataFrame:
    """The first 20 rows of the top-cost-driver view."""
    return _gold(t, as_of, gold)["v_top_cost_drivers"].orderBy(*driver_order()).limit(limit)


def idle_clusters(t: Telemetry, as_of=None, gold=None, status: str = "IDLE") -> DataFrame:
    """The idle (or ZOMBIE) cluster list."""
    return (_gold(t, as_of, gold).inventory(status).filter(col("health_status") == status)
            .select("cluster_id", "cluster_name", "owner", "dbus_last_7d", "last_active_time"))


def job_totals(t: Telemetry, as_of=None, gold=None) -> DataFrame:
    """Job count, mean success rate and 30-day failures.

    The rates have two decimals, so the mean is taken as an exact decimal sum
    over the count.
    """
    jh = _gold(t, as_of, gold)["gold_job_health"]
    return jh.agg(F.count("*").alias("total_jobs"),
                  exact_mean(col("success_rate_pct").cast("decimal(10,2)")).alias("avg_success_rate"),
                  F.sum("failure_count").alias("total_failures_30d"))


def first_failing_jobs(t: Telemetry, as_of=None, gold=None, limit: int = 25) -> DataFrame:
    """The 25 most recent failing jobs."""
    return (_gold(t, as_of, gold)["v_currently_failing_jobs"]
            .orderBy(col("run_start").desc_nulls_last(), "workspace_id", "job_id").limit(limit))


def busiest_jobs(t: Telemetry, as_of=None, gold=None, limit: int = 30) -> DataFrame:
    """Top 30 jobs by run count."""
    return (_gold(t, as_of, gold)["gold_job_health"]
            .orderBy(col("total_runs_30d").desc(), "workspace_id", "job_id").limit(limit)
            .select("job_name", "success_rate_pct", "total_runs_30d", "failure_count"))


def pipeline_failures(t: Telemetry, as_of=None, gold=None) -> DataFrame:
    """Pipeline health, most failures first."""
    return (_gold(t, as_of, gold)["gold_pipeline_health"]
            .orderBy(col("failure_count").desc(), "workspace_id", "pipeline_id")
            .select("name", "total_updates_7d", "success_count", "failure_count", "success_rate_pct"))


def posture_totals(t: Telemetry, as_of=None, gold=None) -> DataFrame:
    """Posture indicators summed over workspaces."""
    gp = _gold(t, as_of, gold)["gold_governance_posture"]
    return gp.agg(F.sum("permission_changes_24h").alias("total_perm_changes"),
                  F.sum("ip_denials_24h").alias("total_ip_denials"),
                  F.sum("destructive_ops_24h").alias("total_destructive"),
                  F.sum("admin_group_changes_24h").alias("total_admin_changes"))


def anomaly_count(t: Telemetry, as_of=None, gold=None) -> DataFrame:
    """Number of security anomalies."""
    return _gold(t, as_of, gold)["v_security_anomalies"].agg(F.count("*").alias("cnt"))


def latest_anomalies(t: Telemetry, as_of=None, gold=None, limit: int = 50) -> DataFrame:
    """The 50 latest anomalies."""
    return _gold(t, as_of, gold)["v_security_anomalies"].orderBy(*anomaly_order()).limit(limit)


def posture_by_workspace(t: Telemetry, as_of=None, gold=None) -> DataFrame:
    """Posture indicators per workspace."""
    return _gold(t, as_of, gold)["gold_governance_posture"].select(
        "workspace_id", "permission_changes_24h", "ip_denials_24h", "destructive_ops_24h", "admin_group_changes_24h")


def user_totals(t: Telemetry, as_of=None, gold=None) -> DataFrame:
    """Distinct users, logins and cost (cost repeats per workspace row, as specified)."""
    ua = _gold(t, as_of, gold)["gold_user_activity"]
    return ua.agg(F.countDistinct("user_email").alias("total_users"),
                  F.sum("login_count_30d").alias("total_logins"),
                  F.sum("estimated_cost_30d").alias("total_user_cost"))


def user_order() -> list:
    return [col("estimated_cost_30d").desc_nulls_last(), col("user_email").asc_nulls_last(),
            col("workspace_id").asc_nulls_last()]


def top_users_by_cost(t: Telemetry, as_of=None, gold=None, limit: int = 20) -> DataFrame:
    """Top 20 users by 30-day cost (users with a cost)."""
    return (_gold(t, as_of, gold)["gold_user_activity"].filter(col("estimated_cost_30d").isNotNull())
            .orderBy(*user_order()).limit(limit)
            .select("user_email", "estimated_cost_30d", "login_count_30d", "active_days"))


def user_activity_list(t: Telemetry, as_of=None, gold=None, limit: int = 25) -> DataFrame:
    """25 users, cost descending with nulls last."""
    return (_gold(t, as_of, gold)["gold_user_activity"].orderBy(*user_order()).limit(limit)
            .select("user_email", "login_count_30d", "active_days", "last_login", "estimated_cost_30d"))
