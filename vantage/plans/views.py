"""Views V1-V5 (V4 = union of rules V4a-V4c)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vantage.functions.time import AsOf, calendar_seconds_between, floor_time, since_days, since_interval
from vantage.operators.percentiles import percentiles
from vantage.operators.tasks import spread
from vantage.operators.windows import rolling_mean, running_total
from vantage.plans.summary import ADMIN_GROUP, GROUP_CHANGE_ACTIONS, IP_DENIAL_ACTIONS, latest_jobs
from vantage.sources.telemetry import Telemetry

col = F.col

# Fixed values of the rules.
SERVICE_USER_PATTERN = "%System-User%"
DESTRUCTIVE_LIKE = "delete%"
DESTRUCTIVE_MIN_OPS = 10
IP_ACCESS_DENIED, HIGH_DESTRUCTIVE_OPS, ADMIN_GROUP_CHANGE = "IP_ACCESS_DENIED", "HIGH_DESTRUCTIVE_OPS", "ADMIN_GROUP_CHANGE"
BURST_DETAIL_SUFFIX = " delete operations in 1 hour"
ADMIN_DETAIL_SEPARATOR = ": "
NO_WORKLOAD = "N/A"
FAILED = "FAILED"
FINISHED = "FINISHED"


def hourly_cost(t: Telemetry, as_of=None, days: int = 7) -> DataFrame:
    """Priced (inner) cost per usage-start hour over the trailing ``days`` days.

    At most (days + 1) x 24 rows whatever the data size.
    """
    priced = t.priced_usage("inner").filter(since_days("usage_date", AsOf.of(as_of), days))
    return (priced.groupBy(floor_time(priced, "usage_start_time", "HOUR").alias("hour"))
            .agg(F.sum("cost").alias("cost_usd")))


def burn_rate(t: Telemetry, as_of=None, window_rows: int = 24) -> DataFrame:
    """V1: hourly cost, mean of the last 24 rows, running total within the day.

    The rolling mean has no partition key, so it runs in one task - over the
    bounded hourly roll-up, never over raw usage.
    """
    return (hourly_cost(t, as_of)
            .select("hour", "cost_usd",
                    F.round(rolling_mean("cost_usd", "hour", window_rows), 4).alias("rolling_24h_avg"),
                    running_total("cost_usd", F.to_date("hour"), "hour").alias("cumulative_daily_cost")))


def latest_run_groups(t: Telemetry, as_of=None, days: int = 7) -> DataFrame:
    """(run, state) groups of the trailing window, ranked per job by start (newest first).

    Grouping by state splits a multi-period run into a null-state and a final
    group; the newest group decides (kept as specified).
    """
    groups = (t.job_run_timeline
              .filter(since_interval("period_start_time", AsOf.of(as_of), days=days))
              .groupBy("workspace_id", "job_id", "run_id", "result_state")
              .agg(F.min("period_start_time").alias("run_start"),
                   F.max("period_end_time").alias("run_end")))
    w = Window.partitionBy("workspace_id", "job_id").orderBy(
        col("run_start").desc(), col("run_id").desc(), col("result_state").asc_nulls_first())
    return groups.withColumn("run_rank", F.row_number().over(w))


def failing_jobs(t: Telemetry, as_of=None) -> DataFrame:
    """V2: jobs whose newest (run, state) group in 7 days is FAILED."""
    latest = latest_run_groups(t, as_of).filter((col("run_rank") == 1) & (col("result_state") == FAILED))
    return (latest.join(latest_jobs(t), ["workspace_id", "job_id"], "left")
            .select("workspace_id", "job_id", col("name").alias("job_name"),
                    col("creator_user_name").alias("owner"), "result_state", "run_start", "run_end",
                    calendar_seconds_between("run_start", "run_end").alias("duration_seconds")))


def top_cost_drivers(t: Telemetry, as_of=None, limit: int = 50) -> DataFrame:
    """V3: 30-day cost per (user, product, SKU, workload), top ``limit`` by cost.

    Ties are broken on the group key so the cut is deterministic. There may be as many
    groups as priced rows, so these are dealt by the group key to all tasks of the session.
    """
    workload = F.coalesce(col("usage_metadata.job_name"), col("usage_metadata.notebook_path"), F.lit(NO_WORKLOAD))
    key = ("user_or_sp", "product", "sku_name", "workload_name")
    usage = t.priced_usage("left").filter(since_days("usage_date", AsOf.of(as_of), 30)).select(
        col("identity_metadata.run_as").alias("user_or_sp"), col("billing_origin_product").alias("product"), "sku_name",
        workload.alias("workload_name"), "usage_quantity", "cost")
    grouped = (spread(usage, *key).groupBy(*key)
               .agg(F.sum("usage_quantity").alias("total_dbus"),
                    F.sum("cost").alias("estimated_cost_usd")))
    return grouped.orderBy(*driver_order()).limit(limit)


def driver_order() -> list:
    """Cost descending, then the group key (deterministic top-k)."""
    return [col("estimated_cost_usd").desc_nulls_last(), col("user_or_sp").asc_nulls_last(),
            col("product").asc_nulls_last(), col("sku_name").asc_nulls_last(),
            col("workload_name").asc_nulls_last()]


def _recent_audit(t: Telemetry, as_of) -> DataFrame:
    return t.audit.filter(since_days("event_date", AsOf.of(as_of), 1))


def event_anomalies(t: Telemetry, as_of=None) -> DataFrame:
    """V4a and V4c in one scan: events that are anomalies by themselves, each with its rule's type and detail."""
    action, params = col("action_name"), col("request_params")
    denied = action.isin(*IP_DENIAL_ACTIONS)
    regrouped = action.isin(*GROUP_CHANGE_ACTIONS) & (params.targetGroupName == ADMIN_GROUP)
    return _recent_audit(t, as_of).filter(denied | regrouped).select(
        F.when(denied, IP_ACCESS_DENIED).otherwise(ADMIN_GROUP_CHANGE).alias("anomaly_type"), "event_time",
        "workspace_id", col("user_identity.email").alias("user_email"),
        F.when(denied, col("source_ip_address")).otherwise("").alias("source_ip_address"),
        F.when(denied, action).otherwise(F.concat(action, F.lit(ADMIN_DETAIL_SEPARATOR), params.targetUserName)).alias("detail"))


def ip_denials(t: Telemetry, as_of=None) -> DataFrame:
    """One row per IP access denial in the last day."""
    return event_anomalies(t, as_of).filter(col("anomaly_type") == IP_ACCESS_DENIED)


def admin_group_changes(t: Telemetry, as_of=None) -> DataFrame:
    """Additions to / removals from the admins group."""
    return event_anomalies(t, as_of).filter(col("anomaly_type") == ADMIN_GROUP_CHANGE)


def destructive_bursts(t: Telemetry, as_of=None, min_ops: int = DESTRUCTIVE_MIN_OPS) -> DataFrame:
    """More than ``min_ops`` delete actions by one user in one clock hour.

    Service users are excluded; a null e-mail fails NOT LIKE and is excluded too.
    """
    audit = (_recent_audit(t, as_of)
             .filter(col("action_name").like(DESTRUCTIVE_LIKE))
             .filter(~col("user_identity.email").like(SERVICE_USER_PATTERN)))
    return (audit.groupBy("workspace_id", col("user_identity.email").alias("user_email"),
                          floor_time(audit, "event_time", "HOUR").alias("_hour"))
            .agg(F.max("event_time").alias("event_time"), F.count("*").alias("_n"))
            .filter(col("_n") > min_ops)
            .select(F.lit(HIGH_DESTRUCTIVE_OPS).alias("anomaly_type"), "event_time", "workspace_id",
                    "user_email", F.lit("").alias("source_ip_address"),
                    F.concat(col("_n").cast("string"), F.lit(BURST_DETAIL_SUFFIX)).alias("detail")))


def security_anomalies(t: Telemetry, as_of=None, min_ops: int = DESTRUCTIVE_MIN_OPS) -> DataFrame:
    """V4: union of the three rules (one schema), two scans of the audit day."""
    return event_anomalies(t, as_of).unionByName(destructive_bursts(t, as_of, min_ops))


def anomaly_order() -> list:
    """Newest first, then every column (deterministic top-k)."""
    return [col("event_time").desc_nulls_last(), col("anomaly_type").asc(),
            col("workspace_id").asc_nulls_last(), col("user_email").asc_nulls_last(),
            col("detail").asc_nulls_last(), col("source_ip_address").asc_nulls_last()]


def query_performance(t: Telemetry, as_of=None) -> DataFrame:
    """V5: 7-day finished statements per (user, warehouse, statement type).

    Durations are ms / 1000. The mean is taken over whole milliseconds (exact
    sum) and p95 is the interpolated percentile of the milliseconds rounded to
    0.01 ms, so the figures do not depend on summation order. One pass over the
    statements gives all of them.
    """
    ms, key = col("total_duration_ms"), ["user_name", "warehouse_id", "statement_type"]
    done = (t.query_history.filter(since_interval("start_time", AsOf.of(as_of), days=7) & (col("execution_status") == FINISHED))
            .select(col("executed_by").alias("user_name"), col("compute.warehouse_id").alias("warehouse_id"),
                    "statement_type", "total_duration_ms", "rows_produced"))
    found = percentiles(done, key, "total_duration_ms", 0.95, 1000, exact="_p95", maxima={"_most": ms},
                        sums={"query_count": F.lit(1), "_ms": ms, "_timed": ms.isNotNull().cast("long"),
                              "total_rows_produced": col("rows_produced")})
    return found.select(
        *key, "query_count", (col("_ms") / col("_timed") / 1000.0).alias("avg_duration_seconds"),
        (F.round("_p95", 2) / 1000.0).alias("p95_duration_seconds"), (col("_most") / 1000.0).alias("max_duration_seconds"),
        "total_rows_produced")
