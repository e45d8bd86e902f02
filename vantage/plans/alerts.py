"""Threshold alerts L1-L4. L1-L3 return rows only when firing; L4 always one row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.functions.numeric import exact_mean
from vantage.functions.time import AsOf, since_days, since_interval
from vantage.plans.gold import Gold
from vantage.plans.summary import RUN_FAILED
from vantage.plans.views import DESTRUCTIVE_MIN_OPS, security_anomalies
from vantage.sources.telemetry import Telemetry

col = F.col


def daily_cost(t: Telemetry, as_of=None, days: int = 14) -> DataFrame:
    """Priced (inner) cost per usage date over the trailing ``days`` days (<= days+1 rows)."""
    return (t.priced_usage("inner").filter(since_days("usage_date", AsOf.of(as_of), days))
            .groupBy("usage_date").agg(F.sum("cost").alias("daily_cost")))


def cost_spike(t: Telemetry, as_of=None, k: float = 2.0, days: int = 14) -> DataFrame:
    """L1: today's cost above mean + k * sample stddev of the earlier days in the window.

    The statistics and today's value come out of one global aggregate over the
    (bounded) daily series, so no cross join is needed. A zero mean gives a
    null ratio instead of an error.
    """
    a = AsOf.of(as_of)
    today = col("usage_date") == a.date()
    earlier = col("usage_date") < a.date()
    earlier_cost = F.when(earlier, col("daily_cost"))
    stats = daily_cost(t, a, days).agg(
        F.max(F.when(today, col("daily_cost"))).alias("daily_cost"),
        exact_mean(earlier_cost).alias("avg_cost"),
        F.stddev(earlier_cost.cast("double")).alias("stddev_cost"))
    return (stats.filter(col("daily_cost") > col("avg_cost") + F.lit(k) * col("stddev_cost"))
            .select(col("daily_cost").cast("double").alias("daily_cost"), "avg_cost",
                    F.try_divide(col("daily_cost").cast("double"), col("avg_cost")).alias("cost_ratio")))


def idle_compute(t: Telemetry, as_of=None, flag: str = "IDLE") -> DataFrame:
    """L2: inventory rows flagged idle; ``ZOMBIE`` (running without usage) comes from the state-aware inventory."""
    return (Gold(t, as_of).inventory(flag).filter(col("health_status") == flag)
            .select("cluster_id", "cluster_name", "owner", "dbus_last_7d"))


def job_failure_spike(t: Telemetry, as_of=None, threshold: int = 5) -> DataFrame:
    """L3: more than ``threshold`` FAILED period rows started in the last hour."""
    return (t.job_run_timeline
            .filter((col("result_state") == RUN_FAILED) & since_interval("period_start_time", AsOf.of(as_of), hours=1))
            .agg(F.count("*").alias("failures_last_hour"))
            .filter(col("failures_last_hour") > threshold))


def security_alert(t: Telemetry, as_of=None, min_ops: int = DESTRUCTIVE_MIN_OPS) -> DataFrame:
    """L4: number of security anomalies (fires when > 0)."""
    return security_anomalies(t, as_of, min_ops).agg(F.count("*").alias("anomaly_count"))
