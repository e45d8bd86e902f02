"""M1: idle-compute action list and the log of clusters really acted on.

The remote clean-up call itself is outside Spark. A run writes its list once
(``refresh.plan_cleanup``), the caller acts on it and hands back what it acted
on, and that is logged (``refresh.log_cleanup``), once per run and cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.functions.time import AsOf
from vantage.plans.gold import Gold
from vantage.sources.telemetry import Telemetry

col = F.col


def idle_cluster_actions(t: Telemetry, as_of=None, gold: Gold | None = None, status: str = "IDLE") -> DataFrame:
    """Clusters to act on: workspace, id, name, owner. ``ZOMBIE`` asks the state-aware inventory."""
    inv = (gold or Gold(t, as_of)).inventory(status)
    return inv.filter(col("health_status") == status).select("workspace_id", "cluster_id", "cluster_name", "owner")


def termination_log_rows(acted: DataFrame, as_of=None, run_id: str = "") -> DataFrame:
    """One log row per cluster acted on, whatever the number of clusters of a workspace:
    ``(termination_time, cluster_names, workspace_id, cluster_id, run_id)``."""
    return acted.select(AsOf.of(as_of).ts().alias("termination_time"), F.array("cluster_name").alias("cluster_names"),
                        "workspace_id", "cluster_id", F.lit(run_id).alias("run_id"))
