"""Gold frames for the panels: computed from sources, or read from saved tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from vantage.functions.time import AsOf
from vantage.plans import summary, views
from vantage.sources.telemetry import Telemetry

BUILDERS: dict[str, Callable[[Telemetry, AsOf], DataFrame]] = {
    "gold_cost_daily": summary.cost_daily,
    "gold_job_health": summary.job_health,
    "gold_compute_inventory": summary.compute_inventory,
    "gold_compute_inventory_stateful": summary.compute_inventory_stateful,
    "gold_user_activity": summary.user_activity,
    "gold_governance_posture": summary.governance_posture,
    "gold_pipeline_health": summary.pipeline_health,
    "v_realtime_burn_rate": views.burn_rate,
    "v_currently_failing_jobs": views.failing_jobs,
    "v_top_cost_drivers": views.top_cost_drivers,
    "v_security_anomalies": views.security_anomalies,
    "v_query_performance": views.query_performance,
}


class Gold:
    """Named gold tables and views.

    With ``saved`` (name -> DataFrame, e.g. ``spark.table``) a panel reads the
    materialised table; otherwise the frame is planned from the sources.
    """

    def __init__(self, t: Telemetry, as_of=None, saved: Mapping[str, DataFrame] | None = None):
        self.t = t
        self.as_of = AsOf.of(as_of)
        self.saved = dict(saved or {})

    def __getitem__(self, name: str) -> DataFrame:
        if name in self.saved:
            return self.saved[name]
        return BUILDERS[name](self.t, self.as_of)

    def inventory(self, status: str) -> DataFrame:
        """The inventory whose health rule knows ``status``."""
        stateful = status in (summary.ZOMBIE, summary.TERMINATED)
        return self["gold_compute_inventory_stateful" if stateful else "gold_compute_inventory"]

    @classmethod
    def from_schema(cls, t: Telemetry, schema: str, as_of=None) -> "Gold":
        """What ``schema`` holds now, each table for itself."""
        spark = t.spark
        listing = spark.sql(f"SHOW TABLES IN {schema}").filter("NOT isTemporary")
        have = {r.tableName for r in listing.collect()}  # catalog metadata: a handful of names
        return cls(t, as_of, {n: spark.table(f"{schema}.{n}") for n in BUILDERS if n in have})

    @classmethod
    def from_snapshot(cls, t: Telemetry, schema: str, as_of=None) -> "Gold":
        """The states of ``schema``'s tables that were published together. The choice is made here, once for all
        panels of a dashboard, so they fit each other whatever is refreshed while they are read."""
        from vantage.sinks.store import snapshot

        held = {table.rpartition(".")[2]: target for table, target in snapshot(t.spark, schema).items()}
        return cls(t, as_of, {n: t.spark.table(held[n]) for n in BUILDERS if n in held})
