r"""Scheduled jobs: refresh the summary tables, create the views (live, or their rows stored), list idle compute, log what
was done.

    spark-submit vantage/refresh.py summaries --schema main.observability
    spark-submit vantage/refresh.py cost-days --schema main.observability --days 2024-01-29 2024-01-31
    spark-submit vantage/refresh.py views --schema main.observability
    spark-submit vantage/refresh.py stored-views --schema main.observability
    spark-submit vantage/refresh.py cleanup --schema main.observability --status ZOMBIE
    spark-submit vantage/refresh.py log --schema main.observability --acted main.observability.acted_on \
        --log-table main.observability.termination_log --run-id 2024-01-31

Source table names default to the platform's system tables; override with
``--source usage=my_catalog.billing.usage`` (repeatable).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from vantage.functions.time import AsOf
from vantage.plans import actions
from vantage.plans.gold import Gold
from vantage.sinks import store
from vantage.sources.telemetry import PLATFORM_TABLES, Telemetry

SCHEMA_COMMENT = "Platform observability: curated summary tables for dashboards"


def refresh(spark: SparkSession, t: Telemetry, schema: str, as_of=None) -> dict[str, str]:
    """Create the schema if needed and fully refresh the summary tables."""
    store.create_schema(spark, schema, SCHEMA_COMMENT)
    return store.refresh_summaries(t, schema, AsOf.of(as_of))


def plan_cleanup(spark: SparkSession, t: Telemetry, schema: str, status: str = "IDLE", as_of=None) -> DataFrame:
    """Write the run's list of clusters to act on to ``pending_cluster_actions`` and return the stored list. The remote
    call is the caller's; whatever it acted on goes to ``log_cleanup``."""
    a = AsOf.of(as_of)
    table = f"{schema}.pending_cluster_actions"
    store.write_table(actions.idle_cluster_actions(t, a, Gold.from_schema(t, schema, a), status), table)
    return spark.table(table)


def log_cleanup(acted: DataFrame, log_table: str, run_id: str, as_of=None) -> None:
    """Log the clusters acted on; a repeated call of the same run adds nothing."""
    store.append_termination_log(actions.termination_log_rows(acted, as_of, run_id), log_table)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="vantage.refresh")
    p.add_argument("job", choices=["summaries", "cost-days", "views", "stored-views", "cleanup", "log"])
    p.add_argument("--schema", required=True)
    p.add_argument("--as-of", default=None)
    p.add_argument("--source", action="append", default=[], help="name=table override")
    p.add_argument("--log-table", default=None)
    p.add_argument("--status", default="IDLE")
    p.add_argument("--acted", default=None, help="table of the clusters acted on")
    p.add_argument("--run-id", default=None)
    p.add_argument("--days", nargs=2, metavar=("FIRST", "LAST"), help="days to rebuild (cost-days)")
    args = p.parse_args(argv)
    from vantage.session import build_session

    spark = build_session()
    sources = {**PLATFORM_TABLES, **dict(s.split("=", 1) for s in args.source)}
    t = Telemetry.from_tables(spark, sources)
    if args.job == "summaries":
        for name, table in refresh(spark, t, args.schema, args.as_of).items():
            print(f"{name} -> {table}")
    elif args.job == "cost-days":
        if not args.days:
            p.error("cost-days needs --days")
        print(store.refresh_cost_days(t, args.schema, *args.days))
    elif args.job in ("views", "stored-views"):
        store.create_schema(spark, args.schema, SCHEMA_COMMENT)
        made = (store.create_live_views(t, args.schema, sources, args.as_of) if args.job == "views"
                else store.refresh_views(t, args.schema, args.as_of))
        for name, table in made.items():
            print(f"{name} -> {table}")
    elif args.job == "cleanup":
        store.create_schema(spark, args.schema, SCHEMA_COMMENT)
        plan_cleanup(spark, t, args.schema, args.status, args.as_of)
    else:
        if not (args.log_table and args.acted and args.run_id):
            p.error("log needs --acted, --log-table and --run-id")
        log_cleanup(spark.table(args.acted), args.log_table, args.run_id, args.as_of)
    return 0


if __name__ == "__main__":
    sys.exit(main())
