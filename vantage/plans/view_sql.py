"""V1-V5 as SQL text over named source tables, for catalog views that are computed when read.

A catalog view holds text, not a plan, so the views have a second form here: Spark's pipe syntax, where "now" is
``current_date()`` / ``current_timestamp()`` of whoever reads. Tests compare every text with the view's plan in ``views``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import types as T

from vantage.functions.time import AsOf
from vantage.plans import summary as S
from vantage.plans import views as V
from vantage.sources.telemetry import Telemetry

VIEW_COMMENTS = {
    "v_realtime_burn_rate": "Cost by hour over 7 days, with its mean over 24 rows and its total within the day",
    "v_currently_failing_jobs": "Jobs whose newest group of periods failed",
    "v_top_cost_drivers": "The 50 costliest combinations of user, product, SKU and workload in 30 days",
    "v_security_anomalies": "Denied addresses, bursts of deletions and changes of the administrators' group, last day",
    "v_query_performance": "Durations of finished statements by user, warehouse and type in 7 days",
}


def _listed(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _hour(t: Telemetry, source: str, column: str) -> str:
    """The hour of a time column, of the column's own kind of timestamp."""
    ntz = isinstance(t.table(source).schema[column].dataType, T.TimestampNTZType)
    return f"CAST(date_trunc('HOUR', {column}) AS TIMESTAMP_NTZ)" if ntz else f"date_trunc('HOUR', {column})"


def _priced(sources: Mapping[str, str], kind: str, since: str) -> str:
    """Usage since a day with the price of its end time; as ``operators.pricing`` does it."""
    return f"""FROM {sources['usage']} AS u
|> WHERE usage_date >= {since}
|> {kind} JOIN {sources['list_prices']} AS p
   ON p.sku_name = u.sku_name AND p.price_start_time <= u.usage_end_time
      AND (p.price_end_time > u.usage_end_time OR p.price_end_time IS NULL)
|> EXTEND u.usage_quantity * p.pricing.effective_list.default AS cost"""


def view_texts(t: Telemetry, sources: Mapping[str, str], as_of: AsOf) -> dict[str, str]:
    """View name -> SQL text. ``sources`` gives the catalog table of each source that ``t`` reads."""
    job = "workspace_id, job_id"
    latest_job = f"""(FROM {sources['jobs']}
   |> AGGREGATE max_by(struct(name, creator_user_name), struct(change_time, name, creator_user_name)) AS job GROUP BY {job})"""
    day_of_audit = f"FROM {sources['audit']} |> WHERE event_date >= {as_of.sql_days_ago(1)}"
    groups = f"action_name IN ({_listed(S.GROUP_CHANGE_ACTIONS)}) AND request_params['targetGroupName'] = '{S.ADMIN_GROUP}'"
    denied = f"action_name IN ({_listed(S.IP_DENIAL_ACTIONS)})"
    return {
        "v_realtime_burn_rate": f"""{_priced(sources, 'INNER', as_of.sql_days_ago(7))}
|> AGGREGATE sum(cost) AS cost_usd GROUP BY {_hour(t, 'usage', 'usage_start_time')} AS hour
|> SELECT hour, cost_usd, round(avg(cost_usd) OVER (ORDER BY hour ROWS BETWEEN 23 PRECEDING AND CURRENT ROW), 4) AS rolling_24h_avg,
   sum(cost_usd) OVER (PARTITION BY to_date(hour) ORDER BY hour) AS cumulative_daily_cost""",
        "v_currently_failing_jobs": f"""FROM {sources['job_run_timeline']}
|> WHERE period_start_time >= {as_of.sql_minus(days=7)}
|> AGGREGATE min(period_start_time) AS run_start, max(period_end_time) AS run_end GROUP BY {job}, run_id, result_state
|> EXTEND row_number() OVER (PARTITION BY {job} ORDER BY run_start DESC, run_id DESC, result_state NULLS FIRST) AS newest
|> WHERE newest = 1 AND result_state = '{V.FAILED}'
|> LEFT JOIN {latest_job} AS known USING ({job})
|> SELECT {job}, job.name AS job_name, job.creator_user_name AS owner, result_state, run_start, run_end,
   timestampdiff(SECOND, run_start, run_end) AS duration_seconds""",
        "v_top_cost_drivers": f"""{_priced(sources, 'LEFT', as_of.sql_days_ago(30))}
|> AGGREGATE sum(u.usage_quantity) AS total_dbus, sum(cost) AS estimated_cost_usd
   GROUP BY u.identity_metadata.run_as AS user_or_sp, u.billing_origin_product AS product, u.sku_name AS sku_name,
            coalesce(u.usage_metadata.job_name, u.usage_metadata.notebook_path, '{V.NO_WORKLOAD}') AS workload_name
|> ORDER BY estimated_cost_usd DESC NULLS LAST, user_or_sp NULLS LAST, product NULLS LAST, sku_name NULLS LAST, workload_name NULLS LAST
|> LIMIT 50""",
        "v_security_anomalies": f"""{day_of_audit}
|> WHERE {denied} OR ({groups})
|> SELECT if({denied}, '{V.IP_ACCESS_DENIED}', '{V.ADMIN_GROUP_CHANGE}') AS anomaly_type, event_time, workspace_id,
   user_identity.email AS user_email, if({denied}, source_ip_address, '') AS source_ip_address,
   if({denied}, action_name, concat(action_name, '{V.ADMIN_DETAIL_SEPARATOR}', request_params['targetUserName'])) AS detail
|> UNION ALL ({day_of_audit}
   |> WHERE action_name LIKE '{V.DESTRUCTIVE_LIKE}' AND user_identity.email NOT LIKE '{V.SERVICE_USER_PATTERN}'
   |> AGGREGATE max(event_time) AS event_time, count(*) AS n
      GROUP BY workspace_id, user_identity.email AS user_email, date_trunc('HOUR', event_time) AS hour
   |> WHERE n > {V.DESTRUCTIVE_MIN_OPS}
   |> SELECT '{V.HIGH_DESTRUCTIVE_OPS}' AS anomaly_type, event_time, workspace_id, user_email, '' AS source_ip_address,
      concat(n, '{V.BURST_DETAIL_SUFFIX}') AS detail)""",
        "v_query_performance": f"""FROM {sources['query_history']}
|> WHERE start_time >= {as_of.sql_minus(days=7)} AND execution_status = '{V.FINISHED}'
|> AGGREGATE count(*) AS query_count, avg(total_duration_ms) / 1000.0D AS avg_duration_seconds,
   round(percentile(total_duration_ms, 0.95), 2) / 1000.0D AS p95_duration_seconds,
   max(total_duration_ms) / 1000.0D AS max_duration_seconds, sum(rows_produced) AS total_rows_produced
   GROUP BY executed_by AS user_name, compute.warehouse_id AS warehouse_id, statement_type""",
    }
