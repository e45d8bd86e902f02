"""Period reports R1 (week over week) and R2 (monthly governance)."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.functions.time import AsOf, since_days
from vantage.sources.telemetry import Telemetry

col = F.col

# Fixed values of the monthly report.
PERMISSION_LIKE = "%Permission%"
DESTRUCTIVE_LIKE = "delete%"
IP_DENIED_ACTION = "IpAccessDenied"


def week_over_week(t: Telemetry, as_of=None) -> DataFrame:
    """DBUs per product, days -14..-8 versus days -7..0, growth in percent.

    The current span has 8 calendar days (>= -7 includes today), the previous 7.
    """
    a = AsOf.of(as_of)
    d = col("usage_date")
    prev = d.between(a.days_ago(14), a.days_ago(8))
    this = d >= a.days_ago(7)
    grouped = (t.usage.filter(since_days("usage_date", a, 14))
               .groupBy("billing_origin_product")
               .agg(F.sum(F.when(prev, col("usage_quantity"))).alias("prev_week_dbus"),
                    F.sum(F.when(this, col("usage_quantity"))).alias("this_week_dbus")))
    growth = F.try_divide((col("this_week_dbus") - col("prev_week_dbus")).cast("double"),
                          F.nullif(col("prev_week_dbus"), F.lit(0)).cast("double"))
    return grouped.withColumn("growth_pct", F.round(growth * 100, 2))


def monthly_governance(t: Telemetry, as_of=None, months: int = 6) -> DataFrame:
    """R2: distinct permission, destructive and IP-denial events and active users per month.

    Duplicates go first, then everything is a sum. Events that meet no rule are left
    out by the scan; of the others there is one row per (month, event), which knows
    the rules that any of its copies meets. Users are one row per (month, user),
    which every task brings down to the users it has seen. So no row is multiplied
    per distinct count, and all aggregates are hash aggregates of fixed width.
    """
    a = AsOf.of(as_of)
    action = col("action_name")
    rules = {"permission_events": action.like(PERMISSION_LIKE), "destructive_events": action.like(DESTRUCTIVE_LIKE),
             "ip_denials": action == IP_DENIED_ACTION}
    month = F.trunc("event_date", "MM").alias("month")
    recent = t.audit.filter(col("event_date") >= a.months_ago(months))
    met = reduce(or_, rules.values())
    events = (recent.filter(met & col("event_id").isNotNull()).groupBy(month, "event_id")
              .agg(*(F.max(rule.cast("int")).alias(n) for n, rule in rules.items())))
    users = recent.groupBy(month, col("user_identity.email").alias("user")).agg(F.lit(1).alias("seen"))
    counts = users.select("month", F.when(col("user").isNotNull(), 1).otherwise(0).alias("active_users")).unionByName(
        events.drop("event_id"), allowMissingColumns=True)
    return counts.groupBy("month").agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in (
        "permission_events", "destructive_events", "active_users", "ip_denials")))
