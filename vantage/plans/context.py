"""Cost context as JSON; N2: fenced SQL extraction over response texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.functions.text import fenced_block
from vantage.functions.time import AsOf, since_days
from vantage.plans.gold import Gold
from vantage.sources.telemetry import Telemetry

col = F.col


def cost_context_json(t: Telemetry, as_of=None, gold: Gold | None = None, days: int = 7) -> DataFrame:
    """The last ``days`` days of daily cost as JSON, one document per
    (day, workspace).

    Each document is that workspace's rows of the day (sorted) as a JSON array:
    one entry per (product, SKU), so no document grows with usage volume or
    with the number of workspaces.
    """
    a = AsOf.of(as_of)
    cost = (gold or Gold(t, a))["gold_cost_daily"].filter(since_days("date", a, days))
    row = F.struct(col("product"), col("sku_name"),
                   col("total_dbus").cast("double").alias("total_dbus"),
                   col("estimated_cost_usd").cast("double").alias("estimated_cost_usd"),
                   col("unique_users"))
    return (cost.groupBy("date", "workspace_id")
            .agg(F.to_json(F.array_sort(F.collect_list(row)), {"ignoreNullFields": "false"}).alias("context_json")))


def extract_fenced_sql(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``extracted_sql`` (first fenced block, sql fence preferred) to every row."""
    return texts.withColumn("extracted_sql", fenced_block(col(text_col)))


def assistant_sql(t: Telemetry, as_of=None, conversations: DataFrame | None = None) -> DataFrame:
    """N2 over assistant turns of a conversations table."""
    conv = conversations if conversations is not None else t.table("conversations")
    return extract_fenced_sql(conv.filter(col("role") == "assistant")).select("conv_id", "turn", "extracted_sql")
