"""Price-at-time join: usage x list prices valid at the usage end time.

Semantics (equi key plus half-open validity interval):
``sku_name`` equal, ``usage_end_time >= price_start_time`` and
(``price_end_time`` is null or ``usage_end_time < price_end_time``).
A usage row ending exactly at a version's start is in that version; one ending
exactly at its end is in the next. Overlapping versions multiply a usage row
(``price_overlaps`` reports them).

Physical plan, the same for every size: one equi-join on ``sku_name`` with the
interval as residual condition. A SKU's versions are few, so a usage row is
compared with few price rows. Each price row is there once, so what Spark compares
with its broadcast threshold is the price list's own size (``session.DEFAULT_CONF``
counts a file's bytes three times, for what decoding adds). Beyond the threshold
both sides are shuffled by SKU, and AQE splits the partition of a SKU that holds a
third of all usage into parts, each of which meets that SKU's few prices. Usage is
scanned once and nothing runs while the plan is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

PRICE_COLUMN = "pricing.effective_list.default"


def flat_prices(prices: DataFrame) -> DataFrame:
    """Only the columns the join needs (nested-field pruning reaches the scan)."""
    return prices.select("sku_name", "price_start_time", "price_end_time",
                         F.col(PRICE_COLUMN).alias("list_price"))


def price_usage(usage: DataFrame, prices: DataFrame, how: str = "left", money: str | None = None) -> DataFrame:
    """Usage columns plus ``list_price`` and ``cost = usage_quantity * list_price``.

    ``how="left"`` keeps unpriced usage (price and cost null); ``"inner"`` drops it.
    ``money`` is a decimal type that quantity and price are cast to first, e.g.
    ``decimal(18,9)``: the product of two 38-digit decimals keeps six fraction
    digits only, so a small cost would become 0. By default the stored types stay.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    u, p = usage.alias("u"), flat_prices(prices).alias("p")
    end_time = F.col("u.usage_end_time")
    valid = ((F.col("u.sku_name") == F.col("p.sku_name")) & (end_time >= F.col("p.price_start_time"))
             & (F.col("p.price_end_time").isNull() | (end_time < F.col("p.price_end_time"))))
    quantity, price = F.col("u.usage_quantity"), F.col("p.list_price")
    if money:
        quantity, price = quantity.cast(money), price.cast(money)
    return u.join(p, valid, how).select(*(F.col(f"u.`{c}`") for c in usage.columns), price.alias("list_price"),
                                        (quantity * price).alias("cost"))


def price_overlaps(prices: DataFrame) -> DataFrame:
    """Pairs of consecutive versions of one SKU whose validity intervals overlap.

    Versions are ordered by start time per SKU and each is compared with its
    successor only (``lag``), so the work is linear in the price list.
    An empty result means every usage row gets at most one price.
    """
    w = Window.partitionBy("sku_name").orderBy("price_start_time", F.col("price_end_time").asc_nulls_last())
    prev_end = F.lag("price_end_time").over(w)
    prev_start = F.lag("price_start_time").over(w)
    return (prices.select("sku_name", "price_start_time", "price_end_time")
            .withColumn("prev_start_time", prev_start)
            .withColumn("prev_end_time", prev_end)
            .filter(F.col("prev_start_time").isNotNull()
                    & (F.col("prev_end_time").isNull() | (F.col("prev_end_time") > F.col("price_start_time")))))
