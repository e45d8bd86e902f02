"""Window operators over ordered series."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def rolling_mean(value: str, order_col: str, rows: int) -> Column:
    """Mean of the current row and the ``rows - 1`` rows before it.

    No partition: every row goes to one task. Use on a bounded series only
    (e.g. an hourly roll-up of a fixed number of days).
    """
    return F.avg(value).over(Window.orderBy(order_col).rowsBetween(-(rows - 1), Window.currentRow))


def running_total(value: str, partition: Column, order_col: str) -> Column:
    """Running sum within a partition, default frame (unbounded preceding to current, RANGE)."""
    return F.sum(value).over(Window.partitionBy(partition).orderBy(order_col))
