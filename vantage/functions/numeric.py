"""Null- and zero-safe arithmetic helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_mean(col: Column) -> Column:
    """Mean as ``double(sum) / count``.

    For decimal inputs the sum is exact, so the result does not depend on the
    order rows are added in (``avg`` of doubles does).
    """
    return F.try_divide(F.sum(col).cast("double"), F.count(col).cast("double"))
