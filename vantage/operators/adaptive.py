"""Schema-adaptive projection: tolerate optional source columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def has_column(df: DataFrame, name: str) -> bool:
    return name.lower() in {f.name.lower() for f in df.schema.fields}


def column_or(df: DataFrame, name: str, fallback: Column, alias: str | None = None,
              coalesce: bool = True) -> Column:
    """``coalesce(name, fallback)`` when the column exists, else ``fallback``.

    Decided from the schema at plan-build time (no data is read).
    """
    if has_column(df, name):
        out = F.coalesce(F.col(name), fallback) if coalesce else F.col(name)
    else:
        out = fallback
    return out.alias(alias or name)
