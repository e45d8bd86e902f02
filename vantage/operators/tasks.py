"""How many tasks hold the rows of an aggregation with about as many groups as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` to as many tasks as the session shuffles to, whatever their size.

    An aggregation by these keys, or by these and more, needs no shuffle of its own then. The number is given, so adaptive
    execution leaves it alone. It would put 64 MB of shuffled rows into a task: 1.5 million rows, whose sorts and hash tables
    take some 2 GB. Where the session leaves the number to the platform ("auto"), so does this."""
    tasks = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    return df.repartition(*([int(tasks)] if tasks.isdigit() else []), *keys)
