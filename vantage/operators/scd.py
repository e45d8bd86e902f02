"""Latest version of slowly changing (SCD2) dimension rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def latest_version(df: DataFrame, keys: Sequence[str], order_col: str = "change_time",
                   tiebreak: Sequence[str | Column] = ()) -> DataFrame:
    """One row per key: the row with the greatest ``order_col``.

    ``row_number() ... = 1``: Catalyst turns it into a WindowGroupLimit that
    keeps only the top row per key inside each input partition before the
    shuffle, so a key with very many versions never moves all of them.
    ``tiebreak`` orders rows with equal ``order_col`` (descending) so the result
    is deterministic. Order columns that the table lacks are left out.
    """
    present = {c.lower() for c in df.columns}
    tiebreak = [t for t in tiebreak if not isinstance(t, str) or t.lower() in present]
    if order_col.lower() not in present:  # no history: any order of what is there
        order_col, *rest = [t for t in tiebreak if isinstance(t, str)] or sorted(set(df.columns) - set(keys)) or list(keys)
        tiebreak = rest
    if all(isinstance(t, str) for t in tiebreak):
        order = ", ".join(f"`{c}` DESC NULLS LAST" for c in [order_col, *tiebreak])
        part = ", ".join(f"`{k}`" for k in keys)
        rank = F.expr(f"row_number() OVER (PARTITION BY {part} ORDER BY {order})")
    else:
        order = [F.col(order_col).desc_nulls_last()]
        order += [(F.col(t) if isinstance(t, str) else t).desc_nulls_last() for t in tiebreak]
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", rank).filter("_rn = 1").drop("_rn")
