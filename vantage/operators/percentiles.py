"""Exact percentiles in one pass: values are counted once, and everything else is carried along.

A value of a group becomes a count, counts become buckets of neighbouring values, and buckets find the ranks. So a group
that holds a third of all rows is nowhere gathered row by row, and no step reads the source, or the counts, again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def percentiles(df: DataFrame, keys: Sequence[str], value: str, p: float, width: int, exact: str | None = None,
                discrete: str | None = None, sums: Mapping[str, Column] | None = None,
                maxima: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per ``keys`` with percentiles of a whole-number column and other aggregates of the same rows.

    ``exact`` names the linearly interpolated ``p`` quantile, ``discrete`` the least value with at least a share ``p`` of
    the values at or below it; nulls are left out, and a group without values has nulls. ``sums`` and ``maxima`` name
    further columns, over all rows of the group. Null keys are keys.

    Three aggregations, each on fewer rows than the one before: by (keys, value) with partial counts in every task; by
    (keys, bucket of ``width`` values), where a bucket carries its values and counts, at most ``width`` of them; by keys,
    after a window over a group's buckets has told each the number of values before it. The two or three values sought are
    then looked up in the buckets that hold their ranks.
    """
    sums, maxima = dict(sums or {}), dict(maxima or {})
    v, c = F.col("_v"), F.col("_c")
    counted = df.groupBy(*keys, F.col(value).alias("_v")).agg(
        F.count(F.col(value)).alias("_c"), *(F.sum(x).alias(n) for n, x in sums.items()), *(F.max(x).alias(n) for n, x in maxima.items()))
    buckets = counted.groupBy(*keys, F.floor(v / width).alias("_b")).agg(
        F.sum(c).alias("_n"), F.sort_array(F.collect_list(F.when(v.isNotNull(), F.struct(v, c)))).alias("_in"),
        *(F.sum(n).alias(n) for n in sums), *(F.max(n).alias(n) for n in maxima))
    group = Window.partitionBy(*keys)
    placed = (buckets.withColumn("_total", F.sum("_n").over(group))
              .withColumn("_before", F.sum("_n").over(group.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")))
    at = F.lit(p) * (F.col("_total") - 1)
    ranks = {"_low": F.floor(at), "_high": F.ceil(at)} if exact else {}
    if discrete:
        ranks["_step"] = F.greatest(F.ceil(F.lit(p) * F.col("_total")) - 1, F.lit(0))
    found = placed.groupBy(*keys).agg(
        *(F.max(_value_at(rank.cast("long"))).alias(n) for n, rank in ranks.items()), F.max("_total").alias("_total"),
        *(F.sum(n).alias(n) for n in sums), *(F.max(n).alias(n) for n in maxima))
    out = [*keys]
    if exact:
        share = at - F.floor(at)
        out.append((F.col("_low") * (1 - share) + F.col("_high") * share).alias(exact))
    if discrete:
        out.append(F.col("_step").alias(discrete))
    return found.select(*out, *sums, *maxima)


def _value_at(rank: Column) -> Column:
    """The value with the given rank in its group, if this bucket holds it."""
    start = F.struct((rank - F.col("_before")).alias("left"), F.lit(None).cast("long").alias("value"))

    def step(state: Column, entry: Column) -> Column:
        here = (state["left"] >= 0) & (state["left"] < entry["_c"])
        return F.struct((state["left"] - entry["_c"]).alias("left"),
                        F.when(here, entry["_v"].cast("long")).otherwise(state["value"]).alias("value"))

    holds = (F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_n"))
    return F.when(holds, F.aggregate("_in", start, step, lambda state: state["value"]))


def exact_percentile(df: DataFrame, keys: Sequence[str], value: str, p: float, width: int, out: str) -> DataFrame:
    """``keys`` and ``out``: the linearly interpolated ``p`` quantile of a whole-number column; groups without one are left
    out."""
    return percentiles(df, keys, value, p, width, exact=out).where(F.col(out).isNotNull())
