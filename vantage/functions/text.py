"""Text helpers as JVM-side column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FENCE = "```"


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def fenced_block(text: Column) -> Column:
    """First fenced code block of a markdown text, preferring a ``sql`` fence.

    The block runs to the next fence or to the end of the text (unclosed
    fence); surrounding whitespace is removed. Null when there is no fence.
    """
    sql_block = F.regexp_extract(text, r"(?s)```sql(.*?)(?:```|\z)", 1)
    any_block = F.regexp_extract(text, r"(?s)```(.*?)(?:```|\z)", 1)
    return (F.when(text.contains(FENCE + "sql"), _strip(sql_block))
            .when(text.contains(FENCE), _strip(any_block)))
