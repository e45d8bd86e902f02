"""``as_of`` handling and trailing time windows.

Every use of "now" in a query is an ``AsOf``. Its literal columns are constant-
folded by Catalyst, so a filter such as ``usage_date >= as_of - 7 days`` reaches
the parquet scan as a plain literal comparison (``PushedFilters``).
"""

from __future__ import annotations

import datetime as _dt
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class AsOf:
    """The evaluation instant. ``None`` means the session's current time.

    Its columns are SQL literal expressions (one JVM call each); the instant is
    parsed and re-printed first, so only a well-formed timestamp reaches the text.
    """

    instant: str | _dt.datetime | _dt.date | None = None

    @classmethod
    def of(cls, value: "AsOf | str | _dt.datetime | _dt.date | None") -> "AsOf":
        return value if isinstance(value, AsOf) else cls(value)

    def _text(self) -> str | None:
        v = self.instant
        if v is None:
            return None
        if isinstance(v, str):
            v = _dt.datetime.fromisoformat(v)
        if not isinstance(v, _dt.datetime):
            v = _dt.datetime(v.year, v.month, v.day)
        if v.tzinfo is not None:
            raise ValueError(f"as_of is a wall-clock instant of the session's zone; convert {v.isoformat()} first")
        return v.strftime("%Y-%m-%d %H:%M:%S.%f")

    def sql_ts(self) -> str:
        text = self._text()
        return "current_timestamp()" if text is None else f"TIMESTAMP_NTZ '{text}'"

    def sql_date(self) -> str:
        text = self._text()
        return "current_date()" if text is None else f"DATE '{text[:10]}'"

    def ts(self) -> Column:
        """The instant as a wall-clock timestamp (no zone conversion)."""
        return F.expr(self.sql_ts())

    def date(self) -> Column:
        return F.expr(self.sql_date())

    def sql_days_ago(self, days: int) -> str:
        return f"date_sub({self.sql_date()}, {int(days)})"

    def days_ago(self, days: int) -> Column:
        """``current_date - INTERVAL n DAYS`` (a date)."""
        return F.expr(self.sql_days_ago(days))

    def months_ago(self, months: int) -> Column:
        return F.expr(f"add_months({self.sql_date()}, {-int(months)})")

    def month_start(self) -> Column:
        return F.expr(f"trunc({self.sql_date()}, 'MM')")

    def sql_minus(self, days: int = 0, hours: int = 0) -> str:
        return f"{self.sql_ts()} - make_dt_interval({int(days)}, {int(hours)}, 0, 0)"

    def minus(self, days: int = 0, hours: int = 0) -> Column:
        """``current_timestamp - INTERVAL ...`` (a timestamp)."""
        return F.expr(self.sql_minus(days, hours))


_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)*$")


def since_days(date_col: str | Column, as_of: AsOf, days: int) -> Column:
    """Trailing-day window on a date column: ``col >= as_of_date - days``."""
    if isinstance(date_col, str) and _NAME.match(date_col):
        return F.expr(f"{date_col} >= {as_of.sql_days_ago(days)}")
    return _c(date_col) >= as_of.days_ago(days)


def since_interval(ts_col: str | Column, as_of: AsOf, days: int = 0, hours: int = 0) -> Column:
    """Trailing window on a timestamp column: ``col >= as_of - interval``."""
    if isinstance(ts_col, str) and _NAME.match(ts_col):
        return F.expr(f"{ts_col} >= {as_of.sql_minus(days, hours)}")
    return _c(ts_col) >= as_of.minus(days=days, hours=hours)


def floor_time(df: DataFrame, col: str, unit: str) -> Column:
    """``date_trunc(unit, col)`` that keeps the column's timestamp flavour.

    ``date_trunc`` always answers a session-zone ``timestamp``; a wall-clock
    (``timestamp_ntz``) input is cast back so results do not depend on the
    session time zone.
    """
    out = F.date_trunc(unit, F.col(col))
    if isinstance(_field_type(df, col), T.TimestampNTZType):
        out = out.cast(T.TimestampNTZType())
    return out


def epoch_seconds_between(start: str | Column, end: str | Column) -> Column:
    """Seconds between two instants by epoch subtraction (whole seconds of each)."""
    return F.unix_timestamp(_c(end)) - F.unix_timestamp(_c(start))


def calendar_seconds_between(start: str | Column, end: str | Column) -> Column:
    """``TIMESTAMPDIFF(SECOND, start, end)``: whole seconds elapsed."""
    return F.timestamp_diff("SECOND", _c(start), _c(end))


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _field_type(df: DataFrame, dotted: str) -> T.DataType:
    dtype: T.DataType = df.schema
    for part in dotted.split("."):
        assert isinstance(dtype, T.StructType)
        dtype = dtype[part].dataType
    return dtype
