"""Day windows and calendars."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def date_window(
    start: str,
    days: int = 1,
    direction: str = "backward",
    as_type: str = "str",
    end: str | None = None,
) -> list:
    """Days from ``start`` (always first) to the other end, both included.

    ``end`` overrides ``days`` and ``direction``. ``as_type`` is ``str``, ``date`` or ``epoch`` (seconds at UTC midnight).
    """
    first = date.fromisoformat(start)
    if end is not None:
        span = (date.fromisoformat(end) - first).days
        step = 1 if span > 0 else -1
        span = abs(span)
    elif direction.lower() in ("forward", "backward"):
        span, step = days, (1 if direction.lower() == "forward" else -1)
    else:
        raise ValueError(f"direction must be 'forward' or 'backward', not {direction!r}")
    window = [first + timedelta(days=step * i) for i in range(span + 1)]
    if as_type == "date":
        return window
    if as_type == "epoch":
        return [datetime(d.year, d.month, d.day, tzinfo=timezone.utc).timestamp() for d in window]
    return [d.isoformat() for d in window]


def calendar(spark: SparkSession, start: str, end: str, name: str = "day") -> DataFrame:
    """One row per day from ``start`` to ``end``, both included; descending when ``end`` lies before ``start``."""
    bounds = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return spark.range(1).select(F.explode(bounds).alias(name))


def days_around(anchor: str | Column, first: int, last: int) -> Column:
    """Array of the days ``anchor + first`` .. ``anchor + last``."""
    return F.sequence(F.date_add(anchor, first), F.date_add(anchor, last))


def parse_day(column: str | Column, pattern: str | None = None) -> Column:
    """Text to date; null when it does not parse. A date column passes through."""
    c = F.col(column) if isinstance(column, str) else column
    return F.try_to_date(c, pattern) if pattern else c.try_cast("date")
