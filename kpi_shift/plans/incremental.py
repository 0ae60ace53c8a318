"""Events and baselines kept up day by day: a run reads the new days of the panel, and small daily states of the rest.

Two states are kept, each a table partitioned by day with one row per tower or entity: activity for the event
detection, moments for the baselines. Days may come in any order and may come again: a day's partition is replaced, and all run
days whose window holds it are judged anew from the states.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from kpi_shift.functions.stage import stage
from kpi_shift.operators.events import daily_activity, judge_days
from kpi_shift.operators.moments import baseline_from_moments, daily_moments
from kpi_shift.sources.sinks import read_partitions, write_partitions
from kpi_shift.spec import Level, Monitor

ACTIVITY, MOMENTS, FOUND, BASELINES = "activity", "moments", "found", "baselines"


def _shift(day: str, days: int) -> str:
    return (date.fromisoformat(day) + timedelta(days=days)).isoformat()


def _days(table: DataFrame, column: str, start: str, end: str) -> DataFrame:
    return table.filter(f"{column} >= DATE'{start}' AND {column} < DATE'{end}'")


def keep_days(panel: DataFrame, path: str, level: Level, monitor: Monitor, start: str, end: str) -> None:
    """Put the panel's days from ``start`` until ``end`` (exclusive) into the states. Nothing else of the panel is read."""
    new = _days(panel, "day", start, end)
    write_partitions(daily_activity(new, level, monitor), f"{path}/{ACTIVITY}", ["day"], ("day", start, end))
    write_partitions(daily_moments(new, level, monitor), f"{path}/{MOMENTS}", ["day"], ("day", start, end))


def judge_kept(spark: SparkSession, path: str, level: Level, monitor: Monitor, start: str, end: str, events: DataFrame | None = None) -> None:
    """Detect the events of the run days from ``start`` until ``end`` in the states and write them with their baselines.

    A finer level takes the ``events`` of the tower run.
    """
    window = monitor.baseline_days
    if events is None:
        daily = _days(read_partitions(spark, f"{path}/{ACTIVITY}"), "day", _shift(start, -window), end)
        events = judge_days(daily, level, monitor, start)
    events = stage(_days(events, "event_date", start, end), "events")
    moments = _days(read_partitions(spark, f"{path}/{MOMENTS}"), "day", _shift(start, -window), end)
    write_partitions(events, f"{path}/{FOUND}", ["event_date"], ("event_date", start, end))
    write_partitions(baseline_from_moments(moments, events, level, monitor), f"{path}/{BASELINES}", ["event_date"], ("event_date", start, end))


def advance(panel: DataFrame, path: str, level: Level, monitor: Monitor, start: str, end: str, events: DataFrame | None = None) -> None:
    """Take in the days from ``start`` until ``end`` and bring events and baselines up to date.

    A day counts for the windows of the ``baseline_days`` run days after it as well, so a late or corrected day changes those too.
    """
    keep_days(panel, path, level, monitor, start, end)
    judge_kept(panel.sparkSession, path, level, monitor, start, _shift(end, monitor.baseline_days), events)


def kept_events(spark: SparkSession, path: str) -> DataFrame:
    """The events found so far."""
    return read_partitions(spark, f"{path}/{FOUND}")


def kept_baselines(spark: SparkSession, path: str) -> DataFrame:
    """The baselines of the events found so far."""
    return read_partitions(spark, f"{path}/{BASELINES}")
