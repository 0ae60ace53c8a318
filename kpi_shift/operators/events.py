"""Detection of the day a tower switches to the new KPI set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpi_shift.functions.dates import calendar
from kpi_shift.functions.lookup import lookup_join
from kpi_shift.operators.clean import vendor_activity
from kpi_shift.spec import Level, Monitor


def detect_events(
    panel: DataFrame,
    level: Level,
    monitor: Monitor,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """(tower, event_date) for every day on which a tower shows the new KPI set after none in the window before.

    A day counts as new when one of its rows has positive new activity. Over the day and the ``baseline_days`` before
    it, neither the old nor the new activity may sum to zero; a sum of nulls only does not count as zero. All run days
    come out of one pass; ``start``/``end`` (inclusive) restrict them and prune the scan.

    Rows are first reduced to one per tower and day with partial aggregation, so the ordered window holds at most one
    row per calendar day of a tower, however many rows the tower has.
    """
    days = monitor.baseline_days
    source = panel
    if start is not None:
        source = source.filter(f"day >= date_sub(DATE'{start}', {days})")
    if end is not None:
        source = source.filter(f"day <= DATE'{end}'")
    return judge_days(daily_activity(source, level, monitor), level, monitor, start)


def daily_activity(panel: DataFrame, level: Level, monitor: Monitor) -> DataFrame:
    """(tower, day, old_sum, new_sum, hit): what the detection needs of a tower's day; ``hit`` is 1 if a row has positive new activity, else null."""
    return (
        vendor_activity(panel, monitor)
        .groupBy(level.tower, "day")
        .agg(
            F.sum("old_activity").alias("old_sum"),
            F.sum("new_activity").alias("new_sum"),
            F.expr("max(if(NOT isnan(new_activity) AND new_activity > 0, 1, NULL))").alias("hit"),
        )
    )


def judge_days(daily: DataFrame, level: Level, monitor: Monitor, start: str | None = None) -> DataFrame:
    """The events from ``start`` on among the days of ``daily_activity``, which reaches back ``baseline_days`` further."""
    by_day = f"PARTITION BY {level.tower} ORDER BY unix_date(day) RANGE BETWEEN {monitor.baseline_days} PRECEDING AND"
    judged = daily.selectExpr(
        level.tower,
        "day AS event_date",
        "hit",
        f"max(hit) OVER ({by_day} 1 PRECEDING) AS hit_before",
        f"sum(old_sum) OVER ({by_day} CURRENT ROW) AS old_window",
        f"sum(new_sum) OVER ({by_day} CURRENT ROW) AS new_window",
    )
    found = judged.filter(
        "hit IS NOT NULL AND hit_before IS NULL AND coalesce(old_window <> 0, true) AND coalesce(new_window <> 0, true)"
    )
    if start is not None:
        found = found.filter(f"event_date >= DATE'{start}'")
    return found.select(level.tower, "event_date")


def cohort(events: DataFrame, level: Level) -> DataFrame:
    """Distinct (tower, event_date) of an event list, whatever else its rows carry."""
    return events.selectExpr(level.tower, "cast(event_date AS date) AS event_date").distinct()


def rows_around(rows: DataFrame, events: DataFrame, level: Level, first: int, last: int) -> DataFrame:
    """Rows of event towers on the days ``event_date + first`` .. ``event_date + last``, with ``event_date``.

    A row appears once per event whose window it lies in.
    """
    near = f"day BETWEEN date_add(event_date, {first}) AND date_add(event_date, {last})"
    return lookup_join(rows, cohort(events, level), [level.tower]).filter(near)


def event_rows(panel: DataFrame, events: DataFrame, level: Level, monitor: Monitor) -> DataFrame:
    """The event list as published: all KPI rows of the event day, with both activities and ``event_date``."""
    return vendor_activity(rows_around(panel, events, level, 0, 0), monitor)


def events_by_level(inventory: DataFrame, events: DataFrame, level: Level) -> DataFrame:
    """The tower events carried to a finer level: one row per entity of an event tower."""
    entities = inventory.select(*level.ids).distinct()
    return lookup_join(entities, cohort(events, level), [level.tower])


def event_list_check(events: DataFrame, start: str, end: str) -> DataFrame:
    """One row per run day: number of events, and whether the list of that day is empty."""
    spark = events.sparkSession
    counts = events.groupBy("event_date").agg(F.count("*").alias("n_events"))
    days = calendar(spark, start, end, "event_date")
    n = F.coalesce("n_events", F.lit(0).cast("long"))
    return days.join(counts, "event_date", "left").select("event_date", n.alias("n_events"), (n == 0).alias("is_empty"))
