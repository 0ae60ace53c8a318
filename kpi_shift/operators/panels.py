"""KPI rows before and after an event, and the baseline computed from the former."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpi_shift.operators.clean import silent_to_null
from kpi_shift.operators.events import rows_around
from kpi_shift.spec import Level, Monitor


def _cohort_panel(rows: DataFrame, level: Level, monitor: Monitor, side: str, first: int, last: int) -> DataFrame:
    """Rows of the given days around their event, with the KPIs of one side under their common names."""
    carried = [c for c in monitor.categorical if c in rows.columns]
    kpis = [f"{getattr(k, side)} AS {k.name}" for k in monitor.kpis]
    return rows.filter(
        f"day BETWEEN date_add(event_date, {first}) AND date_add(event_date, {last})"
    ).selectExpr(*level.ids, "day", *carried, *kpis, "event_date")


def pre_event_columns(cohort_rows: DataFrame, level: Level, monitor: Monitor) -> DataFrame:
    """Old-set KPI rows of the days before the event, silent rows as they are."""
    return _cohort_panel(cohort_rows, level, monitor, "old", -monitor.baseline_days, -1)


def pre_event_rows(cohort_rows: DataFrame, level: Level, monitor: Monitor) -> DataFrame:
    """``pre_event_panel`` from rows that already carry their ``event_date``."""
    rows = pre_event_columns(cohort_rows, level, monitor)
    return silent_to_null(rows, monitor.names, ["event_date", "day", *level.ids])


def pre_event_panel(panel: DataFrame, events: DataFrame, level: Level, monitor: Monitor) -> DataFrame:
    """Old-set KPI rows of event towers on the days before the event (event day excluded), silent rows nulled.

    A row is silent here when all KPIs, shared ones included, sum to zero.
    """
    return pre_event_rows(rows_around(panel, events, level, -monitor.baseline_days, -1), level, monitor)


def baseline_stats(pre_panel: DataFrame, level: Level, monitor: Monitor) -> DataFrame:
    """Mean and sample standard deviation of each KPI per entity and event, rounded. One aggregation for all."""
    digits = monitor.digits
    return pre_panel.groupBy(*level.ids, "event_date").agg(
        *[F.expr(f"round(avg({k.name}), {digits}) AS {k.avg}") for k in monitor.kpis],
        *[F.expr(f"round(stddev_samp({k.name}), {digits}) AS {k.std}") for k in monitor.kpis],
    )


def post_event_columns(
    cohort_rows: DataFrame,
    level: Level,
    monitor: Monitor,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """New-set KPI rows from the event day on, silent rows as they are."""
    return _cohort_panel(_run_days(cohort_rows, start, end), level, monitor, "new", 0, monitor.follow_days)


def post_event_rows(
    cohort_rows: DataFrame,
    level: Level,
    monitor: Monitor,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """``post_event_panel`` from rows that already carry their ``event_date``."""
    rows = post_event_columns(cohort_rows, level, monitor, start, end)
    unshared = [k.name for k in monitor.kpis if not k.shared]
    return silent_to_null(rows, unshared, ["event_date", "day", *level.ids])


def post_event_panel(
    panel: DataFrame,
    events: DataFrame,
    level: Level,
    monitor: Monitor,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """New-set KPI rows of event towers from the event day on, silent rows nulled.

    A row is silent here when the unshared KPIs sum to zero; only those are nulled. Covers every cohort of every run
    day at once; ``start`` (inclusive) and ``end`` (exclusive) restrict the run days.
    """
    rows = rows_around(_run_days(panel, start, end), events, level, 0, monitor.follow_days)
    return post_event_rows(rows, level, monitor)


def _run_days(rows: DataFrame, start: str | None, end: str | None) -> DataFrame:
    if start is not None:
        rows = rows.filter(f"day >= DATE'{start}'")
    if end is not None:
        rows = rows.filter(f"day < DATE'{end}'")
    return rows
