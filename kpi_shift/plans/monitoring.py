"""The whole run, over any range of run days."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpi_shift.functions.stage import stage
from kpi_shift.operators.events import cohort, detect_events, rows_around
from kpi_shift.operators.panels import baseline_stats, post_event_rows, pre_event_rows
from kpi_shift.operators.score import score_post_event
from kpi_shift.sources.published import publish_range, read_published
from kpi_shift.sources.sinks import write_partitions
from kpi_shift.spec import Level, Monitor


@dataclass
class Run:
    """The tables of a run. ``events`` are tower events; the others are at the level of the run."""

    events: DataFrame
    pre_panel: DataFrame
    baseline: DataFrame
    scored: DataFrame


def monitor_panel(
    panel: DataFrame,
    level: Level,
    monitor: Monitor,
    events: DataFrame | None = None,
    start: str | None = None,
    end: str | None = None,
) -> Run:
    """Events, pre-event panel, baseline and scores from one KPI panel, for run days from ``start`` until ``end``.

    A finer level takes the ``events`` of the tower run. The panel is scanned twice, once for the events and once for
    the rows around them. These rows, a small part of the panel, are written to the shared folder together with event
    list and baseline: all three are used repeatedly, and once they are written, their true sizes decide whether a
    join broadcasts them.
    """
    lookback, follow = monitor.baseline_days, monitor.follow_days
    if start is not None:
        # the earliest cohort scored on `start` is `follow` days old, and its baseline lies before it
        panel = panel.filter(F.col("day") >= F.date_sub(F.lit(start).cast("date"), follow + lookback))
    if end is not None:
        panel = panel.filter(F.col("day") < F.lit(end).cast("date"))
    if events is None:
        events = detect_events(panel, level, monitor)
    events = cohort(events, level)
    if start is not None:
        events = events.filter(F.col("event_date") >= F.date_sub(F.lit(start).cast("date"), follow))
    events = stage(events, "events")
    around = stage(rows_around(panel, events, level, -lookback, follow), "cohort_rows")
    pre_panel = pre_event_rows(around, level, monitor)
    baseline = stage(baseline_stats(pre_panel, level, monitor), "baseline")
    post_panel = post_event_rows(around, level, monitor, start, end)
    scored = score_post_event(post_panel, baseline, level, monitor, summarised=False)
    return Run(events, pre_panel, baseline, scored)


def score_range(
    panel: DataFrame,
    path: str,
    level: Level,
    monitor: Monitor,
    start: str,
    end: str,
    events: DataFrame | None = None,
    published: bool = False,
) -> DataFrame:
    """Backfill: score all run days from ``start`` until ``end`` (exclusive) in one plan, replace their partitions, return them.

    All cohorts of all run days come out of the same joins. Partitions outside the range stay as they are.
    ``published`` keeps the table in versions (see ``sources.published``), for readers that use it meanwhile.
    """
    run = monitor_panel(panel, level, monitor, events, start, end)
    if published:
        publish_range(run.scored, path, ["event_date", "day"], ("day", start, end))
        return read_published(panel.sparkSession, path).filter(f"day >= DATE'{start}' AND day < DATE'{end}'")
    write_partitions(run.scored, path, between=("day", start, end))
    written = panel.sparkSession.read.schema(run.scored.schema).parquet(path)
    return written.filter(f"day >= DATE'{start}' AND day < DATE'{end}'")
