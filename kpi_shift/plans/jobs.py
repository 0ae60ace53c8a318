"""The recurring jobs: raw daily files to panel, pre-event tables, post-event scores, alert documents.

Every job covers the run days from ``start`` until ``end`` (exclusive; one day apart for a daily run) in one plan and
replaces the partitions of its range, those that become empty included, so running a job again, after a correction, or over
a longer range, gives the same tables. ``sinks.read_partitions`` reads a table, also before the first event.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpi_shift.functions.columns import add_missing, rename_columns
from kpi_shift.functions.dates import date_window
from kpi_shift.functions.stage import stage
from kpi_shift.operators.alerts import alert_documents
from kpi_shift.operators.audit import combined_completeness, completeness_report
from kpi_shift.operators.clean import clean_kpis
from kpi_shift.operators.context import entity_report, sector_azimuth, tower_coords, tower_report
from kpi_shift.operators.events import cohort, detect_events, event_list_check, event_rows, rows_around
from kpi_shift.operators.impact import flatten_nested, impacted_users, normalise_failures
from kpi_shift.operators.panels import baseline_stats, post_event_rows, pre_event_rows
from kpi_shift.operators.score import score_post_event, zero_override
from kpi_shift.operators.tickets import tickets_near_tower, work_orders_per_tower
from kpi_shift.sources.daily import read_daily_csv
from kpi_shift.sources.quarantine import read_daily_sorted
from kpi_shift.sources.sinks import read_partitions, write_documents, write_parquet, write_partitions
from kpi_shift.spec import RAW_COLUMNS, Level, Monitor

PANEL, EVENTS, PRE_PANEL, BASELINE, SCORES, REPORT = "panel", "events", "pre_panel", "baseline", "scores", "report"
REJECTS = "rejects"


def _shift(day: str, days: int) -> str:
    return (date.fromisoformat(day) + timedelta(days=days)).isoformat()


def _between(df: DataFrame, column: str, start: str, end: str) -> DataFrame:
    return df.filter(f"{column} >= DATE'{start}' AND {column} < DATE'{end}'")


def read_raw(
    spark: SparkSession,
    pattern: str,
    level: Level,
    monitor: Monitor,
    days: list[str],
    names: Mapping[str, str] = RAW_COLUMNS,
    set_aside: Callable[[DataFrame], None] | None = None,
) -> DataFrame:
    """Clean KPI rows of the raw files of ``days``. A shared KPI that a file does not have yet counts as 0.

    With ``set_aside``, which is given the rejects, damaged days and malformed records do not end the run.
    """
    wanted = {*level.ids, "day", *monitor.categorical, *monitor.panel_columns}
    headers = [raw for raw, name in names.items() if name in wanted]
    late = {raw: F.lit("0") for raw in headers if names[raw] in monitor.shared_columns}
    # cleaning groups by whole rows, so the reader need not remove copies
    if set_aside is None:
        raw = read_daily_csv(spark, pattern, days, headers, lambda df: add_missing(df, late), distinct=False)
    else:
        raw, rejects = read_daily_sorted(spark, pattern, days, headers, lambda df: add_missing(df, late), distinct=False)
        set_aside(rejects)
    return clean_kpis(rename_columns(raw.select(*[f"`{h}`" for h in headers]), names), level, monitor)


def ingest_job(
    spark: SparkSession,
    pattern: str,
    out: str,
    level: Level,
    monitor: Monitor,
    start: str,
    end: str,
    names: Mapping[str, str] = RAW_COLUMNS,
    keep_rejects: bool = False,
) -> DataFrame:
    """Clean the files of the days from ``start`` until ``end`` once, into the panel table partitioned by day; return it.

    ``keep_rejects`` goes on past damaged files: what cannot be read is told in the table of rejects, partitioned by day, and the
    panel has no rows of a damaged day. Without it such a file fails the job.

    The other jobs read the table and prune it by day. Rows without a day are of no use to them and stay out; a row of a
    day outside the range fails the job, since it would replace a partition that was not asked for.
    """
    days = date_window(start, end=_shift(end, -1))

    def told(rejects: DataFrame) -> None:
        write_partitions(rejects, f"{out}/{REJECTS}", ["day"], ("day", start, end))

    panel = read_raw(spark, pattern, level, monitor, days, names, told if keep_rejects else None).filter("day IS NOT NULL")
    astray = F.raise_error(F.concat(F.lit("row of another day: "), F.col("day").cast("string"))).cast("date")
    checked = F.when(F.expr(f"day >= DATE'{start}' AND day < DATE'{end}'"), F.col("day")).otherwise(astray)
    write_partitions(panel.withColumn("day", checked), f"{out}/{PANEL}", ["day"], ("day", start, end))
    return read_partitions(spark, f"{out}/{PANEL}")


def load_panel(
    spark: SparkSession,
    pattern: str,
    level: Level,
    monitor: Monitor,
    start: str,
    end: str,
    names: Mapping[str, str] = RAW_COLUMNS,
) -> DataFrame:
    """Clean KPI panel from one raw CSV per day, from the first baseline day of ``start`` until ``end``.

    ``names`` maps file headers to panel names. A shared KPI that a file does not have yet counts as 0. The panel is
    written to the shared folder, so the text is parsed and cleaned once, whatever is computed from it.
    """
    days = date_window(_shift(start, -monitor.baseline_days), end=_shift(end, -1))
    panel = read_raw(spark, pattern, level, monitor, days, names)
    return stage(panel, f"{level.name}_panel")


def pre_event_job(
    panel: DataFrame,
    out: str,
    level: Level,
    monitor: Monitor,
    start: str,
    end: str,
    events: DataFrame | None = None,
) -> DataFrame:
    """Write event list, pre-event panel and baseline of the events of the run days; return the event list check.

    A finer level takes the ``events`` of the tower run and writes no list of its own.
    """
    panel = _between(panel, "day", _shift(start, -monitor.baseline_days), end)
    last = _shift(end, -1)
    if events is None:
        found = stage(detect_events(panel, level, monitor, start, last), "events")
        write_partitions(event_rows(panel, found, level, monitor), f"{out}/{EVENTS}", ["event_date"], ("event_date", start, end))
    else:
        found = stage(_between(cohort(events, level), "event_date", start, end), "events")
    around = stage(rows_around(panel, found, level, -monitor.baseline_days, -1), "cohort_rows")
    pre_panel = pre_event_rows(around, level, monitor)
    write_partitions(pre_panel, f"{out}/{PRE_PANEL}", ["event_date"], ("event_date", start, end))
    write_partitions(baseline_stats(pre_panel, level, monitor), f"{out}/{BASELINE}", ["event_date"], ("event_date", start, end))
    return event_list_check(found, start, last)


def post_event_job(
    panel: DataFrame,
    events: DataFrame,
    baseline: DataFrame,
    out: str,
    level: Level,
    monitor: Monitor,
    start: str,
    end: str,
    report: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
) -> None:
    """Score all cohorts of the run days against the written event list and baseline.

    ``report`` gets the scored rows and the cohorts and may add context to the former.
    """
    first_cohort = _shift(start, -monitor.follow_days)
    cohorts = stage(_between(cohort(events, level), "event_date", first_cohort, end), "events")
    around = stage(
        rows_around(_between(panel, "day", start, end), cohorts, level, 0, monitor.follow_days), "cohort_rows"
    )
    known = _between(baseline, "event_date", first_cohort, end)
    post_panel = post_event_rows(around, level, monitor, start, end)
    scored = zero_override(score_post_event(post_panel, known, level, monitor, summarised=False), monitor)
    write_partitions(report(scored, cohorts) if report else scored, f"{out}/{SCORES}", between=("day", start, end))


def tower_report_job(
    out: str,
    inventory: DataFrame,
    ticket_rows: DataFrame,
    orders: DataFrame,
    level: Level,
    monitor: Monitor,
    start: str,
    end: str,
    **options,
) -> DataFrame:
    """Write the report of the run days: scores with coordinates, near tickets and work orders; return it.

    ``options`` go to the ticket search.
    """
    spark = inventory.sparkSession
    scores = _between(read_partitions(spark, f"{out}/{SCORES}"), "day", start, end)
    cohorts = _between(read_partitions(spark, f"{out}/{EVENTS}"), "event_date", _shift(start, -monitor.follow_days), end)
    cohorts = stage(cohort(cohorts, level), "events")
    coords = stage(tower_coords(inventory, level), "coords")
    near = _between(tickets_near_tower(ticket_rows, cohorts, coords, level, monitor, **options), "day", start, end)
    open_orders = _between(work_orders_per_tower(orders, cohorts, level, monitor), "day", start, end)
    report = tower_report(scores, coords, near, open_orders, level)
    write_partitions(report, f"{out}/{REPORT}", between=("day", start, end))
    return _between(read_partitions(spark, f"{out}/{REPORT}"), "day", start, end)


def entity_report_job(out: str, inventory: DataFrame, level: Level, start: str, end: str) -> DataFrame:
    """Write the sector or carrier report of the run days: scores with azimuths; return it."""
    spark = inventory.sparkSession
    scores = _between(read_partitions(spark, f"{out}/{SCORES}"), "day", start, end)
    write_partitions(entity_report(scores, sector_azimuth(inventory, level), level), f"{out}/{REPORT}", between=("day", start, end))
    return _between(read_partitions(spark, f"{out}/{REPORT}"), "day", start, end)


def impacted_users_job(failures: DataFrame, out: str, path: str, level: Level, run_day: str) -> None:
    """Write the users whose failures of one run day belong to a tower's raised alerts; ``failures`` is nested and has ``day``."""
    scores = read_partitions(failures.sparkSession, f"{out}/{SCORES}").filter(f"day = DATE'{run_day}'")
    todays = normalise_failures(flatten_nested(failures.filter(f"day = DATE'{run_day}'")))
    write_parquet(impacted_users(todays, scores, level), path)


def audit_job(sides: dict[str, DataFrame], expected: DataFrame, path: str, as_of: str, holidays: list[str]) -> None:
    """Write the completeness of the expected tables, one report for each side (loads of the store, dated files) by name."""
    write_parquet(combined_completeness({side: completeness_report(loads, expected, as_of, holidays) for side, loads in sides.items()}), path)


def alert_job(
    scores: DataFrame,
    path: str,
    level: Level,
    monitor: Monitor,
    run_day: str,
    link: str,
    constants: Mapping[str, str] | None = None,
) -> None:
    """Write the alert documents of one run day."""
    todays = scores.filter(f"day = DATE'{run_day}'")
    write_documents(alert_documents(todays, level, monitor, link, constants), path)
