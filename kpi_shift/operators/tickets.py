"""Trouble tickets and work orders, as of one day or over whole ranges of run days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpi_shift.functions.columns import pad_id
from kpi_shift.functions.nearest import nearest_within
from kpi_shift.functions.lookup import lookup_join
from kpi_shift.operators.events import cohort
from kpi_shift.spec import Level, Monitor

# Problem types and assigned group that make an open ticket count, and the search radius.
PROBLEM_TYPES = (
    "Signal Issue Data-No Signal Where Previously Present",
    "Signal Issue Voice-No Signal Where Previously Present",
    "Broadband/National Access-Unable to Connect-All Services",
    "Broadband/National Access-Performance-Slow Speeds",
    "Call Quality-Audio-Dropped Call-All Calls",
    "Signal Issue Data-No Signal With History Unknown",
    "Broadband/National Access-Performance-Frequent Disconnects",
    "Signal Issue Voice-No Signal With History Unknown",
    "Cannot Originate Calls to Any Number",
    "Voicemail-VZW Voicemail",
    "SMS-Cannot Receive: At All",
    "Call Quality-Audio-Poor Audio",
    "Call Quality-Audio-Dropped Call-Isolated Calls",
    "Cannot Receive Calls-Cannot Receive Any Calls",
    "SMS-Cannot Originate: At All",
    "Call Quality-Audio-Dead Air",
    "Broadband/National Access-Performance-Dormancy",
    "MMS-Cannot Originate: At All",
    "Call Quality-Audio-One Way",
    "Video Calling-Cannot Receive-Any",
    "Cannot Originate Calls  to Any Number",
)
ASSIGNED_GROUP = "NRB"
NEAR_MILES = 5.0
OPEN = "open"

# A cell id longer than 8 characters ends in a 4-character cell suffix.
LONGEST_TOWER_ID = 8
CELL_SUFFIX = 4

_KEY = ("trouble_id", "status")
_VERSION = ("modified_date", "create_date", "lat", "lng", "problem_type", "assigned_group")
_NEWEST = f"max(struct({', '.join(_VERSION)})) AS v"


def _versions(tickets: DataFrame) -> DataFrame:
    """Ticket versions with a position, typed."""
    return tickets.selectExpr(
        *_KEY,
        "try_cast(create_date AS date) AS create_date",
        "try_cast(modified_date AS date) AS modified_date",
        "try_cast(lat AS double) AS lat",
        "try_cast(lng AS double) AS lng",
        "problem_type",
        "assigned_group",
    ).filter("lat IS NOT NULL AND lng IS NOT NULL")


def _counts_as_open(problem_types: Sequence[str], group: str):
    wanted = F.col("problem_type").isin(*problem_types) | (F.col("assigned_group") == group)
    return (F.lower("status") == OPEN) & wanted


def latest_tickets(tickets: DataFrame, as_of: str) -> DataFrame:
    """Newest version per (ticket, status) among those created and modified up to ``as_of``.

    A maximum over structs instead of a ranking window: it combines on the map side, so a ticket with many versions
    is never gathered in one task.
    """
    known = _versions(tickets).filter(f"create_date <= DATE'{as_of}' AND modified_date <= DATE'{as_of}'")
    return known.groupBy(*_KEY).agg(F.expr(_NEWEST)).select(*_KEY, "v.*")


def open_tickets(
    latest: DataFrame,
    problem_types: Sequence[str] = PROBLEM_TYPES,
    group: str = ASSIGNED_GROUP,
) -> DataFrame:
    """Open tickets of the wanted types or group, without ids that also have a version in another status."""
    # one row per status of a ticket
    closed = f"coalesce(max(lower(status) <> '{OPEN}') OVER (PARTITION BY trouble_id), false) AS is_closed"
    undecided = latest.selectExpr("*", closed).filter("NOT is_closed").drop("is_closed")
    return undecided.filter(_counts_as_open(problem_types, group))


def open_spans(
    tickets: DataFrame,
    problem_types: Sequence[str] = PROBLEM_TYPES,
    group: str = ASSIGNED_GROUP,
) -> DataFrame:
    """Range form of ``open_tickets(latest_tickets(tickets, day))``: the days on which that holds each version.

    ``last_day`` is null where no later version or closing ends the span. Versions that become known on one day are
    reduced to the newest first, so both windows hold at most one row per status and calendar day of a ticket.
    """
    return counting_spans(version_spans(known_versions(tickets)), problem_types, group)


def known_versions(tickets: DataFrame) -> DataFrame:
    """Newest version of each (ticket, status) among those that become known on one day: (trouble_id, status, first_day, v)."""
    return (
        _versions(tickets)
        .filter("create_date IS NOT NULL AND modified_date IS NOT NULL")
        .selectExpr("*", "greatest(create_date, modified_date) AS first_day")
        .groupBy(*_KEY, "first_day")
        .agg(F.expr(_NEWEST))
    )


def version_spans(known: DataFrame) -> DataFrame:
    """The days on which each version is the newest of its (ticket, status), until the ticket is closed.

    (trouble_id, status, version columns, first_day, last_day, closed_day); ``last_day`` may lie before ``first_day`` where a version never holds.
    """
    ordered = "PARTITION BY trouble_id, status ORDER BY first_day"
    spans = known.selectExpr(
        *_KEY,
        f"max(v) OVER ({ordered} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v",
        "first_day",
        f"lead(first_day) OVER ({ordered}) AS next_day",
        f"min(if(lower(status) <> '{OPEN}', first_day, NULL)) OVER (PARTITION BY trouble_id) AS closed_day",
    )
    return spans.selectExpr(*_KEY, "v.*", "first_day", "date_sub(least(next_day, closed_day), 1) AS last_day", "closed_day")


def counting_spans(spans: DataFrame, problem_types: Sequence[str] = PROBLEM_TYPES, group: str = ASSIGNED_GROUP) -> DataFrame:
    """The spans of versions that count as open, without empty ones."""
    held = spans.filter(_counts_as_open(problem_types, group)).filter("last_day IS NULL OR first_day <= last_day")
    return held.select(*_KEY, *_VERSION, "first_day", "last_day")


def tickets_near_tower(
    tickets: DataFrame,
    events: DataFrame,
    coords: DataFrame,
    level: Level,
    monitor: Monitor,
    problem_types: Sequence[str] = PROBLEM_TYPES,
    group: str = ASSIGNED_GROUP,
    miles: float = NEAR_MILES,
) -> DataFrame:
    """Open tickets per (tower, event_date, run day), each given to the nearest tower of the cohort within reach.

    Only tickets created on or after the event day count. Which tower of a cohort is nearest does not depend on the
    run day, so that search runs once per ticket position and cohort.
    """
    return spans_near_tower(open_spans(tickets, problem_types, group), events, coords, level, monitor, miles)


def spans_near_tower(spans: DataFrame, events: DataFrame, coords: DataFrame, level: Level, monitor: Monitor, miles: float = NEAR_MILES) -> DataFrame:
    """``tickets_near_tower`` from the spans in which tickets are open."""
    follow = monitor.follow_days
    spans = (
        spans
        .groupBy("create_date", "lat", "lng", "first_day", "last_day")
        .agg(F.expr("count(*) AS n"))
    )
    towers = cohort(events, level).join(coords, level.tower)
    cohort_dates = towers.select("event_date").distinct()  # one row per calendar day at most
    points = spans.selectExpr(
        "lat", "lng", f"explode(sequence(date_sub(create_date, {follow}), create_date)) AS event_date"
    ).join(cohort_dates, "event_date", "left_semi")
    nearest = nearest_within(points, towers, miles, ["event_date"], level.tower)
    # per position, the spans are as many as there are pairs of days, and the cohorts as there are days
    given = (
        spans.join(nearest, ["lat", "lng"])
        .filter(f"create_date BETWEEN event_date AND date_add(event_date, {follow})")
        .selectExpr(
            level.tower, "event_date", "first_day", f"least(last_day, date_add(event_date, {follow})) AS last_day", "n"
        )
        .filter("first_day <= last_day")
    )
    return _per_run_day(given, level, "nrb_ticket_counts")


def _per_run_day(spans: DataFrame, level: Level, name: str) -> DataFrame:
    """Sum ``n`` per (tower, event_date, day); equal spans are added up before they are turned into days."""
    totals = spans.groupBy(level.tower, "event_date", "first_day", "last_day").agg(F.expr("sum(n) AS n"))
    return (
        totals.selectExpr(level.tower, "event_date", "explode(sequence(first_day, last_day)) AS day", "n")
        .groupBy(level.tower, "event_date", "day")
        .agg(F.expr(f"sum(n) AS {name}"))
    )


def tower_of_cell(cell_id: str):
    """Tower part of a cell id, padded."""
    bare = f"if(length({cell_id}) > {LONGEST_TOWER_ID}, substring({cell_id}, 1, length({cell_id}) - {CELL_SUFFIX}), {cell_id})"
    return pad_id(F.expr(bare))


def work_orders_per_tower(orders: DataFrame, events: DataFrame, level: Level, monitor: Monitor) -> DataFrame:
    """Open work orders per (tower, event_date, run day) over the daily partitions ``event_date`` .. run day.

    Per order and status the newest version within those partitions counts, if it starts on or after the event day.
    ``orders`` has noc_id, status, event_start, event_end, cell_id, lat, lng and the partition day ``data_date``.
    A run day without a partition of its own falls back on the day before, also where that precedes the event.
    """
    tower, follow = level.tower, monitor.follow_days
    # only the partitions that a cohort can meet are read
    bounds = cohort(events, level).agg(F.date_sub(F.min("event_date"), 1).alias("first"), F.date_add(F.max("event_date"), follow).alias("last"))
    orders = orders.filter(F.col("data_date").between(bounds.select("first").scalar(), bounds.select("last").scalar()))
    rows = (
        orders.filter(f"lower(status) = '{OPEN}' AND cell_id IS NOT NULL")
        .withColumn(tower, tower_of_cell("cell_id"))
        .selectExpr(
            "noc_id",
            "status",
            "data_date",
            tower,
            "try_cast(substring(event_start, 1, 10) AS date) AS event_start",
            "try_cast(substring(event_end, 1, 10) AS date) AS event_end",
            "try_cast(lat AS double) AS lat",
            "try_cast(lng AS double) AS lng",
        )
    )
    towers = cohort(events, level)
    # cohorts an order can count for: those of the towers it has named; its other versions matter only there
    relevant = (
        lookup_join(rows.select("noc_id", tower, "data_date"), towers, [tower])
        .filter(f"data_date BETWEEN date_sub(event_date, 1) AND date_add(event_date, {follow})")
        .select("noc_id", "event_date")
        .distinct()
    )
    daily = rows.groupBy("noc_id", "status", "data_date").agg(
        F.expr(f"max(struct(event_start, event_end, lat, lng, {tower})) AS v")
    )
    # partitions that stand in for a missing next day: one row per calendar day at most
    loaded = orders.select("data_date").distinct()
    stand_in = loaded.join(
        loaded.selectExpr("date_sub(data_date, 1) AS data_date"), "data_date", "left_anti"
    ).selectExpr("data_date", "true AS stands_in")
    # an order has at most one row per status and day, and one cohort per day
    per_cohort = (
        daily.join(relevant, "noc_id")
        .join(stand_in, "data_date", "left")
        .filter(
            f"data_date BETWEEN event_date AND date_add(event_date, {follow}) "
            "OR (coalesce(stands_in, false) AND data_date = date_sub(event_date, 1))"
        )
    )
    ordered = "PARTITION BY noc_id, status, event_date ORDER BY data_date"
    so_far = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    # a stand-in from before the event serves the event day alone
    states = per_cohort.selectExpr(
        "event_date",
        "greatest(data_date, event_date) AS first_day",
        "data_date < event_date AS early",
        f"if(data_date < event_date, v, max(if(data_date < event_date, NULL, v)) OVER ({ordered} {so_far})) AS v",
        f"lead(data_date) OVER ({ordered}) AS next_day",
    )
    counted = (
        states.selectExpr(
            f"v.{tower} AS {tower}",
            "event_date",
            "first_day",
            f"least(date_sub(next_day, 1), if(early, event_date, date_add(event_date, {follow}))) AS last_day",
            "v.event_start AS event_start",
        )
        .filter("event_start >= event_date AND first_day <= last_day")
        .groupBy(tower, "event_date", "first_day", "last_day")
        .agg(F.expr("count(*) AS n"))
    )
    return _per_run_day(lookup_join(counted, towers, [tower, "event_date"], "left_semi"), level, "w360_ticket_counts")


def ticket_counts(records: DataFrame, level: Level) -> DataFrame:
    """Ready-made counts (enodeb_id, count, day) in the shape the reports join: summed per tower and run day."""
    return (
        records.select(pad_id(F.col("enodeb_id").cast("string")).alias(level.tower), F.col("day").cast("date").alias("day"), "count")
        .groupBy(level.tower, "day")
        .agg(F.sum(F.col("count").cast("long")).alias("nrb_ticket_counts"))
    )
