"""Inventory lookups and the published reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpi_shift.functions.columns import lower_names, pad_id, round_columns
from kpi_shift.functions.lookup import lookup_join
from kpi_shift.operators.clean import NO_SECTOR
from kpi_shift.spec import Level

REPORT_DIGITS = 4


def tower_coords(inventory: DataFrame, level: Level) -> DataFrame:
    """One position per tower: of several, the greatest (latitude, longitude). Incomplete rows are skipped."""
    whole = inventory.filter(f"latitude IS NOT NULL AND longitude IS NOT NULL AND {level.tower} IS NOT NULL")
    position = "struct(try_cast(latitude AS double) AS latitude, try_cast(longitude AS double) AS longitude)"
    return (
        whole.groupBy(pad_id(level.tower).alias(level.tower))
        .agg(F.expr(f"max({position}) AS p"))
        .select(level.tower, "p.*")
    )


def sector_azimuth(inventory: DataFrame, level: Level) -> DataFrame:
    """Distinct (ids, azimuth) at sector or carrier level. An entity with several azimuths keeps them all."""
    return inventory.select(
        pad_id(level.tower).alias(level.tower), *level.ids[1:], "azimuth_deg"
    ).distinct()


def tower_report(
    scored: DataFrame,
    coords: DataFrame,
    near_tickets: DataFrame,
    work_orders: DataFrame,
    level: Level,
    digits: int = REPORT_DIGITS,
) -> DataFrame:
    """All scored rows with position and both ticket counts; what has no match stays null.

    The count tables are joined on the tower and those of event_date and day they have.
    """
    report = lookup_join(scored, coords, [level.tower], "left", summarised=True)
    for counts in (near_tickets, work_orders):
        keys = [c for c in (level.tower, "event_date", "day") if c in counts.columns]
        report = lookup_join(report, counts, keys, "left", summarised=True)
    return lower_names(round_columns(report, digits))


def entity_report(
    scored: DataFrame,
    azimuths: DataFrame,
    level: Level,
    digits: int = REPORT_DIGITS,
) -> DataFrame:
    """All scored sector or carrier rows with azimuth, distinct, without the placeholder sector."""
    joined = lookup_join(scored, azimuths, level.ids, "left")
    report = lower_names(round_columns(joined, digits))
    return report.fillna({"rtp_gap_change_rate": 0}).filter(F.col(level.ids[1]) != NO_SECTOR).distinct()
