"""Scoring of rows after an event against the entity's own baseline."""

from __future__ import annotations

from pyspark.sql import DataFrame

from kpi_shift.functions.columns import round_columns, row_sum
from kpi_shift.functions.lookup import lookup_join
from kpi_shift.spec import RISING, Kpi, Level, Monitor


def change_rate(kpi: Kpi) -> str:
    """Relative change, positive when better, clamped at one on the side where the KPI grows."""
    value, avg = kpi.name, kpi.avg
    if kpi.bad == RISING:
        rate = f"try_divide({avg} - {value}, {avg})"
        return f"if({rate} < -1, -1D, {rate})"
    rate = f"try_divide({value} - {avg}, {avg})"
    return f"if({rate} > 1, 1D, {rate})"


def threshold(kpi: Kpi, monitor: Monitor) -> str:
    """The laxer of the percentage and the deviation threshold; the former alone where no deviation is known."""
    sign, laxer = ("+", "greatest") if kpi.bad == RISING else ("-", "least")
    share, spread = f"{monitor.min_change}D * {kpi.avg}", f"{monitor.sigmas}D * {kpi.std}"
    # greatest and least skip nulls
    return f"{laxer}({kpi.avg} {sign} {share}, {kpi.avg} {sign} {spread})"


def alert(kpi: Kpi, monitor: Monitor) -> str:
    if kpi.quiet:
        return "0"
    beyond = ">" if kpi.bad == RISING else "<"
    return f"if({kpi.name} {beyond} {threshold(kpi, monitor)}, 1, 0)"


def score_rows(joined: DataFrame, monitor: Monitor) -> DataFrame:
    """Add change rates, alerts, their count and the abnormal flag to rows that carry KPI values and baseline."""
    scored = joined.selectExpr(
        "*",
        *[f"{change_rate(k)} AS {k.change_rate}" for k in monitor.kpis],
        *[f"{alert(k, monitor)} AS {k.alert}" for k in monitor.kpis],
    )
    count = row_sum(monitor.alerts)
    flags = [f"{count} AS abnormal_kpi", f"if({count} > 0, 1, 0) AS has_abnormal_kpi"]
    return round_columns(scored, monitor.digits).selectExpr("*", *flags)


def score_post_event(
    post_panel: DataFrame,
    baseline: DataFrame,
    level: Level,
    monitor: Monitor,
    summarised: bool = True,
) -> DataFrame:
    """Score each row after an event. Alerts use the unrounded values; values are rounded afterwards.

    ``summarised`` is false for a baseline read from a written table.
    """
    keys = [*level.ids, "event_date"]
    return score_rows(lookup_join(post_panel, baseline, keys, summarised=summarised), monitor)


def zero_override(scored: DataFrame, monitor: Monitor) -> DataFrame:
    """Clear the abnormal flag, not the alert count, of rows whose KPIs are all zero; add ``event_day``."""
    all_zero = " AND ".join(f"{n} = 0" for n in monitor.names)
    flag = f"if({all_zero}, 0, has_abnormal_kpi) AS has_abnormal_kpi"
    return scored.selectExpr(*[flag if c == "has_abnormal_kpi" else c for c in scored.columns], "event_date AS event_day")
