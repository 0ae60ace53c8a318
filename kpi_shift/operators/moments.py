"""Baselines from mergeable daily moments instead of the rows themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpi_shift.functions.columns import row_sum
from kpi_shift.operators.events import cohort
from kpi_shift.functions.lookup import lookup_join
from kpi_shift.spec import Kpi, Level, Monitor

#: Count, mean, and sum of squared distances from the mean of one KPI.
MOMENT = "struct<n:bigint,mean:double,m2:double>"


def daily_moments(panel: DataFrame, level: Level, monitor: Monitor) -> DataFrame:
    """(ids, day, one moment per KPI): the old-set KPIs of an entity's day, as the baseline takes them.

    A day on which one of the entity's rows is silent, all KPIs summing to zero, has no value of any KPI: the silent row is
    nulled and the others are dropped. Its moments are empty, but the row stays, for it makes a baseline exist.
    """
    named = panel.selectExpr(*level.ids, "day", *[f"{k.old} AS {k.name}" for k in monitor.kpis])
    silent = f"max(coalesce({row_sum(monitor.names)} = 0, false)) AS silent"
    moments = [
        F.struct(
            F.count(k.name).alias("n"),
            F.avg(k.name).alias("mean"),
            # the engine's own variance merges partial moments stably
            (F.var_pop(k.name) * F.count(k.name)).alias("m2"),
        ).alias(k.name)
        for k in monitor.kpis
    ]
    daily = named.groupBy(*level.ids, "day").agg(F.expr(silent), *moments)
    empty = F.lit(None).cast(MOMENT)
    return daily.select(*level.ids, "day", *[F.when(~F.col("silent") & (F.col(f"{k.name}.n") > 0), F.col(k.name)).otherwise(empty).alias(k.name) for k in monitor.kpis])


def _merged(days: Column, kpi: Kpi) -> Column:
    """One moment from those of several days: pairwise, in the order of the days, so that the result does not depend on chance."""
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0e0).alias("mean"), F.lit(0e0).alias("m2"))

    def step(a: Column, day: Column) -> Column:
        b = day[kpi.name]
        n = a["n"] + b["n"]
        gap, share = b["mean"] - a["mean"], b["n"] / n
        both = F.struct(n.alias("n"), (a["mean"] + gap * share).alias("mean"), (a["m2"] + b["m2"] + gap * gap * a["n"] * share).alias("m2"))
        return F.when(b.isNull(), a).otherwise(both)

    return F.aggregate(days, start, step)


def baseline_from_moments(moments: DataFrame, events: DataFrame, level: Level, monitor: Monitor) -> DataFrame:
    """``baseline_stats`` of the pre-event panel of all events, from the daily moments of the days before each.

    Per entity and event at most ``baseline_days`` rows meet, one per day, whatever number of rows those days had.
    """
    before = f"day BETWEEN date_sub(event_date, {monitor.baseline_days}) AND date_sub(event_date, 1)"
    rows = lookup_join(moments, cohort(events, level), [level.tower]).filter(before)
    days = rows.groupBy(*level.ids, "event_date").agg(F.sort_array(F.collect_list(F.struct("day", *monitor.names))).alias("days"))
    merged = days.select(*level.ids, "event_date", *[_merged(F.col("days"), k).alias(k.name) for k in monitor.kpis])
    digits = monitor.digits
    return merged.selectExpr(
        *level.ids,
        "event_date",
        *[f"round(if({k.name}.n > 0, {k.name}.mean, NULL), {digits}) AS {k.avg}" for k in monitor.kpis],
        *[f"round(if({k.name}.n > 1, sqrt({k.name}.m2 / ({k.name}.n - 1)), NULL), {digits}) AS {k.std}" for k in monitor.kpis],
    )
