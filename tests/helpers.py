"""Small panels and comparisons."""

from __future__ import annotations

from datetime import date, timedelta

from kpi_shift.spec import Monitor

MONITOR = Monitor()
DAY0 = date(2024, 1, 1)
PANEL_SCHEMA = "tower string, day date, site string, " + ", ".join(f"`{c}` double" for c in MONITOR.panel_columns)


def day(n: int) -> date:
    return DAY0 + timedelta(days=n)


def panel_row(tower, n, old=0.0, new=0.0, shared=1.0, site="S", **override):
    """A row whose old, new and shared KPIs all have the given values; ``override`` sets single columns."""
    values = {c: old for c in MONITOR.old_columns} | {c: new for c in MONITOR.new_columns}
    values |= {c: shared for c in MONITOR.shared_columns} | override
    return (tower, day(n), site, *[values[c] for c in MONITOR.panel_columns])


def panel(spark, rows):
    return spark.createDataFrame(rows, PANEL_SCHEMA)


def as_set(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect() if columns else df.collect()), key=repr)


def final_plan(df) -> str:
    """The adaptive plan after running."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
