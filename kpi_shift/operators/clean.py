"""Cleaning of raw daily KPI rows, vendor activity, silent rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpi_shift.functions.columns import add_missing, cast_columns, pad_id, row_sum
from kpi_shift.functions.dates import parse_day
from kpi_shift.functions.lookup import lookup_join
from kpi_shift.spec import Level, Monitor

# Id that stands for "all towers", sector that stands for "no sector", day format of the files.
WILDCARD_ID = "*"
NO_SECTOR = "0"
RAW_DAY_FORMAT = "MM/dd/yyyy"


def clean_rows(
    raw: DataFrame,
    tower: str,
    numeric: Sequence[str],
    late_columns: Sequence[str] = (),
    site: str = "site",
    day: str = "day",
    day_format: str = RAW_DAY_FORMAT,
) -> DataFrame:
    """Typed, distinct rows from all-text daily rows.

    Wildcard and null ids go, short ids are padded, ``day`` becomes a date, ``numeric`` become doubles (null when they
    do not parse), ``late_columns`` absent from the input are added as 0. Rows that differ only in the spelling of
    ``site`` collapse to the greatest spelling: of a name and its truncated form that is the whole one.
    """
    kept = raw.filter((F.col(tower) != WILDCARD_ID) & F.col(tower).isNotNull())
    typed = cast_columns(kept, numeric).withColumns({tower: pad_id(tower), day: parse_day(day, day_format)})
    complete = add_missing(typed, {c: F.lit(0e0) for c in late_columns})
    if site not in complete.columns:
        return complete.distinct()
    # grouping by every other column also removes exact copies, so no separate distinct is needed
    others = [F.col(f"`{c}`") for c in complete.columns if c != site]
    return complete.groupBy(*others).agg(F.max(site).alias(site)).select(*[f"`{c}`" for c in complete.columns])


def clean_kpis(raw: DataFrame, level: Level, monitor: Monitor) -> DataFrame:
    """``clean_rows`` for a daily KPI table whose headers are already mapped to panel names."""
    rows = raw
    if len(level.ids) > 1:
        rows = rows.filter(F.col(level.ids[1]) != NO_SECTOR)
    return clean_rows(rows, level.tower, monitor.panel_columns, monitor.shared_columns)


def vendor_activity(panel: DataFrame, monitor: Monitor) -> DataFrame:
    """Add the row sums of the old and of the new KPI set; null when one KPI of the set is null."""
    old, new = row_sum(monitor.old_columns), row_sum(monitor.new_columns)
    return panel.selectExpr("*", f"{old} AS old_activity", f"{new} AS new_activity")


def silent_to_null(
    rows: DataFrame,
    kpis: Sequence[str],
    keys: Sequence[str],
    spread: Callable[[DataFrame], DataFrame] | None = None,
    within: Sequence[str] = (),
) -> DataFrame:
    """Null the ``kpis`` of rows where they sum to zero; drop the other rows under the key of such a row.

    The keys of silent rows are few and are aggregated before they meet the rows, so no task ever holds a key's rows
    as a group. ``rows`` is evaluated twice for that: have it written (``stage``) where it is costly. A null key equals
    no other, so rows under it are judged one by one. ``spread`` may copy the silent keys to every value of the columns ``within`` that
    the rows are stored by; the join is then by those too.
    """
    silent = f"coalesce({row_sum(kpis)} = 0, false)"
    silent_keys = rows.filter(silent).select(*keys).distinct().selectExpr("*", "true AS key_silent")
    if spread is not None:
        silent_keys = spread(silent_keys)
    marked = lookup_join(rows, silent_keys, [*keys, *within], "left", summarised=not within)
    return marked.filter(f"key_silent IS NULL OR {silent}").selectExpr(
        *[f"if({silent}, NULL, `{c}`) AS `{c}`" if c in kpis else f"`{c}`" for c in rows.columns]
    )
