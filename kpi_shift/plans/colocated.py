"""The panel in catalog buckets by tower: joins on the tower read it where it lies.

A bucketed table is partitioned by day and bucketed by (tower, part). Event lists, silent keys and baselines are small beside it; they
are shuffled to its buckets, and the panel itself never is. Buckets cannot be split at run time as shuffle partitions can, so a tower
with more rows than an even bucket holds is split when it is written: its rows are dealt over several parts, and a
lookup meets each part with a copy of the tower's rows. Towers that need parts are fewer than buckets, so their list
is small by construction.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpi_shift.functions.stage import stage
from kpi_shift.operators.clean import silent_to_null
from kpi_shift.operators.events import cohort, detect_events
from kpi_shift.operators.panels import baseline_stats, post_event_columns, pre_event_columns
from kpi_shift.operators.score import score_rows
from kpi_shift.plans.monitoring import Run
from kpi_shift.spec import Level, Monitor

PART = "part"
#: A bucketed side keeps its partitioning for joins on more keys than its own.
JOIN_SETTINGS = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.sources.bucketing.enabled": "true"}


@dataclass(frozen=True)
class Colocated:
    """A bucketed panel table of the catalog, and the towers that are split: (tower, parts), fewer than there are buckets."""

    table: str
    parts: DataFrame
    level: Level
    buckets: int

    def panel(self) -> DataFrame:
        return self.parts.sparkSession.table(self.table)

    def spread(self, lookup: DataFrame) -> DataFrame:
        """The rows of a lookup once for each part of their tower."""
        tower = self.level.tower
        joined = lookup.join(F.broadcast(self.parts), tower, "left")  # fewer rows than buckets
        last = F.coalesce("parts", F.lit(1)) - 1
        return joined.withColumn(PART, F.explode(F.sequence(F.lit(0), last))).drop("parts")


@contextmanager
def settings(spark: SparkSession, pairs: Mapping[str, str]) -> Iterator[None]:
    """SQL settings for what is run inside."""
    before = {key: spark.conf.get(key, None) for key in pairs}
    for key, value in pairs.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot_towers(panel: DataFrame, level: Level, buckets: int) -> DataFrame:
    """(tower, parts) of the towers with more rows than an even share of a bucket; fewer than ``buckets``."""
    counts = panel.groupBy(level.tower).agg(F.count("*").alias("n"))
    share = F.ceil(panel.agg(F.count("*")).scalar() / buckets)
    return counts.where((F.col("n") > share) & F.col(level.tower).isNotNull()).select(level.tower, F.ceil(F.col("n") / share).cast("int").alias("parts"))


def _dealt(panel: DataFrame, parts: DataFrame, level: Level) -> DataFrame:
    """Rows with their part: dealt evenly over the parts of their tower."""
    joined = panel.join(F.broadcast(parts), level.tower, "left")
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in panel.columns]), F.col("parts")).cast("int")
    return joined.withColumn(PART, F.coalesce(spread, F.lit(0))).drop("parts")


def write_colocated(panel: DataFrame, table: str, path: str, level: Level, buckets: int) -> Colocated:
    """Store a panel as the catalog table ``table`` at ``path``, partitioned by day, in ``buckets`` by tower; one file per day and bucket."""
    parts = stage(hot_towers(panel, level, buckets), "parts")
    rows = _dealt(panel, parts, level).select(*[c for c in panel.columns if c != "day"], PART, "day")
    writer = rows.repartition(buckets, level.tower, PART).write.mode("overwrite").format("parquet").option("path", path)
    writer.partitionBy("day").bucketBy(buckets, level.tower, PART).sortBy(level.tower).saveAsTable(table)
    return Colocated(table, parts, level, buckets)


def replace_days(rows: DataFrame, stored: Colocated) -> None:
    """Replace the days that ``rows`` holds. Towers keep their parts; one that has become hot since is split by the next whole write."""
    spark = rows.sparkSession
    dealt = _dealt(rows, stored.parts, stored.level).select(*spark.table(stored.table).columns)
    with settings(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        dealt.repartition(stored.buckets, stored.level.tower, PART).write.insertInto(stored.table, overwrite=True)


def join_colocated(rows: DataFrame, lookup: DataFrame, stored: Colocated, keys: Sequence[str]) -> DataFrame:
    """Join rows of the bucketed table, which stay where they are, with a lookup by ``keys``, the tower first."""
    return rows.join(stored.spread(lookup), [*keys, PART])


def rows_around_colocated(stored: Colocated, events: DataFrame, first: int, last: int, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows of event towers on the days ``event_date + first`` .. ``event_date + last``, with ``event_date`` and their part.

    ``start`` and ``end`` (exclusive) bound the run days.
    """
    panel = stored.panel()
    if start is not None:
        panel = panel.filter(f"day >= date_add(DATE'{start}', {min(first, 0)})")
    if end is not None:
        panel = panel.filter(f"day < DATE'{end}'")
    near = f"day BETWEEN date_add(event_date, {first}) AND date_add(event_date, {last})"
    return join_colocated(panel, cohort(events, stored.level), stored, [stored.level.tower]).filter(near)


def _heard(rows: DataFrame, kpis: Sequence[str], stored: Colocated) -> DataFrame:
    """``silent_to_null`` by entity and day: a split tower's silent rows count for all its parts."""
    return silent_to_null(rows, kpis, ["event_date", "day", *stored.level.ids], spread=stored.spread, within=[PART])


def monitor_colocated(stored: Colocated, monitor: Monitor, events: DataFrame | None = None) -> Run:
    """``monitor_panel`` on a bucketed panel: the same tables, without a shuffle of panel rows in any of its joins.

    Pre-event panel, baseline and scores are written to the shared folder here, since the joins need ``JOIN_SETTINGS`` when they are planned.
    """
    spark, level = stored.parts.sparkSession, stored.level
    carrying = replace(monitor, categorical=(*monitor.categorical, PART))
    with settings(spark, JOIN_SETTINGS):
        if events is None:
            events = detect_events(stored.panel(), level, monitor)
        events = stage(cohort(events, level), "events")
        pre = pre_event_columns(rows_around_colocated(stored, events, -monitor.baseline_days, -1), level, carrying)
        pre_panel = stage(_heard(pre, monitor.names, stored), "pre_panel")
        baseline = stage(baseline_stats(pre_panel, level, monitor), "baseline")
        scored = stage(score_colocated(stored, events, baseline, monitor), "scored")
    return Run(events, pre_panel.drop(PART), baseline, scored)


def score_colocated(stored: Colocated, events: DataFrame, baseline: DataFrame, monitor: Monitor) -> DataFrame:
    """Scores of all cohorts against their baseline; plan it under ``JOIN_SETTINGS``."""
    level = stored.level
    carrying = replace(monitor, categorical=(*monitor.categorical, PART))
    post = post_event_columns(rows_around_colocated(stored, events, 0, monitor.follow_days), level, carrying)
    heard = _heard(post, [k.name for k in monitor.kpis if not k.shared], stored)
    return score_rows(join_colocated(heard, baseline, stored, [*level.ids, "event_date"]).drop(PART), monitor)
