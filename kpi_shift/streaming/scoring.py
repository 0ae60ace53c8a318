"""Scoring of KPI rows as they arrive."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kpi_shift.functions.columns import row_sum
from kpi_shift.operators.score import score_rows
from kpi_shift.sources.sinks import read_partitions, table_exists, write_partitions
from kpi_shift.spec import Level, Monitor

BATCH = "batch"


def alerts_of(rows: DataFrame, baseline: DataFrame, level: Level, monitor: Monitor) -> DataFrame:
    """Abnormal rows of a batch of KPI rows against the baselines of their entities, however old their days are.

    The silent test looks at each row alone: what already went out cannot be withdrawn when a silent row of the same key
    follows.
    """
    silent = f"coalesce({row_sum(monitor.new_columns)} = 0, false)"
    heard = rows.selectExpr(
        *level.ids,
        "day",
        *[c for c in monitor.categorical if c in rows.columns],
        *[f"{k.new} AS {k.name}" if k.shared else f"if({silent}, NULL, {k.new}) AS {k.name}" for k in monitor.kpis],
    )
    in_time = F.datediff("day", "event_date").between(0, monitor.follow_days)
    scored = score_rows(heard.join(baseline, list(level.ids)).filter(in_time), monitor)
    return scored.filter(F.col("has_abnormal_kpi") == 1)


def score_stream(
    rows: DataFrame, baseline: Callable[[], DataFrame], out: str, progress: str, level: Level, monitor: Monitor, once: bool = False
) -> StreamingQuery:
    """Append the alerts of a stream of KPI rows to the table ``out``, each (entity, event, day) once.

    ``baseline`` is called for every micro-batch, so events found meanwhile count for the rows that follow. Rows may be
    of any age: what has been raised is known from ``out`` itself, pruned to the days of the batch, not from a window of
    state. Each batch writes its own partition, so a batch that is repeated after a failure replaces what it wrote.
    ``read_alerts`` reads the table.
    """
    keys = [*level.ids, "event_date", "day"]

    def score(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        # the days of one batch are few
        days = sorted(r.day for r in batch.select("day").distinct().collect() if r.day is not None)
        if not days:
            return
        first = days[0] - timedelta(days=monitor.follow_days)
        found = alerts_of(batch, baseline().filter(F.col("event_date").between(first, days[-1])), level, monitor)
        # of several abnormal rows of a key the greatest counts, so a repeated batch writes the same ones
        rest = [c for c in found.columns if c not in keys]
        found = found.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("row")).select(*[F.col(f"row.{c}").alias(c) if c in rest else F.col(c) for c in found.columns])
        found = found.withColumn(BATCH, F.lit(number).cast("long"))
        if table_exists(spark, out):
            known = read_partitions(spark, out).filter((F.col(BATCH) != number) & F.col("day").isin(days))
            found = found.join(known.select(*keys), keys, "left_anti")
        write_partitions(found, out, ["day", BATCH])

    writer = rows.writeStream.foreachBatch(score).option("checkpointLocation", progress)
    return (writer.trigger(availableNow=True) if once else writer).start()


def read_alerts(spark: SparkSession, out: str) -> DataFrame:
    """The alerts raised so far."""
    return read_partitions(spark, out).drop(BATCH)

