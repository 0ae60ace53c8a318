"""Alerts of a stream that a later row may withdraw: state by entity, event and day.

A silent row makes all other rows under its key count as silent. Where rows come one by one, the rule can strike after an
alert went out. So each key remembers what it last sent: a change goes out when a greater abnormal row comes (raise), or
when a silent row leaves no alert (withdraw). Changes are appended; ``standing_alerts`` reads what they amount to, which
is the batch result in whatever order the rows came.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import BooleanType, StructField, StructType

from kpi_shift.functions.columns import row_sum
from kpi_shift.operators.score import score_rows
from kpi_shift.sources.sinks import read_partitions, write_partitions
from kpi_shift.spec import Level, Monitor
from kpi_shift.streaming.scoring import BATCH

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
KEEP_DAYS = 45
SILENT, WITHDRAWN, MOMENT, EXPIRY = "row_silent", "withdrawn", "moment", "expiry_ms"


def _order(values: Sequence) -> tuple:
    """Rows in Spark's order of structs: nulls first."""
    return tuple((v is not None, v) for v in values)


class AlertChanges(StatefulProcessor):
    """Per key: whether a silent row was seen, and the alert that stands, if any.

    A key's rows are streamed and only the greatest abnormal one is held, so a hot key needs no more memory than another.
    """

    def __init__(self, keys: Sequence[str], values: StructType):
        self.keys, self.values = list(keys), values

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        flags = [StructField("silent", BooleanType()), StructField("raised", BooleanType())]
        self.known = handle.getValueState("known", StructType(flags + self.values.fields))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        names = self.values.names
        known = self.known.get() if self.known.exists() else None
        silent, before = (bool(known[0]), tuple(known[2:]) if known[1] else None) if known is not None else (False, None)
        best = before
        for i, row in enumerate(rows):
            if known is None and not i:
                self.handle.registerTimer(row[EXPIRY])
            if row[SILENT] and not silent:
                silent, best = True, None
            if row["has_abnormal_kpi"] == 1 and row[SILENT] == silent:
                values = tuple(row[n] for n in names)
                if best is None or _order(values) > _order(best):
                    best = values
        self.known.update((silent, best is not None, *(best or (None,) * len(names))))
        if best != before:
            change = (*key, best is None, *(best or (None,) * len(names)))
            yield Row(**dict(zip([*self.keys, WITHDRAWN, *names], change, strict=True)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.known.clear()
        return iter(())

    def close(self) -> None:
        pass


def alert_changes(rows: DataFrame, baseline: DataFrame, level: Level, monitor: Monitor, keep_days: int = KEEP_DAYS) -> DataFrame:
    """A stream of KPI rows as a stream of changes: keys, ``withdrawn`` and the alert's columns.

    Rows may come up to ``keep_days`` behind the newest day seen; a timer per key frees its state when none can come any more,
    and later rows are dropped (``score_stream`` scores rows of any age, but never withdraws). Rows without an id or a day
    meet no baseline and give nothing; repeated rows change nothing. ``baseline`` is a written table, read as it was when the
    stream started.
    """
    keys = [*level.ids, "event_date", "day"]
    unshared = [k.name for k in monitor.kpis if not k.shared]
    named = rows.selectExpr(
        *level.ids, "day", *[c for c in monitor.categorical if c in rows.columns], *[f"{k.new} AS {k.name}" for k in monitor.kpis]
    )
    marked = named.selectExpr("*", f"coalesce({row_sum(unshared)} = 0, false) AS {SILENT}").selectExpr(
        *[f"if({SILENT}, NULL, {c}) AS {c}" if c in unshared else c for c in named.columns], SILENT
    )
    marked = marked.selectExpr("*", f"cast(day AS timestamp) AS {MOMENT}").withWatermark(MOMENT, f"{keep_days} days")
    in_time = F.datediff("day", "event_date").between(0, monitor.follow_days)
    scored = score_rows(marked.join(baseline, list(level.ids)).filter(in_time), monitor)
    # of the rows that are not silent only abnormal ones matter
    scored = scored.filter(f"{SILENT} OR has_abnormal_kpi = 1")
    # a withdrawal has no values
    values = StructType([StructField(f.name, f.dataType) for f in scored.schema.fields if f.name not in (*keys, SILENT, MOMENT)])
    # a day after the watermark has passed the key's day
    scored = scored.selectExpr("*", f"unix_millis({MOMENT}) + 86400000 AS {EXPIRY}")
    out = StructType([*(scored.schema[k] for k in keys), StructField(WITHDRAWN, BooleanType()), *values.fields])
    return scored.groupBy(*keys).transformWithState(AlertChanges(keys, values), out, "Update", "EventTime")


def alert_change_stream(
    rows: DataFrame,
    baseline: DataFrame,
    out: str,
    progress: str,
    level: Level,
    monitor: Monitor,
    once: bool = False,
    keep_days: int = KEEP_DAYS,
) -> StreamingQuery:
    """Append the changes of a stream of KPI rows to the table ``out``, which ``standing_alerts`` reads.

    Each batch writes partitions of its own, so one repeated after a failure replaces what it wrote; a key changes at most
    once a batch. State is kept in RocksDB, on as many partitions as ``spark.sql.shuffle.partitions`` says at the first start.
    """
    spark = rows.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        write_partitions(batch.withColumn(BATCH, F.lit(number).cast("long")), out, ["day", BATCH])

    writer = alert_changes(rows, baseline, level, monitor, keep_days).writeStream.outputMode("update").foreachBatch(write)
    writer = writer.option("checkpointLocation", progress)
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:  # a query keeps the settings of its start
        return (writer.trigger(availableNow=True) if once else writer).start()
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def standing_alerts(spark: SparkSession, out: str, level: Level) -> DataFrame:
    """The alerts that stand: the last change of each key, if that is no withdrawal. Filters on ``day`` prune partitions."""
    changes = read_partitions(spark, out)
    keys = [*level.ids, "event_date", "day"]
    rest = [c for c in changes.columns if c not in (*keys, BATCH)]
    last = changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), BATCH).alias("change")).filter(f"NOT change.{WITHDRAWN}")
    return last.select(*[F.col(c) if c in keys else F.col(f"change.{c}").alias(c) for c in changes.columns if c not in (BATCH, WITHDRAWN)])
