"""Documents and messages for consumers outside."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpi_shift.spec import Level, Monitor

# Field names of the documents that differ from the report columns, and the score limit.
DOCUMENT_NAMES = {"tower": "enodeb", "day": "alert_day", "abnormal_kpi": "abnormal_kpi_count"}
COUNT_COLUMNS = ("nrb_ticket_counts", "w360_ticket_counts")
LOW_SCORE = 85


def alert_documents(
    report: DataFrame,
    level: Level,
    monitor: Monitor,
    link: str,
    constants: Mapping[str, str] | None = None,
    carried: tuple[str, ...] = ("site", "region"),
) -> DataFrame:
    """One row per abnormal tower row.

    ``features`` maps the alerting KPIs, and only those, to their values; ``features_alert`` holds the flags of all KPIs.
    ``link`` is prefixed to the id; ``constants`` adds fixed fields such as the vendor.
    """
    abnormal = report.filter(F.col("has_abnormal_kpi") == 1)
    pairs = F.array(*[F.struct(F.lit(k.name).alias("key"), F.col(k.name).cast("double").alias("value"), F.col(k.alert).alias("flag")) for k in monitor.kpis])
    alerting = F.map_from_entries(F.transform(F.filter(pairs, lambda p: p["flag"] != 0), lambda p: F.struct(p["key"], p["value"])))
    flags = F.struct(*[F.col(k.alert) for k in monitor.kpis])

    def named(column: str) -> Column:
        return F.col(column).alias(DOCUMENT_NAMES.get(column, column))

    plain = [level.tower, "day", "event_day", *carried, "abnormal_kpi", *COUNT_COLUMNS]
    return abnormal.select(
        *[named(c) for c in plain],
        *[F.lit(v).alias(c) for c, v in (constants or {}).items()],
        alerting.alias("features"),
        flags.alias("features_alert"),
        F.concat(F.lit(link), F.col(level.tower)).alias("link"),
    )


def as_messages(df: DataFrame) -> DataFrame:
    """Each row as one JSON text in the column ``value``."""
    return df.select(F.to_json(F.struct("*")).alias("value"))


def low_score_messages(scores: DataFrame, column: str, limit: float = LOW_SCORE) -> DataFrame:
    """Rows that score below ``limit``, as messages."""
    return as_messages(scores.filter(F.col(column) < limit))
