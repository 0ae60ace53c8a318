"""Are the daily tables there, fresh and without holes?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Length of the audited window, and the delay of a table that names none.
AUDIT_DAYS = 20
EXPECTED_DELAY = 1

EXPECTED_TABLES = "table_name string, delay_days int, weekdays_only boolean"


def _due(expected: DataFrame, as_of: str) -> DataFrame:
    """Expected tables with the newest day that each should hold by now."""
    delay = F.coalesce("delay_days", F.lit(EXPECTED_DELAY))
    return expected.select("table_name", "weekdays_only", F.date_sub(F.lit(as_of).cast("date"), delay).alias("expected_day"))


def table_freshness(loads: DataFrame, expected: DataFrame, as_of: str) -> DataFrame:
    """Latest loaded day of each expected table and by how many days it is behind; both null if it never loaded.

    ``expected`` has (table_name, delay_days, weekdays_only), one row per table. Loads of other tables are not looked at.
    """
    latest = loads.groupBy("table_name").agg(F.max("day").alias("latest_day"))
    return _due(expected, as_of).join(latest, "table_name", "left").select(
        "table_name", "latest_day", "expected_day", F.datediff("expected_day", "latest_day").alias("delayed_days")
    )


def missing_days(loads: DataFrame, expected: DataFrame, as_of: str, holidays: Sequence[str], window: int = AUDIT_DAYS) -> DataFrame:
    """(table_name, day) of the ``window`` days up to a table's expected day that were not loaded.

    Tables marked ``weekdays_only`` are not expected at weekends and on ``holidays``.
    """
    wanted = _due(expected, as_of).select(
        "table_name", "weekdays_only", F.explode(F.sequence(F.date_sub("expected_day", window - 1), "expected_day")).alias("day")
    )
    working = (F.weekday("day") < 5) & ~F.col("day").cast("string").isin(*holidays)
    wanted = wanted.filter(~F.coalesce("weekdays_only", F.lit(False)) | working).select("table_name", "day")
    # what lies before every table's window cannot matter
    oldest = _due(expected, as_of).agg(F.date_sub(F.min("expected_day"), window - 1)).scalar()
    in_window = loads.filter(F.col("day") >= oldest).select("table_name", "day").distinct()
    return wanted.join(in_window, ["table_name", "day"], "left_anti")


def rows_per_day(df: DataFrame, day: str, newest: int = 1) -> DataFrame:
    """Row count of the newest days."""
    return df.groupBy(F.col(day).cast("date").alias("day")).agg(F.count("*").alias("row_count")).orderBy(F.desc("day")).limit(newest)


def latest_days(df: DataFrame, day: str, newest: int = AUDIT_DAYS) -> DataFrame:
    """The newest distinct days."""
    return df.select(F.col(day).cast("date").alias("day")).distinct().orderBy(F.desc("day")).limit(newest)


def completeness_report(loads: DataFrame, expected: DataFrame, as_of: str, holidays: Sequence[str], window: int = AUDIT_DAYS) -> DataFrame:
    """One row per expected table: freshness, missing days of the window, and whether all tables are on time.

    A table that never loaded misses every day, and then not all are on time.
    """
    # one pass over the loads: each table's latest day, and its days of the window, at most `window` of them
    due = _due(expected, as_of)
    in_window = F.col("day").between(F.date_sub("expected_day", window - 1), F.col("expected_day"))
    seen = (
        loads.join(due.select("table_name", "expected_day"), "table_name")
        .groupBy("table_name")
        .agg(F.max("day").alias("latest_day"), F.collect_set(F.when(in_window, F.col("day"))).alias("days"))
    )
    wanted = F.sequence(F.date_sub("expected_day", window - 1), F.col("expected_day"))

    def is_missing(day: Column) -> Column:
        working = (F.weekday(day) < 5) & ~day.cast("string").isin(*holidays)
        loaded = F.coalesce(F.array_contains("days", day), F.lit(False))
        return (~F.coalesce("weekdays_only", F.lit(False)) | working) & ~loaded

    report = due.join(seen, "table_name", "left").select(
        "table_name",
        "latest_day",
        "expected_day",
        F.datediff("expected_day", "latest_day").alias("delayed_days"),
        F.filter(wanted, is_missing).alias("missing_days"),
    )
    on_time = F.bool_and(F.coalesce(F.col("delayed_days") == 0, F.lit(False)))
    # one row per expected table
    return report.withColumn("all_on_time", on_time.over(Window.partitionBy(F.lit(0))))


def combined_completeness(reports: dict[str, DataFrame]) -> DataFrame:
    """Reports of several sides, such as tables in the store and dated files, next to each other in the column ``side``."""
    sides = [report.select(F.lit(side).alias("side"), "*") for side, report in reports.items()]
    merged = sides[0]
    for other in sides[1:]:
        merged = merged.unionByName(other)
    return merged
