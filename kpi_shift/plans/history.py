"""A kept history of trouble tickets: daily files extend it, and reports read what was open in their range.

Tables, partitioned by the first day of the run that wrote them (``kept``):

* ``current``: versions that hold at the end of a run; every run writes the whole of it, it has one row per open (ticket, status);
* ``spans``: versions that ended in a run, with their first and last day;
* ``closed``: ids of the tickets that a run saw closed; a closed ticket never opens again;
* ``runs``: one row per run, written last. What a run without such a row has written is not read, and goes when it is done again.

A run reads its own days, the newest ``current``, and which of its tickets are in ``closed``; the spans of the past are not
touched. Running a day again rewinds the history to the day before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpi_shift.functions.stage import stage
from kpi_shift.operators.tickets import OPEN, counting_spans, known_versions, version_spans
from kpi_shift.sources.sinks import drop_partitions, read_partitions, table_exists, write_partitions

CURRENT, SPANS, CLOSED, RUNS, KEPT = "current", "spans", "closed", "runs", "kept"
_KEY = ["trouble_id", "status"]
_VALUES = ["modified_date", "create_date", "lat", "lng", "problem_type", "assigned_group"]


def _run_before(spark: SparkSession, path: str, day: str, inclusive: bool = False) -> str | None:
    """The newest finished run that began before a day; one row per run is looked at."""
    if not table_exists(spark, f"{path}/{RUNS}"):
        return None
    runs = read_partitions(spark, f"{path}/{RUNS}").filter(f"{KEPT} {'<=' if inclusive else '<'} DATE'{day}'")
    found = runs.agg(F.max(KEPT)).first()[0]
    return None if found is None else found.isoformat()


def advance_tickets(tickets: DataFrame, path: str, start: str, end: str) -> None:
    """Extend the history at ``path`` by the versions that become known from ``start`` until ``end`` (exclusive).

    A version becomes known on the later of its days of creation and modification. Runs follow each other in time; one that
    starts before the newest kept run replaces it and all that came after. The result is that of one pass over all versions.
    """
    spark = tickets.sparkSession
    for table in (RUNS, CURRENT, SPANS, CLOSED):
        if table_exists(spark, f"{path}/{table}"):
            drop_partitions(spark, f"{path}/{table}", KEPT, start)
    new = known_versions(tickets).filter(f"first_day >= DATE'{start}' AND first_day < DATE'{end}'")
    last = _run_before(spark, path, start)
    rows = new
    if last is not None:
        ids = read_partitions(spark, f"{path}/{CLOSED}").filter(f"{KEPT} <= DATE'{last}'").select(F.col("trouble_id").alias("closed_id"))
        new = new.join(ids, F.col("trouble_id").eqNullSafe(F.col("closed_id")), "left_anti")
        held = read_partitions(spark, f"{path}/{CURRENT}").filter(f"{KEPT} = DATE'{last}'").select(*_KEY, "first_day", F.struct(*_VALUES).alias("v"))
        rows = new.unionByName(held)
    spans = stage(version_spans(rows).withColumn(KEPT, F.lit(start).cast("date")), "spans")
    # a status that is not "open" closes its ticket, a null one does nothing
    is_open = F.lower("status") == OPEN
    real = spans.filter(is_open).filter("last_day IS NULL OR first_day <= last_day").drop("closed_day")
    _write(real.filter("last_day IS NOT NULL"), f"{path}/{SPANS}")
    _write(spans.filter("closed_day IS NOT NULL").select("trouble_id", KEPT).distinct(), f"{path}/{CLOSED}")
    _write(real.filter("last_day IS NULL").drop("last_day"), f"{path}/{CURRENT}")
    _write(spark.range(1).select(F.lit(end).cast("date").alias("until"), F.lit(start).cast("date").alias(KEPT)), f"{path}/{RUNS}")


def _write(rows: DataFrame, path: str) -> None:
    write_partitions(rows, path, [KEPT])


def kept_spans(spark: SparkSession, path: str, start: str | None = None, **wanted) -> DataFrame:
    """``open_spans`` of the tickets taken in so far: the spans that last until ``start`` or longer, and all that have not ended.

    Runs before ``start`` ended no such span on or after their own days, so their partitions are not read. ``wanted`` goes to ``counting_spans``.
    """
    last = _run_before(spark, path, "9999-12-31") or "0001-01-01"
    current = read_partitions(spark, f"{path}/{CURRENT}").filter(f"{KEPT} = DATE'{last}'").withColumn("last_day", F.lit(None).cast("date"))
    ended = read_partitions(spark, f"{path}/{SPANS}").filter(f"{KEPT} <= DATE'{last}'")
    if start is not None:
        # a span ends the day before the version that ends it: in the days of the run that wrote it, or the day before
        first = _run_before(spark, path, start, inclusive=True) or "0001-01-01"
        ended = ended.filter(f"{KEPT} >= DATE'{first}' AND last_day >= DATE'{start}'")
    columns = [*_KEY, *_VALUES, "first_day", "last_day"]
    return counting_spans(ended.select(columns).unionByName(current.select(columns)), **wanted)
