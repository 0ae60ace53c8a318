"""Shape of the plans: no cross joins, no Python, hot keys split, scans pruned."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks.fixtures import derived
from checks.queries import QUERIES
from kpi_shift.functions.nearest import nearest_within
from kpi_shift.functions.stage import shared_folder, stage
from kpi_shift.operators import clean, events, panels, score, tickets
from kpi_shift.plans.monitoring import monitor_panel, score_range
from kpi_shift.spec import TOWER
from tests.helpers import MONITOR, as_set, day, final_plan, panel, panel_row, plan_of

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast_small_splits(settings):
    """Make small data look large: joins sort and merge, and a few kilobytes count as skewed."""
    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__advisoryPartitionSizeInBytes="4KB",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="8KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__coalescePartitions__enabled="false",
    )


@pytest.fixture
def hot(spark):
    """Half of all rows belong to one tower, in eight input partitions."""
    rows = [panel_row("hot", n, old=1.0, site=f"S{i}", old_dl_data_volume=float(i)) for n in range(6, 20) for i in range(150)]
    rows += [panel_row("hot", 20, new=2.0, site=f"S{i}") for i in range(150)]
    for t in range(100):
        rows += [panel_row(f"t{t:03d}", n, old=1.0) for n in range(6, 20)] + [panel_row(f"t{t:03d}", 20, new=2.0)]
    return stage(panel(spark, rows).repartition(8, "day", "site"), "hot")


def test_hot_tower_is_split(spark, hot, no_broadcast_small_splits):
    found = stage(events.detect_events(hot, TOWER, MONITOR), "events")
    assert found.count() == 101
    plan = final_plan(events.rows_around(hot, found, TOWER, -14, -1))
    assert "SortMergeJoin(skew=true)" in plan
    run = monitor_panel(hot, TOWER, MONITOR, found)
    assert run.scored.filter("tower = 'hot'").count() == 150


def test_hot_key_is_split_against_an_aggregated_lookup(spark, no_broadcast_small_splits):
    rows = [panel_row("hot", 0, new=float(1 + i % 7), site=f"S{i}") for i in range(3000)]
    rows += [panel_row(f"t{t}", 0, new=float(t % 2)) for t in range(600)]
    table = stage(panel(spark, rows).repartition(8, "site"), "rows")
    result = clean.silent_to_null(table, MONITOR.new_columns, ["tower", "day"])
    assert "SortMergeJoin(skew=true)" in final_plan(result)
    assert result.filter("new_dl_data_volume is null").count() == 300
    assert result.count() == 3600


def test_hot_cell_is_split_in_nearest_search(spark, no_broadcast_small_splits):
    points = [("d", 30 + i / 1e5, -97.0) for i in range(6000)] + [("d", 40.0 + i, -90.0) for i in range(40)]
    targets = [("d", f"t{i}", 30.0 + i / 1e3, -97.0) for i in range(60)] + [("d", f"u{i}", 40.0 + i, -90.0) for i in range(40)]
    near = nearest_within(
        stage(spark.createDataFrame(points, "g string, lat double, lng double").repartition(8, "lat"), "points"),
        spark.createDataFrame(targets, "g string, id string, latitude double, longitude double"),
        5.0,
        ["g"],
        "id",
    )
    plan = final_plan(near)
    assert "SortMergeJoin(skew=true)" in plan
    assert near.count() == 6040


def test_small_lookups_are_broadcast_without_a_hint(spark, hot):
    found = stage(events.detect_events(hot, TOWER, MONITOR), "events")
    plan = final_plan(panels.post_event_panel(hot, found, TOWER, MONITOR))
    assert "BroadcastHashJoin" in plan.split("Initial Plan")[0]
    assert "SortMergeJoin" not in plan.split("Initial Plan")[0]


def test_hot_ticket_combines_before_the_shuffle(spark):
    plan = plan_of(tickets.latest_tickets(derived(spark, SF, "tickets"), "2024-01-20"))
    assert plan.count("partial_max") >= 1
    assert "Window" not in plan


STREAMS = {"stream_to_files", "stream_score"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS))
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert node not in plan


def test_score_scan_reads_only_the_new_columns(spark, hot):
    found = spark.createDataFrame([("hot", day(20))], "tower string, event_date date")
    scan = next(
        line for line in plan_of(panels.post_event_panel(hot, found, TOWER, MONITOR, str(day(20)), str(day(22)))).splitlines()
        if "FileScan" in line
    )
    assert "old_" not in scan.split("ReadSchema")[1]
    assert "GreaterThanOrEqual(day,2024-01-21)" in scan and "LessThan(day,2024-01-23)" in scan


def test_score_range_equals_full_run_and_can_be_repeated(spark, hot, tmp_path):
    full = monitor_panel(hot, TOWER, MONITOR).scored
    path = str(tmp_path / "scores")
    for _ in range(2):
        part = score_range(hot, path, TOWER, MONITOR, str(day(20)), str(day(21)))
    columns = full.columns
    assert as_set(part.select(columns)) == as_set(full.filter(F.col("day") == day(20)).select(columns))
    assert part.count() == 250


def test_range_needs_no_more_than_its_own_days(spark, tmp_path):
    rows = [panel_row("a", n, old=1.0) for n in range(0, 30)] + [panel_row("a", n, new=9.0, shared=5.0) for n in range(30, 60)]
    table = panel(spark, rows)
    full = monitor_panel(table, TOWER, MONITOR).scored
    for start, end in ((30, 31), (33, 36), (44, 46), (45, 50)):
        part = monitor_panel(table, TOWER, MONITOR, start=str(day(start)), end=str(day(end))).scored
        wanted = full.filter(F.col("day").between(day(start), day(end - 1)))
        assert as_set(part) == as_set(wanted)


def test_stage_uses_the_named_shared_folder(spark, tmp_path, monkeypatch):
    assert Path(shared_folder(spark)).is_dir()
    assert shared_folder(spark) == shared_folder(spark)
    named = str(tmp_path / "shared")

    class Conf:
        def get(self, key, default=None):
            return named if key == "spark.checkpoint.dir" else default

    class Session:
        conf = Conf()

    assert shared_folder(Session()) == named


def test_score_rows_has_no_shuffle(spark):
    columns = [f"{n} double" for k in MONITOR.kpis for n in (k.name, k.avg, k.std)]
    df = spark.createDataFrame([tuple([1.0] * 21)], ", ".join(columns))
    assert "Exchange" not in plan_of(score.score_rows(df, MONITOR))


def test_work_orders_read_only_the_partitions_of_the_cohorts(spark, tmp_path):
    made = [(str(i), "open", f"{day(n)} 06:00:00", f"{day(n)} 18:00:00", "000001", 1.0, 2.0, day(n)) for n in range(60) for i in range(3)]
    schema = "noc_id string, status string, event_start string, event_end string, cell_id string, lat double, lng double, data_date date"
    spark.createDataFrame(made, schema).write.partitionBy("data_date").parquet(str(tmp_path / "orders"))
    found = spark.createDataFrame([("000001", day(30))], "tower string, event_date date")
    open_orders = tickets.work_orders_per_tower(spark.read.parquet(str(tmp_path / "orders")), found, TOWER, MONITOR)
    assert open_orders.count() == 15
    scans = [line for line in plan_of(open_orders).splitlines() if "FileScan" in line]
    assert scans and all("data_date" in line.split("PartitionFilters: [")[1].split("]")[0] and "ubquery" in line for line in scans)
