"""The bucketed panel: same tables, no shuffle of panel rows, hot towers split."""

import uuid

import pytest
from pyspark.sql import functions as F

from kpi_shift.functions.stage import stage
from kpi_shift.operators import events as detection
from kpi_shift.plans import colocated
from kpi_shift.plans.monitoring import monitor_panel
from kpi_shift.spec import TOWER
from tests.helpers import MONITOR, as_set, day, panel, panel_row

BUCKETS = 8


@pytest.fixture
def rows(spark):
    """Half of all rows belong to one tower; some of its rows are silent."""
    made = [panel_row("hot", n, old=1.0 + n % 3, site=f"S{i}", old_dl_data_volume=float(i)) for n in range(6, 20) for i in range(40)]
    made += [panel_row("hot", 20 + n, new=2.0 if n != 1 or i % 9 else 0.0, site=f"S{i}") for n in range(3) for i in range(40)]
    made += [panel_row("hot", 12, shared=0.0, site="silent")]
    for t in range(30):
        made += [panel_row(f"t{t:02d}", n, old=1.0 + (n * t) % 5) for n in range(6, 20)] + [panel_row(f"t{t:02d}", 20 + n, new=2.0 * (n != 2), shared=9.0) for n in range(4)]
    return stage(panel(spark, made), "panel")


@pytest.fixture
def stored(rows, tmp_path):
    return colocated.write_colocated(rows, f"panel_{uuid.uuid4().hex}", str(tmp_path / "panel"), TOWER, BUCKETS)


def leftmost_scan(df):
    """The nodes above the first scan of a plan: the rows that a join streams come first."""
    above, found = {}, []
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        bare = line.lstrip(" :+-")
        depth = len(line) - len(bare)
        above = {d: name for d, name in above.items() if d < depth} | {depth: bare.lstrip("*()0123456789 ")}
        if "FileScan" in bare:
            return bare, list(above.values())
    return found


def test_joins_leave_the_panel_where_it_is(spark, rows, stored, settings):
    settings(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    found = stage(detection.detect_events(rows, TOWER, MONITOR), "events")
    run = monitor_panel(rows, TOWER, MONITOR, found)
    with colocated.settings(spark, colocated.JOIN_SETTINGS):
        scan, above = leftmost_scan(colocated.score_colocated(stored, found, run.baseline, MONITOR))
    assert "Bucketed: true" in scan and "SelectedBucketsCount" in scan
    assert sum("SortMergeJoin" in node for node in above) == 3  # events, silent keys, baseline
    assert not [node for node in above if "Exchange" in node]
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


def test_same_tables_as_on_a_plain_panel(rows, stored):
    plain, run = monitor_panel(rows, TOWER, MONITOR), colocated.monitor_colocated(stored, MONITOR)
    for name in ("events", "pre_panel", "baseline", "scored"):
        want, got = getattr(plain, name), getattr(run, name)
        assert as_set(got.select(want.columns)) == as_set(want), name
    assert run.scored.count() > 200


def test_hot_towers_are_split_over_buckets(rows, stored):
    parts = {r.tower: r.parts for r in stored.parts.collect()}
    assert set(parts) == {"hot"} and parts["hot"] >= 4
    per_bucket = stored.panel().groupBy("tower", "part").count().where("tower = 'hot'").collect()
    assert len(per_bucket) == parts["hot"] and max(r["count"] for r in per_bucket) < 2 * rows.count() / BUCKETS


def test_days_are_replaced(spark, rows, stored):
    changed = rows.where(F.col("day") == day(20)).withColumn("site", F.lit("again"))
    colocated.replace_days(changed, stored)
    left = stored.panel()
    assert left.count() == rows.count()
    assert {r.site for r in left.where(F.col("day") == day(20)).select("site").distinct().collect()} == {"again"}
    assert "again" not in {r.site for r in left.where(F.col("day") != day(20)).select("site").distinct().collect()}


def test_empty_panel(rows, tmp_path):
    empty = colocated.write_colocated(rows.limit(0), f"panel_{uuid.uuid4().hex}", str(tmp_path / "empty"), TOWER, 4)
    assert colocated.monitor_colocated(empty, MONITOR).scored.count() == 0
