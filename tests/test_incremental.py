"""States kept day by day against one pass over everything."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from kpi_shift.functions.stage import stage
from kpi_shift.operators import events as detection
from kpi_shift.operators import moments, panels
from kpi_shift.plans import incremental
from kpi_shift.spec import SECTOR, TOWER
from tests.helpers import MONITOR, PANEL_SCHEMA, as_set, day, panel, panel_row, plan_of

EXACT = replace(MONITOR, digits=6)


def rows(seed=6, towers=25, days=45):
    """Towers that switch, switch back, fall silent, have several rows a day, gaps, nulls and zeros."""
    rng = random.Random(seed)
    made = []
    for t in range(towers):
        switch = rng.randrange(5, days)
        for n in range(days):
            for i in range(rng.choice((0, 1, 1, 1, 2, 4))):
                new = n >= switch and not (t % 5 == 0 and n > switch + 3)
                value = rng.choice((0.0, 1.0, 2.5, 7.25))
                extra = {"old_dl_data_volume": rng.choice((None, 3.0, 0.5))} if t % 4 == 0 else {}
                made.append(panel_row(f"t{t}", n, old=0.0 if new else value, new=value if new else 0.0, shared=rng.choice((0.0, 1.0, 3.0)), site=f"S{i}", **extra))
    return made


def spans(order):
    return [(str(day(a)), str(day(b))) for a, b in order]


@pytest.mark.parametrize("order", [[(0, 45)], [(0, 20), (20, 21), (21, 22), (22, 45)], [(30, 45), (0, 15), (15, 30)]])
def test_days_in_any_order_give_what_one_pass_gives(spark, tmp_path, order):
    table = stage(panel(spark, rows()), "panel")
    for start, end in spans(order):
        incremental.advance(table, str(tmp_path), TOWER, EXACT, start, end)
    found = detection.detect_events(table, TOWER, EXACT)
    assert found.count() > 15
    assert as_set(incremental.kept_events(spark, str(tmp_path)), "tower", "event_date") == as_set(found)
    want = panels.baseline_stats(panels.pre_event_panel(table, stage(found, "events"), TOWER, EXACT), TOWER, EXACT)
    got = incremental.kept_baselines(spark, str(tmp_path)).select(want.columns)
    assert len(as_set(want)) > 15

    def near(records):
        return [tuple(round(v, 5) + 0.0 if isinstance(v, float) else v for v in r) for r in records]

    assert near(as_set(got)) == near(as_set(want))


def test_a_corrected_day_changes_later_events(spark, tmp_path):
    made = [panel_row("a", n, old=1.0) for n in range(20)] + [panel_row("a", n, new=1.0) for n in range(20, 30)]
    incremental.advance(panel(spark, made), str(tmp_path), TOWER, MONITOR, str(day(0)), str(day(30)))
    assert as_set(incremental.kept_events(spark, str(tmp_path)), "event_date") == [(day(20),)]
    made[18] = panel_row("a", 18, old=1.0, new=5.0)  # active before
    incremental.advance(panel(spark, made), str(tmp_path), TOWER, MONITOR, str(day(18)), str(day(19)))
    assert as_set(incremental.kept_events(spark, str(tmp_path)), "event_date") == [(day(18),)]


def test_a_finer_level_takes_the_tower_events(spark, tmp_path):
    made = [(*panel_row(t, n, old=float(1 + n * s % 4), site="S"), str(s)) for t in "ab" for s in (1, 2) for n in range(14)]
    table = spark.createDataFrame(made, PANEL_SCHEMA + ", sector string")
    found = spark.createDataFrame([("a", day(14)), ("b", day(10))], "tower string, event_date date")
    incremental.advance(table, str(tmp_path), SECTOR, EXACT, str(day(0)), str(day(14)), found)
    want = panels.baseline_stats(panels.pre_event_panel(table, found, SECTOR, EXACT), SECTOR, EXACT)
    assert as_set(incremental.kept_baselines(spark, str(tmp_path)).select(want.columns)) == as_set(want)


def test_a_new_day_reads_one_day_of_the_panel(spark, tmp_path):
    path = str(tmp_path / "panel")
    panel(spark, rows(days=8)).write.partitionBy("day").parquet(path)
    stored = spark.read.parquet(path)
    one = incremental._days(stored, "day", str(day(2)), str(day(3)))
    for made in (detection.daily_activity(one, TOWER, MONITOR), moments.daily_moments(one, TOWER, MONITOR)):
        scan = next(line for line in plan_of(made).splitlines() if "FileScan" in line)
        assert "PartitionFilters: [isnotnull(day" in scan and "2024-01-03" in scan and "2024-01-04" in scan


def test_empty_panel(spark, tmp_path):
    incremental.advance(panel(spark, []), str(tmp_path), TOWER, MONITOR, str(day(0)), str(day(3)))
    assert incremental.kept_events(spark, str(tmp_path)).count() == incremental.kept_baselines(spark, str(tmp_path)).count() == 0
