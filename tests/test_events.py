import math
import random
from datetime import timedelta

from kpi_shift.operators import events
from kpi_shift.spec import SECTOR, TOWER
from tests.helpers import MONITOR, as_set, day, panel, panel_row

NAN = float("nan")


def found(spark, rows, **bounds):
    return as_set(events.detect_events(panel(spark, rows), TOWER, MONITOR, **bounds))


def judged_one_day_at_a_time(rows, run_day):
    """The plain reading: look at the 15 days up to the run day, one tower at a time."""
    out = set()
    for tower in {r[0] for r in rows}:
        window = [r for r in rows if r[0] == tower and run_day - timedelta(days=14) <= r[1] <= run_day]
        activity = []
        for r in window:
            values = dict(zip(MONITOR.panel_columns, r[3:]))
            sums = []
            for side in (MONITOR.old_columns, MONITOR.new_columns):
                parts = [values[c] for c in side]
                sums.append(None if None in parts else sum(parts))
            activity.append((r[1], *sums))
        positive = [d for d, _, new in activity if new is not None and not math.isnan(new) and new > 0]
        if not positive or min(positive) != run_day:
            continue
        totals = []
        for i in (1, 2):
            known = [a[i] for a in activity if a[i] is not None]
            totals.append(sum(known) if known else None)
        if all(t is None or t != 0 for t in totals):
            out.add((tower, run_day))
    return out


def test_equals_one_day_at_a_time(spark):
    rng = random.Random(7)
    rows = []
    for t in range(60):
        switch = rng.randrange(10, 45)
        for n in range(50):
            if rng.random() < 0.15:
                continue
            for _ in range(1 + (rng.random() < 0.1)):
                old = rng.choice([0.0, 1.0, 2.0]) if n < switch else 0.0
                new = rng.choice([0.0, 1.0, None, NAN]) if n >= switch and rng.random() < 0.5 else 0.0
                rows.append(panel_row(f"t{t:02d}", n, old, new))
    expected = set().union(*(judged_one_day_at_a_time(rows, day(n)) for n in range(50)))
    assert len(expected) > 20
    assert found(spark, rows) == sorted(expected, key=repr)
    some = {e for e in expected if day(20) <= e[1] <= day(30)}
    assert found(spark, rows, start=str(day(20)), end=str(day(30))) == sorted(some, key=repr)


def test_needs_both_sides(spark):
    history = [panel_row("old_only", n, old=1.0) for n in range(20)]
    history += [panel_row("new_only", n, new=1.0) for n in range(16, 20)]
    history += [panel_row("both", n, old=1.0) for n in range(16)] + [panel_row("both", n, new=1.0) for n in range(16, 20)]
    history += [panel_row("unknown_old", n, old=None, new=1.0) for n in range(18, 20)]
    assert found(spark, history) == [("both", day(16)), ("unknown_old", day(18))]


def test_quiet_gap_of_14_and_15_days(spark):
    def tower(name, gap):
        rows = [panel_row(name, n, old=1.0) for n in range(60)]
        return rows + [panel_row(name, 20, new=1.0), panel_row(name, 20 + gap, new=1.0)]

    assert found(spark, tower("short", 14) + tower("long", 15)) == [
        ("long", day(20)),
        ("long", day(35)),
        ("short", day(20)),
    ]


def test_event_rows_and_finer_levels(spark):
    rows = panel(spark, [panel_row("a", 0, old=1.0), panel_row("a", 1, new=2.0), panel_row("a", 1, new=3.0, site="T")])
    listed = spark.createDataFrame([("a", day(1), "x"), ("a", day(1), "y")], "tower string, event_date date, note string")
    assert as_set(events.event_rows(rows, listed, TOWER, MONITOR), "site", "event_date", "new_activity") == [
        ("S", day(1), 10.0),
        ("T", day(1), 15.0),
    ]
    inventory = spark.createDataFrame([("a", "1"), ("a", "1"), ("a", "2"), ("b", "1")], "tower string, sector string")
    assert as_set(events.events_by_level(inventory, listed, SECTOR), "tower", "sector", "event_date") == [
        ("a", "1", day(1)),
        ("a", "2", day(1)),
    ]


def test_event_list_check(spark):
    listed = spark.createDataFrame([("a", day(1)), ("b", day(1))], "tower string, event_date date")
    check = events.event_list_check(listed, "2024-01-01", "2024-01-02")
    assert as_set(check) == [(day(0), 0, True), (day(1), 2, False)]
    empty = events.event_list_check(listed.limit(0), "2024-01-01", "2024-01-01")
    assert as_set(empty) == [(day(0), 0, True)]
