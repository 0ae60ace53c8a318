"""The kept ticket history against one pass over all versions."""

import shutil

import pytest

from kpi_shift.operators import tickets
from kpi_shift.plans import history
from kpi_shift.spec import TOWER
from tests.helpers import MONITOR, as_set, day, plan_of
from tests.test_tickets import random_tickets, table, ticket

KINDS = {"problem_types": (tickets.PROBLEM_TYPES[0],)}


def by_day(spans, first, last):
    """(day, ticket, version) for each day on which a span holds: spans may be cut differently."""
    held = spans.selectExpr("*", f"explode(sequence(greatest(first_day, DATE'{day(first)}'), least(coalesce(last_day, DATE'{day(last)}'), DATE'{day(last)}'))) AS day")
    return as_set(held.filter(f"day BETWEEN DATE'{day(first)}' AND DATE'{day(last)}'").drop("first_day", "last_day"))


def inside(spans, first, last):
    return spans.filter(f"first_day <= DATE'{day(last)}' AND (last_day IS NULL OR last_day >= DATE'{day(first)}')")


@pytest.mark.parametrize("cuts", [[0, 40], [0, 9, 10, 11, 25, 40]])
def test_runs_give_what_one_pass_gives(spark, tmp_path, cuts):
    rows = random_tickets(11, 500) + [ticket(None, create=3), ticket(None, "Closed", create=12), ticket(900, None, create=4), ticket(901, create=5), ticket(901, "Closed", create=5)]
    versions = table(spark, rows).cache()
    for a, b in zip(cuts, cuts[1:]):
        history.advance_tickets(versions, str(tmp_path), str(day(a)), str(day(b)))
    want = tickets.open_spans(versions, **KINDS)
    got = history.kept_spans(spark, str(tmp_path), **KINDS)
    assert as_set(got.select(want.columns)) == as_set(want) and want.count() > 60
    for start in (8, 10, 24, 39):
        some = inside(history.kept_spans(spark, str(tmp_path), str(day(start)), **KINDS), start, 45)
        assert by_day(some.select(want.columns), start, 45) == by_day(inside(want, start, 45), start, 45)


def test_a_run_can_be_repeated_and_corrected(spark, tmp_path):
    path = str(tmp_path)
    rows = [ticket(1, create=1), ticket(1, create=1, modified=4, kind="again"), ticket(2, create=2), ticket(2, "Closed", create=2, modified=6), ticket(3, create=7)]
    versions = table(spark, rows)
    for a, b in ((0, 3), (3, 5), (3, 5), (5, 9), (3, 5), (5, 9)):
        history.advance_tickets(versions, path, str(day(a)), str(day(b)))
    want = tickets.open_spans(versions)
    assert as_set(history.kept_spans(spark, path).select(want.columns)) == as_set(want)
    corrected = table(spark, [r for r in rows if r[0] != 3])
    history.advance_tickets(corrected, path, str(day(5)), str(day(9)))
    assert {r.trouble_id for r in history.kept_spans(spark, path).collect()} == {1, 2}
    history.advance_tickets(versions.limit(0), path, str(day(9)), str(day(10)))  # a day without tickets
    assert history.kept_spans(spark, path).count() == 3


def test_a_closed_ticket_stays_closed(spark, tmp_path):
    versions = table(spark, [ticket(1, create=0), ticket(1, "Closed", create=0, modified=3), ticket(1, create=0, modified=8)])
    for a in range(0, 10, 2):
        history.advance_tickets(versions, str(tmp_path), str(day(a)), str(day(a + 2)))
    assert as_set(history.kept_spans(spark, str(tmp_path)), "first_day", "last_day") == [(day(0), day(2))]


def test_an_unfinished_run_is_not_seen(spark, tmp_path):
    path = str(tmp_path)
    versions = table(spark, [ticket(1, create=0), ticket(1, create=0, modified=5, kind="newer"), ticket(2, create=6)])
    history.advance_tickets(versions, path, str(day(0)), str(day(4)))
    before = as_set(history.kept_spans(spark, path))
    history.advance_tickets(versions, path, str(day(4)), str(day(8)))
    after = as_set(history.kept_spans(spark, path))
    shutil.rmtree(f"{path}/runs/kept={day(4)}")  # as if stopped before the end
    assert as_set(history.kept_spans(spark, path)) == before != after
    history.advance_tickets(versions, path, str(day(4)), str(day(8)))
    assert as_set(history.kept_spans(spark, path)) == after


def test_a_run_reads_open_tickets_and_its_own_days_only(spark, tmp_path):
    path = str(tmp_path)
    versions = table(spark, random_tickets(5))
    for a in (0, 10, 20):
        history.advance_tickets(versions, path, str(day(a)), str(day(a + 10)))
    spans = history.kept_spans(spark, path, str(day(25)))
    spans.collect()
    scans = [line for line in plan_of(spans).splitlines() if "FileScan" in line and "PartitionFilters" in line]
    assert scans and all("kept" in line.split("PartitionFilters")[1].split("]")[0] for line in scans)


def test_reports_from_the_history(spark, tmp_path):
    rows = random_tickets(8)
    events = spark.createDataFrame([(f"t{i}", day(5 + i % 3)) for i in range(9)], "tower string, event_date date")
    coords = spark.createDataFrame([(f"t{i}", 30 + i / 50, -97 + i / 60) for i in range(9)], "tower string, latitude double, longitude double")
    versions = table(spark, rows)
    for a in (0, 7, 12):
        history.advance_tickets(versions, str(tmp_path), str(day(a)), str(day({0: 7, 7: 12, 12: 40}[a])))
    want = tickets.tickets_near_tower(versions, events, coords, TOWER, MONITOR, KINDS["problem_types"]).filter(f"day >= DATE'{day(10)}'")
    spans = history.kept_spans(spark, str(tmp_path), str(day(10)), **KINDS)
    got = tickets.spans_near_tower(spans, events, coords, TOWER, MONITOR).filter(f"day >= DATE'{day(10)}'")
    assert as_set(got) == as_set(want) and want.count() > 20
