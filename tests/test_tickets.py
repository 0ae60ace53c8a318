import random
from datetime import date, timedelta

import pytest

from kpi_shift.operators import tickets
from kpi_shift.spec import TOWER
from tests.helpers import MONITOR, as_set, day
from tests.test_functions import haversine

SCHEMA = (
    "trouble_id long, status string, create_date date, modified_date date, lat double, lng double, "
    "problem_type string, assigned_group string"
)


def ticket(i, status="Open", create=0, modified=None, lat=30.0, lng=-97.0, kind="x", group="NRB"):
    modified = create if modified is None else modified
    return (i, status, create if create is None else day(create), day(modified), lat, lng, kind, group)


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def random_tickets(seed, n=300):
    rng = random.Random(seed)
    return [
        ticket(
            rng.randrange(n // 4),
            rng.choice(["Open", "Open", "OPEN", "Closed", None]),
            rng.randrange(30),
            rng.randrange(35),
            rng.choice([None, 30 + rng.randrange(40) / 200, 30 + rng.randrange(40) / 200]),
            -97 + rng.randrange(40) / 200,
            rng.choice(["x", tickets.PROBLEM_TYPES[0]]),
            rng.choice(["NRB", "OTHER", None]),
        )
        for _ in range(n)
    ]


def test_latest_version_as_of_a_day(spark):
    rows = [
        ticket(1, create=1, modified=2, kind="older"),
        ticket(1, create=1, modified=4, kind="newer"),
        ticket(1, create=1, modified=9, kind="later"),
        ticket(1, "Closed", create=1, modified=3),
        ticket(2, create=6, modified=2, kind="not yet created"),
        ticket(3, create=1, lat=None),
    ]
    latest = tickets.latest_tickets(table(spark, rows), str(day(5)))
    assert as_set(latest, "trouble_id", "status", "problem_type") == [(1, "Closed", "x"), (1, "Open", "newer")]


def test_open_needs_type_or_group_and_no_other_status(spark):
    rows = [
        ticket(1, group="NRB"),
        ticket(2, group="OTHER"),
        ticket(3, group=None, kind=tickets.PROBLEM_TYPES[-1]),
        ticket(4),
        ticket(4, "Resolved"),
        ticket(5, "OPEN"),
        ticket(6, None),
    ]
    latest = tickets.latest_tickets(table(spark, rows), str(day(5)))
    assert as_set(tickets.open_tickets(latest), "trouble_id") == [(1,), (3,), (5,)]


def test_spans_equal_the_state_of_every_single_day(spark):
    df = table(spark, random_tickets(3)).cache()
    spans = tickets.open_spans(df).collect()
    total = 0
    for n in range(0, 40, 3):
        then = tickets.open_tickets(tickets.latest_tickets(df, str(day(n))))
        columns = ("trouble_id", "status", "create_date", "lat", "lng", "problem_type")
        expected = as_set(then, *columns)
        held = [s for s in spans if s.first_day <= day(n) and (s.last_day is None or day(n) <= s.last_day)]
        assert sorted((tuple(s[c] for c in columns) for s in held), key=repr) == expected
        total += len(expected)
    assert total > 100
    df.unpersist()


def test_near_tickets_equal_the_long_way(spark):
    rng = random.Random(11)
    towers = {f"t{i:02d}": (30 + rng.randrange(40) / 200, -97 + rng.randrange(40) / 200) for i in range(25)}
    towers["nowhere"] = None
    events = [(t, day(8 + i % 5)) for i, t in enumerate(sorted(towers))]
    rows = random_tickets(5, 400)
    df = table(spark, rows).cache()
    coords = spark.createDataFrame([(t, *p) for t, p in towers.items() if p], "tower string, latitude double, longitude double")
    result = tickets.tickets_near_tower(df, spark.createDataFrame(events, "tower string, event_date date"), coords, TOWER, MONITOR)
    expected = {}
    for n in range(8, 30):
        run_day = day(n)
        open_then = tickets.open_tickets(tickets.latest_tickets(df, str(run_day))).collect()
        for event_date in {e[1] for e in events}:
            if not event_date <= run_day <= event_date + timedelta(days=14):
                continue
            for t in open_then:
                if t.create_date < event_date:
                    continue
                near = [
                    (round(haversine(t.lat, t.lng, *towers[tower]), 6), tower)
                    for tower, e in events
                    if e == event_date and towers[tower]
                ]
                near = [x for x in near if x[0] <= 5.0]
                if near:
                    key = (min(near)[1], event_date, run_day)
                    expected[key] = expected.get(key, 0) + 1
    assert sum(expected.values()) > 200
    got = {(r.tower, r.event_date, r.day): r.nrb_ticket_counts for r in result.collect()}
    assert got == expected
    df.unpersist()


@pytest.mark.parametrize("lost", [(), (9, 12, 13, 17)])
def test_work_orders_equal_the_long_way(spark, lost):
    rng = random.Random(23)
    loaded = [n for n in range(2, 24) if n not in lost]
    rows = []
    for _ in range(500):
        n = rng.choice(loaded)
        start = n - rng.randrange(4)
        tower = f"00000{rng.randrange(8)}"
        rows.append(
            (
                rng.randrange(60),
                rng.choice(["open", "OPEN", "closed"]),
                f"{day(start)} 01:00:00",
                f"{day(start + rng.randrange(3))} 02:00:00",
                rng.choice([tower, tower + "0001", None, "99999999"]),
                rng.choice([None, 30.0, 31.0]),
                -97.0,
                day(n),
            )
        )
    schema = "noc_id int, status string, event_start string, event_end string, cell_id string, lat double, lng double, data_date date"
    events = [(f"00000{i}", day(5 + 4 * (i % 4))) for i in range(6)] + [("000001", day(28))]
    result = tickets.work_orders_per_tower(
        spark.createDataFrame(rows, schema), spark.createDataFrame(events, "tower string, event_date date"), TOWER, MONITOR
    )
    expected = {}
    for tower, event_date in events:
        for run_day in (event_date + timedelta(days=k) for k in range(15)):
            wanted = {d for d in {r[7] for r in rows} if event_date <= d <= run_day}
            if run_day == event_date and event_date not in wanted:
                wanted = {event_date - timedelta(days=1)}
            best = {}
            for r in rows:
                if r[7] not in wanted or r[1].lower() != "open" or r[4] is None:
                    continue
                cell = r[4][:-4] if len(r[4]) > 8 else r[4]
                order = (r[2][:10], r[3][:10], (r[5] is not None, r[5] or 0), r[6], cell)
                best[(r[0], r[1])] = max(best.get((r[0], r[1]), order), order)
            n = sum(1 for b in best.values() if b[4] == tower and b[0] >= str(event_date))
            if n:
                expected[(tower, event_date, run_day)] = n
    assert sum(expected.values()) > 100
    assert {(r.tower, r.event_date, r.day): r.w360_ticket_counts for r in result.collect()} == expected


def test_cell_suffix_goes_only_from_long_ids(spark):
    df = spark.createDataFrame([("0123451234",), ("12345678",), ("12345",), ("123456789",)], "cell string")
    assert [r[0] for r in df.select(tickets.tower_of_cell("cell")).collect()] == ["012345", "12345678", "012345", "012345"]


def test_ticket_counts_from_records(spark):
    rows = [("77", 3, "2024-01-02"), ("77", 1, "2024-01-02"), ("77", 5, "2024-01-03")]
    counts = tickets.ticket_counts(spark.createDataFrame(rows, "enodeb_id string, count long, day string"), TOWER)
    assert as_set(counts, "tower", "day", "nrb_ticket_counts") == [("000077", date(2024, 1, 2), 4), ("000077", date(2024, 1, 3), 5)]
