import math
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from kpi_shift.functions import columns, dates, geo
from kpi_shift.functions.nearest import nearest_within
from tests.helpers import as_set


def test_date_window_directions_and_types():
    assert dates.date_window("2024-03-01", 2) == ["2024-03-01", "2024-02-29", "2024-02-28"]
    assert dates.date_window("2024-02-28", 2, "Forward") == ["2024-02-28", "2024-02-29", "2024-03-01"]
    assert dates.date_window("2024-01-03", end="2024-01-01") == ["2024-01-03", "2024-01-02", "2024-01-01"]
    assert dates.date_window("2024-01-01", 9, "sideways", end="2024-01-02") == ["2024-01-01", "2024-01-02"]
    assert dates.date_window("2024-01-01", end="2024-01-01") == ["2024-01-01"]
    assert dates.date_window("2024-01-01", 0, as_type="date") == [date(2024, 1, 1)]
    assert dates.date_window("1970-01-02", 1, as_type="epoch") == [86400.0, 0.0]
    with pytest.raises(ValueError):
        dates.date_window("2024-01-01", 1, "sideways")


def test_calendar(spark):
    assert [r.day.day for r in dates.calendar(spark, "2024-01-30", "2024-01-31").collect()] == [30, 31]


def test_pad_id_keeps_long_ids(spark):
    df = spark.createDataFrame([("12345",), ("123456",), ("1234567",), (None,)], "id string")
    assert [r[0] for r in df.select(columns.pad_id("id")).collect()] == ["012345", "123456", "1234567", None]


def test_column_helpers(spark):
    df = spark.createDataFrame([("a", "1.5", 2.345, None), ("b", "x", 0.285, 1)], "Id string, V string, w double, n int")
    assert columns.rename_columns(df, {"Id": "key"}).columns == ["key", "V", "w", "n"]
    assert columns.lower_names(df).columns == ["id", "v", "w", "n"]
    assert columns.lower_names(df, ["V"]).columns == ["Id", "v", "w", "n"]
    assert as_set(columns.cast_columns(df, ["V"]), "V") == [(1.5,), (None,)]
    assert as_set(columns.round_columns(df), "w") == [(0.29,), (2.35,)]
    assert as_set(columns.round_columns(df, 1, ["w"]), "w") == [(0.3,), (2.3,)]
    assert columns.add_missing(df, {"w": F.lit(1), "extra": F.lit(0)}).columns == ["Id", "V", "w", "n", "extra"]
    assert [r[0] for r in df.selectExpr(columns.row_sum(["w", "n"])).collect()] == [None, 1.285]


def haversine(lat1, lng1, lat2, lng2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lng2 - lng1) / 2) ** 2
    return 2 * geo.EARTH_RADIUS_KM * math.asin(math.sqrt(a)) / geo.KM_PER_MILE


def test_haversine(spark):
    df = spark.createDataFrame([(30.0, -97.0, 30.05, -96.9), (30.0, None, 1.0, 1.0)], "a double, b double, c double, d double")
    near, unknown = df.selectExpr(geo.haversine_miles(*"abcd") + " AS m").collect()
    assert near.m == pytest.approx(haversine(30.0, -97.0, 30.05, -96.9))
    assert unknown.m is None


@pytest.mark.parametrize("centre", [(30.0, -97.0), (-41.3, 174.8), (64.0, 179.98), (0.01, -0.01), (78.0, 15.0), (89.95, 40.0), (-89.99, -170.0)])
def test_nearest_within_equals_comparing_all_pairs(spark, centre):
    rng = random.Random(repr(centre))
    lat0, lng0 = centre
    stretch = 0.2 / math.cos(math.radians(lat0))

    def spot(spread):
        lng = lng0 + rng.uniform(-stretch, stretch) * spread
        lat = lat0 + rng.uniform(-0.2, 0.2) * spread
        return round(max(-90.0, min(90.0, lat)), 4), round((lng + 180) % 360 - 180, 4)

    points = [(g, *spot(1)) for g in ("a", "b") for _ in range(150)]
    # a third of the targets of group a crowd together, some at the very same place
    targets = [("a", f"t{i:03d}", *spot(0.02 if i < 40 else 1)) for i in range(120)]
    targets += [("b", f"u{i:03d}", *spot(1)) for i in range(10)]
    targets += [("a", "same", targets[0][2], targets[0][3]), ("a", "zsame", targets[0][2], targets[0][3])]
    points += points[:5] + [("c", lat0, lng0), ("a", None, 1.0)]
    found = nearest_within(
        spark.createDataFrame(points, "g string, lat double, lng double"),
        spark.createDataFrame(targets, "g string, id string, latitude double, longitude double"),
        5.0,
        ["g"],
        "id",
    )
    expected = []
    for g, lat, lng in sorted(set(p for p in points if p[1] is not None)):
        near = [(round(haversine(lat, lng, t[2], t[3]), 6), t[1]) for t in targets if t[0] == g]
        near = [n for n in near if n[0] <= 5.0]
        if near:
            expected.append((g, lat, lng, min(near)[1]))
    assert len(expected) > 50
    assert as_set(found, "g", "lat", "lng", "id") == sorted(expected, key=repr)
