from datetime import date

from kpi_shift.operators import audit
from tests.helpers import as_set


def loads(spark, **tables):
    rows = [(name, date(2024, 1, d)) for name, days in tables.items() for d in days]
    return spark.createDataFrame(rows + rows[:1], "table_name string, day date")


HOLIDAYS = ["2024-01-15"]


def expected(spark, **tables):
    rows = [(name, *pair) for name, pair in tables.items()]
    return spark.createDataFrame(rows, audit.EXPECTED_TABLES)


def test_freshness(spark):
    wanted = expected(spark, a=(1, False), b=(None, False), c=(3, False), never=(1, False))
    fresh = audit.table_freshness(loads(spark, a=[3, 9], b=[7], c=[7], other=[9]), wanted, "2024-01-10")
    assert as_set(fresh, "table_name", "latest_day", "delayed_days") == [
        ("a", date(2024, 1, 9), 0),
        ("b", date(2024, 1, 7), 2),
        ("c", date(2024, 1, 7), 0),
        ("never", None, None),
    ]


def test_missing_days_with_weekends_and_holidays(spark):
    # 2024-01-13/14 is a weekend, the 15th a holiday
    table = loads(spark, every=[12, 16], working=[12, 16])
    wanted = expected(spark, every=(1, False), working=(1, True), never=(1, True))
    missing = audit.missing_days(table, wanted, "2024-01-18", HOLIDAYS, window=6)
    days = {name: [d.day for n, d in as_set(missing, "table_name", "day") if n == name] for name in ("every", "working", "never")}
    assert days == {"every": [13, 14, 15, 17], "working": [17], "never": [12, 16, 17]}
    assert as_set(audit.missing_days(table, expected(spark, every=(2, None)), "2024-01-18", HOLIDAYS, window=1)) == []


def test_counts_per_day(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00",), ("2024-01-02 01:00:00",), ("2024-01-02 09:00:00",)], "ts string")
    df = df.selectExpr("cast(ts as timestamp) as ts")
    assert as_set(audit.rows_per_day(df, "ts")) == [(date(2024, 1, 2), 2)]
    assert [r.day.day for r in audit.latest_days(df, "ts").collect()] == [2, 1]


def test_completeness_report(spark):
    wanted = expected(spark, a=(1, False), b=(1, False))
    report = audit.completeness_report(loads(spark, a=[8, 9], b=[9]), wanted, "2024-01-10", HOLIDAYS, window=2)
    assert as_set(report, "table_name", "missing_days", "all_on_time") == [("a", [], True), ("b", [date(2024, 1, 8)], True)]
    late = audit.completeness_report(loads(spark, a=[8, 9], b=[8]), wanted, "2024-01-10", HOLIDAYS, window=2)
    assert {r.all_on_time for r in late.collect()} == {False}
    never = audit.completeness_report(loads(spark, a=[8, 9]), wanted, "2024-01-10", HOLIDAYS, window=2)
    assert as_set(never, "table_name", "missing_days", "all_on_time") == [
        ("a", [], False),
        ("b", [date(2024, 1, 8), date(2024, 1, 9)], False),
    ]
    both = audit.combined_completeness({"store": report, "files": never})
    assert as_set(both.groupBy("side").count()) == [("files", 2), ("store", 2)]
