import gzip
import json
from datetime import date

import pytest

from kpi_shift.operators.alerts import as_messages
from kpi_shift.sources import daily, sinks
from tests.helpers import as_set


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_daily_csv_skips_missing_days_and_matches_by_name(spark, tmp_path):
    write(tmp_path / "kpi_2024-01-01.csv", "ENODEB,DAY,NEW%\n1,01/01/2024,5\n1,01/01/2024,5\n")
    write(tmp_path / "kpi_2024-01-03.csv", "DAY,ENODEB\n01/03/2024,2\n")
    days = ["2024-01-01", "2024-01-02", "2024-01-03"]
    pattern = str(tmp_path / "kpi_{}.csv")
    columns = ["ENODEB", "DAY", "NEW%", "LATE"]
    rows = daily.read_daily_csv(spark, pattern, days, columns, source_day="file_day")
    assert as_set(rows, "ENODEB", "DAY", "`NEW%`", "LATE", "file_day") == [
        ("1", "01/01/2024", "5", None, date(2024, 1, 1)),
        ("2", "01/03/2024", None, None, date(2024, 1, 3)),
    ]
    upper = daily.read_daily_csv(spark, pattern, days[:1], columns, lambda df: df.withColumnRenamed("NEW%", "new"))
    assert as_set(upper, "new") == [("5",)]
    nothing = daily.read_daily_csv(spark, pattern, ["2024-02-01"], columns)
    assert (nothing.columns, nothing.count()) == (columns, 0)


def test_one_scan_per_layout(spark, tmp_path):
    for n in range(1, 6):
        write(tmp_path / f"kpi_2024-01-0{n}.csv", f"ENODEB,DAY\n{n},x\n")
    rows = daily.read_daily_csv(spark, str(tmp_path / "kpi_{}.csv"), [f"2024-01-0{n}" for n in range(1, 6)], ["ENODEB", "DAY"])
    assert rows.count() == 5
    assert rows._jdf.queryExecution().executedPlan().toString().count("FileScan") <= 2  # final and initial plan


def test_csv_gzip_glob_and_tree(spark, tmp_path):
    for name in ("t-1", "t-2"):
        with gzip.open(tmp_path / f"{name}.csv.gz", "wt") as out:
            out.write(f"id,n\n{name},1\n")
    assert as_set(daily.read_csv(spark, str(tmp_path / "t-*.csv.gz")), "id", "n") == [("t-1", "1"), ("t-2", "1")]
    write(tmp_path / "deep" / "er" / "a.csv", "id,n\nx,2\n")
    write(tmp_path / "deep" / "b.csv", "id,n\ny,3\n")
    tree = daily.read_csv_tree(spark, str(tmp_path / "deep"), inferSchema=True)
    assert as_set(tree, "id", "n") == [("x", 2), ("y", 3)]
    typed = daily.read_csv(spark, [str(tmp_path / "deep" / "b.csv")], schema="id string, n double")
    assert as_set(typed) == [("y", 3.0)]


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "n int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, n int")
    assert as_set(daily.union_tables([a, b]), "n", "s") == [(1, "x"), (2, "y")]
    with pytest.raises(ValueError):
        daily.union_tables([])


def test_list_dated_files(spark, tmp_path):
    write(tmp_path / "out" / "scores_2024-01-05.csv", "a\n")
    write(tmp_path / "out" / "scores_20240106.csv", "a\n")
    write(tmp_path / "out" / "notes.txt", "a\n")
    assert as_set(daily.list_dated_files(spark, str(tmp_path / "out")), "day") == [(date(2024, 1, 5),)]
    assert as_set(daily.list_dated_files(spark, str(tmp_path / "out"), daily.COMPACT_DAY), "day") == [(date(2024, 1, 6),)]


def test_latest_snapshot_and_partitions(spark, tmp_path):
    rows = [("a", 1, date(2024, 1, 1)), ("a", 2, date(2024, 1, 5)), ("a", 3, date(2024, 1, 9))]
    path = str(tmp_path / "snap")
    spark.createDataFrame(rows, "id string, v int, date date").write.partitionBy("date").parquet(path)
    table = spark.read.parquet(path)
    assert as_set(daily.latest_snapshot(table, "2024-01-08"), "v") == [(2,)]
    static = spark.createDataFrame([("a", 0)], "id string, v int")
    assert as_set(daily.latest_snapshot(table, "2024-01-08", static=static), "v") == [(2,)]
    assert as_set(daily.latest_snapshot(table, "2023-12-31", static=static), "v") == [(0,)]
    assert as_set(daily.dated_partitions(table, "2024-01-02", "2024-01-09"), "v") == [(2,), (3,)]


def test_repeated_partition_write_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "scores")
    schema = "id string, v int, event_date date, day date"
    first = [("a", 1, date(2024, 1, 1), date(2024, 1, 1)), ("a", 1, date(2024, 1, 1), date(2024, 1, 2))]
    sinks.write_partitions(spark.createDataFrame(first, schema), path)
    again = [("b", 7, date(2024, 1, 1), date(2024, 1, 2))]
    for _ in range(2):
        sinks.write_partitions(spark.createDataFrame(again, schema), path)
    assert as_set(spark.read.parquet(path), "id", "v") == [("a", 1), ("b", 7)]


def test_range_write_removes_what_the_new_result_lacks(spark, tmp_path):
    path = str(tmp_path / "scores")
    schema = "id string, v int, event_date date, day date"
    first = [("a", n, date(2024, 1, 1), date(2024, 1, n)) for n in (1, 2, 3, 4)]
    sinks.write_partitions(spark.createDataFrame(first, schema), path)
    corrected = spark.createDataFrame([("b", 7, date(2024, 1, 1), date(2024, 1, 2))], schema)
    sinks.write_partitions(corrected, path, between=("day", "2024-01-02", "2024-01-04"))
    assert as_set(sinks.read_partitions(spark, path), "id", "v") == [("a", 1), ("a", 4), ("b", 7)]
    sinks.write_partitions(corrected.limit(0), path, between=("day", "2024-01-01", "2024-02-01"))
    assert as_set(sinks.read_partitions(spark, path)) == []


def test_file_of_another_header_fails(spark, tmp_path):
    (tmp_path / "2024-01-01").mkdir()
    (tmp_path / "2024-01-01" / "a.csv").write_text("x,y\n1,2\n3,4\n")
    (tmp_path / "2024-01-01" / "b.csv").write_text("y,x\n2,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        daily.read_daily_csv(spark, str(tmp_path / "{}"), ["2024-01-01"], ["x", "y"]).collect()


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int").repartition(2)
    sinks.export_csv(df, str(tmp_path / "csv"), files=1)
    assert len(list((tmp_path / "csv").glob("*.csv"))) == 1
    assert as_set(daily.read_csv(spark, str(tmp_path / "csv"))) == [("a", "1"), ("b", "2")]
    sinks.write_documents(df, str(tmp_path / "json"))
    assert as_set(spark.read.json(str(tmp_path / "json")), "id", "v") == [("a", 1), ("b", 2)]
    sinks.write_documents(spark.createDataFrame([("a", None)], "id string, v int"), str(tmp_path / "null"))
    assert json.loads(spark.read.text(str(tmp_path / "null")).first().value) == {"id": "a", "v": None}
    sinks.write_parquet(df, str(tmp_path / "parquet"))
    sinks.write_parquet(df, str(tmp_path / "parquet"))
    assert spark.read.parquet(str(tmp_path / "parquet")).count() == 2
    sinks.publish(as_messages(df), "text", {"path": str(tmp_path / "bus")})
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "bus")).collect()]
    assert sorted(m["id"] for m in lines) == ["a", "b"]
