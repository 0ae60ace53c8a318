import gzip
from datetime import date

import pytest
from pyspark.sql import functions as F

from kpi_shift.sources import quarantine
from tests.helpers import as_set


def day_file(folder, n, text, name="kpi"):
    path = folder / f"{name} 2024-01-{n:02d}.csv.gz"
    path.write_bytes(gzip.compress(text.encode()))
    return path


def lines(n, rows=3000):
    return "id,n\n" + "".join(f"d{n}-{i},{(i * 7919) % 9973}\n" for i in range(rows))


def read(spark, folder, days=range(1, 13), columns=("id", "n"), **options):
    return quarantine.read_daily_sorted(spark, str(folder / "kpi {}.csv.gz"), [f"2024-01-{n:02d}" for n in days], columns, **options)


def test_goes_on_past_damaged_files(spark, tmp_path):
    for n in range(1, 11):
        day_file(tmp_path, n, lines(n))
    for n in (3, 7):  # cut in the middle: the header is there, the end is not
        path = tmp_path / f"kpi 2024-01-{n:02d}.csv.gz"
        path.write_bytes(path.read_bytes()[:9000])
    (tmp_path / "kpi 2024-01-05.csv.gz").write_bytes(b"no archive at all")
    day_file(tmp_path, 6, "")
    day_file(tmp_path, 8, "id,n\na,1,2\nb\n\"c\",3\n")
    day_file(tmp_path, 9, "n,id,late\n4,e,x\n")
    rows, rejects = read(spark, tmp_path, columns=("id", "n", "gone"), source_day="file_day")
    counted = rows.groupBy("file_day").agg(F.count("*"), F.min("gone"))
    assert as_set(counted) == sorted([(date(2024, 1, n), 3000 if n not in (8, 9) else 1, None) for n in (1, 2, 4, 8, 9, 10)], key=repr)
    assert as_set(rows.filter("day(file_day) in (8, 9)"), "id", "n", "late") == [("c", "3", None), ("e", "4", "x")]
    assert as_set(rejects, "day", "reason", "record") == [
        (date(2024, 1, 3), "unreadable file", None),
        (date(2024, 1, 5), "unreadable file", None),
        (date(2024, 1, 6), "no header", None),
        (date(2024, 1, 7), "unreadable file", None),
        (date(2024, 1, 8), "malformed record", "a,1,2"),
        (date(2024, 1, 8), "malformed record", "b"),
    ]
    assert rejects.filter("path not like '%kpi%2024-01-%'").count() == 0


def test_a_day_of_several_files_is_kept_or_set_aside_whole(spark, tmp_path):
    for n in (1, 2):
        (tmp_path / f"2024-01-0{n}").mkdir()
        for part in "ab":
            (tmp_path / f"2024-01-0{n}" / f"{part}.csv").write_text("x,y\n1,2\n" if (n, part) != (2, "b") else "y,x\n2,1\n")
    rows, rejects = quarantine.read_daily_sorted(spark, str(tmp_path / "{}"), ["2024-01-01", "2024-01-02"], ["x"], distinct=False)
    assert as_set(rows) == [("1", "2")] * 2
    assert as_set(rejects, "day", "reason") == [(date(2024, 1, 2), "unreadable file")]


def test_sound_input_is_one_job_and_nothing_is_nothing(spark, tmp_path, monkeypatch):
    for n in range(1, 7):
        day_file(tmp_path, n, lines(n, 10))
    written = []
    monkeypatch.setattr(quarantine, "stage", lambda df, name, real=quarantine.stage: written.append(name) or real(df, name))
    rows, rejects = read(spark, tmp_path)
    assert (rows.count(), rejects.count(), written) == (60, 0, ["sound-days"])
    rows, rejects = read(spark, tmp_path, days=(20, 21))
    assert (rows.columns, rows.count(), rejects.count()) == (["id", "n"], 0, 0)


def test_a_failure_that_passes_rejects_nothing(spark, tmp_path, monkeypatch):
    for n in range(1, 4):
        day_file(tmp_path, n, lines(n, 10))
    tries = []

    def flaky(df, name, real=quarantine.stage):
        tries.append(name)
        if len(tries) == 1:
            file = df.inputFiles()[1]
            raise quarantine.PySparkException(f"[FAILED_READ_FILE.NO_HINT] Encountered error while reading file {file}. SQLSTATE: KD001")
        return real(df, name)

    monkeypatch.setattr(quarantine, "stage", flaky)
    rows, rejects = read(spark, tmp_path)
    assert (rows.count(), rejects.count(), len(tries)) == (30, 0, 4)


def test_other_errors_are_raised(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)divide"):
        quarantine.read_sound(spark, ["a", "b"], lambda group: spark.range(3).selectExpr("1 / (id - 1) AS n"), "fails")
