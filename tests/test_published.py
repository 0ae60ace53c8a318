"""Readers see a range's old rows until the one step that publishes the new ones."""

import pytest

from kpi_shift.sources import published
from tests.helpers import as_set, day

SCHEMA = "id string, event_date date, day date, v int"
BY = ["event_date", "day"]


def rows(spark, *made):
    return spark.createDataFrame([(i, day(e), day(d), v) for i, e, d, v in made], SCHEMA)


def seen(spark, path, number=None):
    return as_set(published.read_published(spark, path, number), "id", "day", "v")


def test_a_stopped_writer_leaves_the_old_table(spark, tmp_path):
    path, whole = str(tmp_path), ("day", str(day(0)), str(day(9)))
    published.publish_range(rows(spark, ("a", 0, 1, 1), ("a", 0, 2, 2), ("b", 1, 5, 3)), path, BY, whole)
    before = seen(spark, path)
    assert len(before) == 3
    open_table = published.read_published(spark, path)
    new = rows(spark, ("a", 0, 2, 20), ("c", 2, 3, 30))
    _, held = published.write_version(new, path, BY)  # and stopped here
    assert seen(spark, path) == before
    number = published.commit_version(spark, path, held, new.schema, ("day", str(day(2)), str(day(5))))
    after = [("a", day(1), 1), ("a", day(2), 20), ("b", day(5), 3), ("c", day(3), 30)]
    assert number == 2 and seen(spark, path) == after
    assert as_set(open_table, "id", "day", "v") == before == seen(spark, path, 1)  # who reads the old one goes on


def test_a_range_can_become_empty_and_old_versions_go(spark, tmp_path):
    path = str(tmp_path)
    for v in (1, 2, 3):
        published.publish_range(rows(spark, ("a", 0, 1, v), ("a", 0, 2, v)), path, BY, ("day", str(day(0)), str(day(3))))
    published.publish_range(rows(spark).limit(0), path, BY, ("day", str(day(2)), str(day(3))))
    assert seen(spark, path) == [("a", day(1), 3)]
    assert len(published.vacuum(spark, path, keep=1)) == 3 and seen(spark, path) == [("a", day(1), 3)]
    published.publish_range(rows(spark).limit(0), path, BY, ("day", str(day(0)), str(day(9))))
    assert seen(spark, path) == [] and published.read_published(spark, path).columns == ["id", "event_date", "day", "v"]


def test_two_writers_do_not_lose_each_other(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    create, late = published._Files.create, []

    def slow(self, name, text):
        if not late:  # another job publishes in between
            late.append(name)
            published.publish_range(rows(spark, ("b", 0, 5, 2)), path, BY, ("day", str(day(5)), str(day(6))))
        return create(self, name, text)

    monkeypatch.setattr(published._Files, "create", slow)
    published.publish_range(rows(spark, ("a", 0, 1, 1)), path, BY, ("day", str(day(1)), str(day(2))))
    assert late == ["manifests/1"] and seen(spark, path) == [("a", day(1), 1), ("b", day(5), 2)]


def test_rows_outside_the_range_are_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        published.publish_range(rows(spark, ("a", 0, 7, 1)), str(tmp_path), BY, ("day", str(day(0)), str(day(3))))
    with pytest.raises(FileNotFoundError):
        published.read_published(spark, str(tmp_path))
