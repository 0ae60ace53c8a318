import json
from datetime import date

from pyspark.sql import functions as F

from kpi_shift.operators.panels import baseline_stats, post_event_panel, pre_event_panel
from kpi_shift.operators.score import score_post_event
from kpi_shift.spec import TOWER
from kpi_shift.streaming.messages import append_to_files, parse_messages
from kpi_shift.streaming.scoring import read_alerts, score_stream
from tests.helpers import MONITOR, as_set, day, panel, panel_row


def messages(spark):
    good = {"eventType": 3, "location": {"latitude": "30.1", "longitude": "-97"}, "timestamp": 1704272584678, "data": "d"}
    no_place = good | {"location": None, "timestamp": 1704276184000}
    rows = [(json.dumps(m).encode(),) for m in (good, no_place)] + [(b"not json",)]
    return spark.createDataFrame(rows, "value binary")


def test_parse(spark):
    parsed = parse_messages(messages(spark))
    assert as_set(parsed, "eventType", "date_parsed", "latitude", "longitude", "hour", "date") == [
        (3, "2024-01-03 09:03:04", "30.1", "-97", 9, date(2024, 1, 3)),
        (3, "2024-01-03 10:03:04", None, None, 10, date(2024, 1, 3)),
        (None, None, None, None, None, None),
    ]


def test_file_stream_equals_batch(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    messages(spark).write.parquet(source)
    parsed = parse_messages(spark.readStream.schema("value binary").parquet(source))
    for _ in range(2):  # the second run finds nothing new
        append_to_files(parsed, out, str(tmp_path / "progress"), once=True).awaitTermination()
    batch = parse_messages(spark.read.parquet(source))
    assert as_set(spark.read.schema(parsed.schema).json(out).select(batch.columns)) == as_set(batch)
    assert list((tmp_path / "out" / "date=2024-01-03" / "hour=9").glob("*.json.gz"))


def test_scores_each_alert_once_however_late(spark, tmp_path):
    history = [panel_row(t, n, old=10.0) for t in "abc" for n in range(6, 20)]
    after = [panel_row("a", n, new=20.0) for n in (28, 21, 20)] + [panel_row("b", 20, new=10.0), panel_row("b", 21, new=0.0)]
    everything = panel(spark, history + after)
    events = [("a", day(20)), ("b", day(20))]
    source, out = str(tmp_path / "in"), str(tmp_path / "out")

    def baseline():
        found = spark.createDataFrame(events, "tower string, event_date date")
        return baseline_stats(pre_event_panel(everything, found, TOWER, MONITOR), TOWER, MONITOR)

    def arrive(*rows):
        panel(spark, list(rows)).write.mode("append").parquet(source)
        arriving = spark.readStream.schema(everything.schema).parquet(source)
        score_stream(arriving, baseline, out, str(tmp_path / "progress"), TOWER, MONITOR, once=True).awaitTermination()
        return read_alerts(spark, out)

    def batch(rows):
        found = spark.createDataFrame(events, "tower string, event_date date")
        post = post_event_panel(rows, found, TOWER, MONITOR)
        return score_post_event(post, baseline(), TOWER, MONITOR).filter(F.col("has_abnormal_kpi") == 1)

    columns = batch(everything).columns
    arrive(*history, after[0])
    assert as_set(arrive(*after[1:]).select(columns)) == as_set(batch(everything))
    # a row that is published again raises no second alert
    assert as_set(arrive(after[2], after[2]).select(columns)) == as_set(batch(everything))
    # an event found after the start counts for the rows that follow
    events.append(("c", day(20)))
    late = panel_row("c", 22, new=20.0)
    everything = panel(spark, history + after + [late])
    assert as_set(arrive(late).select(columns)) == as_set(batch(everything))
