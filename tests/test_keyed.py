from pyspark.sql import functions as F

from kpi_shift.operators.panels import baseline_stats, post_event_panel, pre_event_panel
from kpi_shift.operators.score import score_post_event
from kpi_shift.spec import TOWER
from kpi_shift.streaming.keyed import alert_change_stream, standing_alerts
from tests.helpers import MONITOR, as_set, day, panel, panel_row

HISTORY = [panel_row(t, n, old=10.0, shared=1.0 + n % 2) for t in "abc" for n in range(6, 20)]
EVENTS = [(t, day(20)) for t in "abc"]


def setting(spark, tmp_path):
    found = spark.createDataFrame(EVENTS, "tower string, event_date date")
    path = str(tmp_path / "baseline")
    baseline_stats(pre_event_panel(panel(spark, HISTORY), found, TOWER, MONITOR), TOWER, MONITOR).write.parquet(path)
    return found, spark.read.parquet(path)


def arrive(spark, folder, baseline, rows, **options):
    panel(spark, rows).coalesce(1).write.mode("append").parquet(str(folder / "in"))
    arriving = spark.readStream.schema(panel(spark, []).schema).parquet(str(folder / "in"))
    out = str(folder / "out")
    alert_change_stream(arriving, baseline, out, str(folder / "progress"), TOWER, MONITOR, once=True, **options).awaitTermination()
    return standing_alerts(spark, out, TOWER)


def in_one_pass(rows, found, baseline):
    scored = score_post_event(post_event_panel(rows, found, TOWER, MONITOR), baseline, TOWER, MONITOR)
    keys = ["tower", "event_date", "day"]
    rest = [c for c in scored.columns if c not in keys]
    best = scored.filter("has_abnormal_kpi = 1").groupBy(*keys).agg(F.max(F.struct(*rest)).alias("row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"row.{c}").alias(c) for c in scored.columns])


def test_equals_one_pass_in_any_order_and_withdraws(spark, settings, tmp_path):
    settings(shuffle__partitions="2")
    found, baseline = setting(spark, tmp_path)
    high, higher = panel_row("a", 21, new=20.0), panel_row("a", 21, new=30.0, site=None)
    silent = panel_row("a", 21, new=0.0, site="T")
    shared = panel_row("b", 22, new=0.0, shared=50.0)  # silent, and abnormal by the shared KPIs
    loud = panel_row("b", 22, new=40.0)
    rows = [high, higher, silent, shared, loud, panel_row("c", 20, new=20.0), panel_row("c", 40, new=20.0), panel_row(None, 21, new=20.0)]
    wanted = in_one_pass(panel(spark, HISTORY + rows), found, baseline)
    columns = wanted.columns
    expected = as_set(wanted)
    assert {(r[0], r[columns.index("day")]) for r in expected} == {("b", day(22)), ("c", day(20))}
    forth = tmp_path / "forth"
    assert {r.tower for r in arrive(spark, forth, baseline, [high, loud]).collect()} == {"a", "b"}
    assert as_set(arrive(spark, forth, baseline, [silent, shared, higher, *rows[5:]]).select(columns)) == expected
    back = tmp_path / "back"
    arrive(spark, back, baseline, rows[:1:-1])
    assert as_set(arrive(spark, back, baseline, rows[:2]).select(columns)) == expected
    # what comes again changes nothing
    before = spark.read.parquet(str(back / "out")).count()
    assert as_set(arrive(spark, back, baseline, rows).select(columns)) == expected
    assert spark.read.parquet(str(back / "out")).count() == before


def test_greatest_row_of_a_key_stands(spark, settings, tmp_path):
    settings(shuffle__partitions="2")
    found, baseline = setting(spark, tmp_path)
    rows = [panel_row("a", 21, new=v, site=s) for v, s in ((20.0, "S"), (30.0, None), (25.0, "T"))]
    wanted = in_one_pass(panel(spark, HISTORY + rows), found, baseline)
    for row in (rows[1], rows[0], rows[2]):
        standing = arrive(spark, tmp_path, baseline, [row])
    assert as_set(standing.select(wanted.columns)) == as_set(wanted)


def test_rows_beyond_the_watermark_are_dropped(spark, settings, tmp_path):
    settings(shuffle__partitions="2")
    _, baseline = setting(spark, tmp_path)
    for row in (panel_row("a", 21, new=20.0), panel_row("c", 32, new=20.0), panel_row("a", 21, new=0.0)):
        standing = arrive(spark, tmp_path, baseline, [row], keep_days=5)
    assert {r.tower for r in standing.collect()} == {"a", "c"}
