"""One query per operator, on tables derived from the test tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fixtures import derived, table
from kpi_shift.functions import columns, dates
from kpi_shift.functions.stage import new_folder, stage
from kpi_shift.operators import alerts, audit, clean, context, events, impact, panels, score, tickets
from kpi_shift.plans import colocated, history, incremental
from kpi_shift.plans.monitoring import Run, monitor_panel, score_range
from kpi_shift.session import configure
from kpi_shift.sources import daily, published, quarantine, queue, sinks
from kpi_shift.spec import CARRIER, SECTOR, TOWER, Level, Monitor
from kpi_shift.streaming.compaction import compact, read_messages
from kpi_shift.streaming.keyed import alert_change_stream, standing_alerts
from kpi_shift.streaming.messages import append_to_files, parse_messages
from kpi_shift.streaming.scoring import read_alerts, score_stream

# six digits: at two, the engines round exact halves differently
MONITOR = replace(Monitor(), digits=6)
PROBLEM_TYPES = ("1-URGENT",)
AS_OF = "2024-01-31"
RANGE = ("2024-01-18", "2024-01-28")
SCAN_DAYS = ("2023-12-30", "2024-01-14")
TICKET_DAY = "2024-01-20"
# first days of the runs that keep the ticket history, and its end
HISTORY_RUNS = ("2024-01-01", "2024-01-18", "2024-01-19", "2024-02-20")
BUCKETS = 8
LISTED_AS_OF = "2024-02-08"
SNAPSHOT_DAY = "2024-01-16"
WEEKDAY_TABLES = ("click", "view")
# days whose files are cut in the middle
CUT_DAYS = ("2024-01-03", "2024-01-11")
# Days on which weekday tables are not expected.
HOLIDAYS = ("2023-11-14", "2023-11-23", "2023-11-24", "2023-11-27", "2023-12-25", "2023-12-26", "2024-01-01", "2024-01-02", "2024-01-15")
# the last one never loads
DELAYS = {"click": 1, "error": 2, "purchase": 1, "signup": 1, "view": 3, "refund": 1}
LINK = "https://example.org/tower?id="


def _panel(spark: SparkSession, sf_dir: str, name: str = "kpi_panel") -> DataFrame:
    """The KPI panel as a written table, as it is in production: every run scans it several times."""
    configure(spark)
    return stage(derived(spark, sf_dir, name), name)


def _events(panel: DataFrame) -> DataFrame:
    return stage(events.detect_events(panel, TOWER, MONITOR), "events")


def _run(spark: SparkSession, sf_dir: str) -> Run:
    return monitor_panel(_panel(spark, sf_dir), TOWER, MONITOR)


def _finer_run(spark: SparkSession, sf_dir: str, level: Level) -> Run:
    tower_events = _events(_panel(spark, sf_dir))
    panel = _panel(spark, sf_dir, f"{level.name}_panel")
    return monitor_panel(panel, level, MONITOR, tower_events)


def date_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "events").select(F.to_date("ts").alias("run_day")).distinct()
    return days.select("run_day", F.explode(dates.days_around("run_day", -14, 0)).alias("day"))


def clean_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_rows(derived(spark, sf_dir, "kpi_raw"), "tower", ["kpi"], ["rtp_gap"])


def vendor_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clean.vendor_activity(derived(spark, sf_dir, "kpi_panel"), MONITOR)
    return rows.select("tower", "day", F.round("old_activity", 6).alias("old_activity"), F.round("new_activity", 6).alias("new_activity"))


def silent_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = _panel(spark, sf_dir)
    return clean.silent_to_null(panel, MONITOR.new_columns, ["tower", "day"])


def detect_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = _panel(spark, sf_dir)
    rows = events.event_rows(panel, events.detect_events(panel, TOWER, MONITOR), TOWER, MONITOR)
    return rows.withColumns({c: F.round(c, 6) for c in ("old_activity", "new_activity")})


def event_list_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = events.detect_events(derived(spark, sf_dir, "kpi_panel"), TOWER, MONITOR)
    return events.event_list_check(found, "2024-01-01", "2024-01-30")


def events_by_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = events.detect_events(derived(spark, sf_dir, "kpi_panel"), TOWER, MONITOR)
    return events.events_by_level(derived(spark, sf_dir, "sector_azimuth"), found, CARRIER)


def pre_event_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = _panel(spark, sf_dir)
    return panels.pre_event_panel(panel, _events(panel), TOWER, MONITOR)


def baseline_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.baseline_stats(pre_event_panel(spark, sf_dir), TOWER, MONITOR)


def post_event_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = _panel(spark, sf_dir)
    return panels.post_event_panel(panel, _events(panel), TOWER, MONITOR)


def score_post_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir).scored


def zero_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score.zero_override(_run(spark, sf_dir).scored, MONITOR)


def tower_coords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context.tower_coords(derived(spark, sf_dir, "tower_coords"), TOWER)


def sector_azimuth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context.sector_azimuth(derived(spark, sf_dir, "sector_azimuth"), SECTOR)


def latest_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tickets.latest_tickets(derived(spark, sf_dir, "tickets"), TICKET_DAY)


def open_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tickets.open_tickets(latest_tickets(spark, sf_dir), PROBLEM_TYPES)


def _near_tickets(spark: SparkSession, sf_dir: str, found: DataFrame) -> DataFrame:
    return tickets.tickets_near_tower(
        derived(spark, sf_dir, "tickets"), found, tower_coords(spark, sf_dir), TOWER, MONITOR, PROBLEM_TYPES
    )


def tickets_near_tower(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _near_tickets(spark, sf_dir, _events(_panel(spark, sf_dir)))


def _work_orders(spark: SparkSession, sf_dir: str, found: DataFrame) -> DataFrame:
    return tickets.work_orders_per_tower(derived(spark, sf_dir, "work_orders"), found, TOWER, MONITOR)


def work_orders_per_tower(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _work_orders(spark, sf_dir, _events(_panel(spark, sf_dir)))


def ticket_counts_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = (
        table(spark, sf_dir, "orders")
        .groupBy((F.col("o_custkey") % 150).cast("string").alias("enodeb_id"), F.col("o_orderdate").cast("date").alias("day"))
        .agg(F.count("*").alias("count"))
    )
    path = new_folder(spark, "ticket_counts")
    sinks.write_documents(records, path)
    return tickets.ticket_counts(daily.read_ticket_records(spark, path), TOWER)


def tower_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _run(spark, sf_dir)
    return context.tower_report(
        score.zero_override(run.scored, MONITOR),
        tower_coords(spark, sf_dir),
        _near_tickets(spark, sf_dir, run.events),
        _work_orders(spark, sf_dir, run.events),
        TOWER,
        MONITOR.digits,
    )


def _entity_report(spark: SparkSession, sf_dir: str, level: Level) -> DataFrame:
    scored = score.zero_override(_finer_run(spark, sf_dir, level).scored, MONITOR)
    azimuths = context.sector_azimuth(derived(spark, sf_dir, "sector_azimuth"), level)
    return context.entity_report(scored, azimuths, level, MONITOR.digits)


def sector_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _entity_report(spark, sf_dir, SECTOR)


def carrier_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _entity_report(spark, sf_dir, CARRIER)


def alert_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = alerts.alert_documents(tower_report(spark, sf_dir), TOWER, MONITOR, LINK, {"vendor": "new"})
    path = new_folder(spark, "documents")
    sinks.write_documents(docs, path)
    written = spark.read.schema(docs.schema).json(path)
    fields = {k.name: F.element_at("features", k.name) for k in MONITOR.kpis}
    flags = {k.alert: F.col(f"features_alert.{k.alert}") for k in MONITOR.kpis}
    return written.withColumns(fields | flags).drop("features", "features_alert")


def low_score_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    report, bus = new_folder(spark, "scores"), new_folder(spark, "bus")
    sinks.export_csv(table(spark, sf_dir, "events").select("event_id", "event_type", "value"), report)
    scores = daily.read_csv(spark, report, inferSchema=True)
    sinks.publish(alerts.low_score_messages(scores, "value", 5), "text", {"path": bus})
    messages = spark.read.text(bus)
    return messages.select(
        F.get_json_object("value", "$.event_id").cast("long").alias("event_id"),
        F.get_json_object("value", "$.event_type").alias("event_type"),
        F.get_json_object("value", "$.value").cast("double").alias("score"),
    )


def flatten_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = table(spark, sf_dir, "embeddings").select("label", F.struct("vec_id", "embedding").alias("data"))
    return impact.flatten_nested(nested)


def _failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = derived(spark, sf_dir, "call_failures")
    nested = flat.select("day", F.struct("cause_code", "enodeb", "msisdn", "from_uri").alias("data"))
    return impact.flatten_nested(nested)


def cause_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impact.cause_histogram(_failures(spark, sf_dir), "data_b_cause_code")


def normalise_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impact.normalise_failures(_failures(spark, sf_dir))


def impacted_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "users")
    sinks.write_parquet(impact.impacted_users(normalise_failures(spark, sf_dir), _run(spark, sf_dir).scored, TOWER), path)
    return spark.read.parquet(path)


def _expected_tables(spark: SparkSession) -> DataFrame:
    rows = [(name, delay, name in WEEKDAY_TABLES) for name, delay in DELAYS.items()]
    return spark.createDataFrame(rows, audit.EXPECTED_TABLES)


def table_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.table_freshness(derived(spark, sf_dir, "partition_days"), _expected_tables(spark), AS_OF)


def missing_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.missing_days(derived(spark, sf_dir, "partition_days"), _expected_tables(spark), AS_OF, HOLIDAYS)


def rows_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.rows_per_day(table(spark, sf_dir, "events"), "ts")


def latest_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.latest_days(table(spark, sf_dir, "events"), "ts")


def completeness_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = audit.completeness_report(derived(spark, sf_dir, "partition_days"), _expected_tables(spark), AS_OF, HOLIDAYS)
    days = F.transform("missing_days", lambda d: d.cast("string"))
    return report.withColumn("missing_days", F.array_join(days, ","))


def score_range_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_range(_panel(spark, sf_dir), new_folder(spark, "scores"), TOWER, MONITOR, *RANGE)


def dated_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = derived(spark, sf_dir, "kpi_raw")
    root = new_folder(spark, "daily")
    by_day = raw.withColumn("file_day", F.to_date("day", "MM/dd/yyyy"))
    by_day.write.partitionBy("file_day").option("header", True).csv(root)
    days = dates.date_window(SCAN_DAYS[0], end=SCAN_DAYS[1])
    return daily.read_daily_csv(spark, root + "/file_day={}", days, raw.columns, source_day="file_day")


def _zipped_days(spark: SparkSession, sf_dir: str) -> str:
    """Gzipped daily CSV files in dated folders."""
    root = new_folder(spark, "zipped")
    by_day = derived(spark, sf_dir, "kpi_raw").withColumn("file_day", F.to_date("day", "MM/dd/yyyy"))
    by_day.write.partitionBy("file_day").options(header=True, compression="gzip").csv(root)
    return root


def gzip_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _zipped_days(spark, sf_dir)
    return daily.read_csv(spark, f"{root}/file_day=2024-01-0*/*.csv.gz")


def csv_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files below a folder, their headers renamed."""
    rows = daily.read_csv_tree(spark, _zipped_days(spark, sf_dir), "*.csv.gz")
    return columns.rename_columns(rows, {"tower": "ENODEB", "kpi": "RTP"})


def csv_path_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions of a range of days, added up per file day by a callback."""
    root = new_folder(spark, "paths")
    by_day = derived(spark, sf_dir, "kpi_raw").withColumn("file_day", F.to_date("day", "MM/dd/yyyy"))
    by_day.write.partitionBy("file_day").option("header", True).csv(root)

    def counted(day_rows: DataFrame) -> DataFrame:
        return day_rows.groupBy("day", "market").agg(F.count("*").alias("n"), F.count_if(F.col("kpi") == "n/a").alias("unknown"))

    days = dates.date_window(SCAN_DAYS[0], end=SCAN_DAYS[1])
    return daily.read_daily_csv(spark, root + "/file_day={}", days, ["day", "market", "n", "unknown"], counted, distinct=False)


def _cut_in_half(spark: SparkSession, folder: str) -> None:
    """Cut the second half off all files of a folder."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(folder)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(at):
        if not status.getPath().getName().endswith(".gz"):
            continue
        stream = files.open(status.getPath())
        start = jvm.org.apache.commons.io.IOUtils.toByteArray(stream, status.getLen() // 2)
        stream.close()
        out = files.create(status.getPath(), True)
        out.write(start)
        out.close()


def _damaged_days(spark: SparkSession, sf_dir: str) -> quarantine.Sorted:
    """Gzipped daily files in which some records have a field too many or too few, and the files of two days are cut."""
    root = new_folder(spark, "damaged")
    raw = derived(spark, sf_dir, "kpi_raw").withColumn("file_day", F.to_date("day", "MM/dd/yyyy"))
    record = F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in ("tower", "day", "site", "market", "kpi")])
    record = F.when(F.col("kpi") == "7", F.concat(record, F.lit(",late"))).when(F.col("kpi") == "9", F.concat_ws(",", "day", "market")).otherwise(record)
    header = raw.select("file_day").distinct().select("file_day", F.lit("tower,day,site,market,kpi").alias("value"), F.lit(0).alias("place"))
    lines = header.unionByName(raw.select("file_day", record.alias("value"), F.lit(1).alias("place")))
    # one file per day, its header first
    lines = lines.repartition("file_day").sortWithinPartitions("file_day", "place").drop("place")
    lines.write.partitionBy("file_day").option("compression", "gzip").text(root)
    for day in CUT_DAYS:
        _cut_in_half(spark, f"{root}/file_day={day}")
    days = dates.date_window(SCAN_DAYS[0], end=SCAN_DAYS[1])
    return quarantine.read_daily_sorted(spark, root + "/file_day={}", days, raw.columns[:-1], source_day="file_day", distinct=False)


def sound_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of daily files of which some are damaged."""
    return _damaged_days(spark, sf_dir).rows


def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was set aside: days, and records of the other days."""
    return _damaged_days(spark, sf_dir).rejects.groupBy("day", "reason", "record").agg(F.count("*").alias("n"))


def dated_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_folder(spark, "dated")
    derived(spark, sf_dir, "snapshots").write.partitionBy("date").parquet(root)
    return daily.dated_partitions(spark.read.parquet(root), "2024-01-01", SNAPSHOT_DAY)


def listed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of dated files: days of the window for which no file is there."""
    loads = daily.list_dated_files(spark, _zipped_days(spark, sf_dir)).select(F.lit("raw files").alias("table_name"), "day")
    expected = spark.createDataFrame([("raw files", 1, False), ("other files", 1, True)], audit.EXPECTED_TABLES)
    return audit.missing_days(loads, expected, LISTED_AS_OF, HOLIDAYS)


def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_folder(spark, "snapshots")
    derived(spark, sf_dir, "snapshots").write.partitionBy("date").parquet(root)
    return daily.latest_snapshot(spark.read.parquet(root), SNAPSHOT_DAY)


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    at = F.col("ts").cast("timestamp")
    place = F.create_map(
        F.lit("latitude"), (F.col("user_id") % 90).cast("string"), F.lit("longitude"), (F.col("user_id") % 180).cast("string")
    )
    body = F.struct(
        F.length("event_type").alias("eventType"),
        place.alias("location"),
        F.unix_millis(at).alias("timestamp"),
        F.concat_ws("-", "event_type", "event_id").alias("data"),
    )
    return table(spark, sf_dir, "events").select(F.to_json(body).cast("binary").alias("value"))


def stream_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_messages(_messages(spark, sf_dir))


def stream_to_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, out = new_folder(spark, "messages"), new_folder(spark, "parsed")
    _messages(spark, sf_dir).write.parquet(source)
    parsed = parse_messages(spark.readStream.schema("value binary").parquet(source))
    append_to_files(parsed, out, new_folder(spark, "progress"), once=True).awaitTermination()
    return spark.read.schema(parsed.schema).json(out)


def queue_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages through the queue: half by a batch write, half by a stream, read as a stream's rows are."""
    queue.register(spark)
    messages, path, source = _messages(spark, sf_dir).select("value"), new_folder(spark, "queue"), new_folder(spark, "source")
    first = F.crc32(F.col("value").cast("binary")) % 2 == 0
    messages.filter(first).write.format(queue.FORMAT).mode("append").save(path)
    messages.filter(~first).write.parquet(source)
    rest = spark.readStream.schema(messages.schema).parquet(source).writeStream.format(queue.FORMAT).options(path=path, writer="rest")
    rest.option("checkpointLocation", new_folder(spark, "progress")).trigger(once=True).start().awaitTermination()
    return parse_messages(spark.read.format(queue.FORMAT).load(path))


def compacted_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages whose hourly folders were compacted between two arrivals; the later one brings more rows of compacted days."""
    source, out, path = new_folder(spark, "messages"), new_folder(spark, "parsed"), new_folder(spark, "compacted")
    progress = new_folder(spark, "progress")
    messages = _messages(spark, sf_dir)
    half = F.pmod(F.xxhash64("value"), F.lit(2))
    for part in (0, 1):
        messages.filter(half == part).write.mode("append").parquet(source)
        parsed = parse_messages(spark.readStream.schema("value binary").parquet(source))
        append_to_files(parsed, out, progress, once=True).awaitTermination()
        if not part:
            compact(spark, out, parsed.schema, path, "2024-01-01", "2024-01-21")
    return read_messages(spark, out, parsed.schema, path)


def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    source, out = new_folder(spark, "arriving"), new_folder(spark, "alerts")
    progress = new_folder(spark, "progress")
    panel = _panel(spark, sf_dir)
    run = monitor_panel(panel, TOWER, MONITOR)
    # the newest days arrive first
    for first, last in (("2024-01-25", "2024-12-31"), ("2024-01-20", "2024-01-24"), ("2000-01-01", "2024-01-19")):
        panel.filter(F.col("day").between(first, last)).write.mode("append").parquet(source)
        arriving = spark.readStream.schema(panel.schema).parquet(source)
        score_stream(arriving, lambda: run.baseline, out, progress, TOWER, MONITOR, once=True).awaitTermination()
    return read_alerts(spark, out)


def stream_withdrawn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts that stand after rows came one part after another, silent ones last."""
    configure(spark)
    source, out = new_folder(spark, "arriving"), new_folder(spark, "changes")
    progress = new_folder(spark, "progress")
    panel = _panel(spark, sf_dir)
    baseline = stage(monitor_panel(panel, TOWER, MONITOR).baseline, "baseline")
    silent = F.expr(f"coalesce({columns.row_sum(MONITOR.new_columns)} = 0, false)")
    for part in (panel.filter(~silent), panel.filter(silent)):
        part.write.mode("append").parquet(source)
        arriving = spark.readStream.schema(panel.schema).parquet(source)
        alert_change_stream(arriving, baseline, out, progress, TOWER, MONITOR, once=True, keep_days=4_000).awaitTermination()
    return standing_alerts(spark, out, TOWER)


def colocated_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run on a panel in catalog buckets."""
    configure(spark)
    path = new_folder(spark, "colocated_panel")
    stored = colocated.write_colocated(derived(spark, sf_dir, "kpi_panel"), path.rsplit("/", 1)[-1].replace("-", "_"), path, TOWER, BUCKETS)
    return colocated.monitor_colocated(stored, MONITOR).scored


def _kept_days(spark: SparkSession, sf_dir: str) -> str:
    """Event and baseline states, the newest days taken in first, one run after a correction."""
    panel, path = _panel(spark, sf_dir), new_folder(spark, "states")
    for start, end in (("2024-01-20", "2024-12-31"), ("2000-01-01", "2024-01-20"), ("2024-01-16", "2024-01-18")):
        incremental.advance(panel, path, TOWER, MONITOR, start, end)
    return path


def kept_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.kept_events(spark, _kept_days(spark, sf_dir))


def kept_baselines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.kept_baselines(spark, _kept_days(spark, sf_dir))


def _kept_tickets(spark: SparkSession, sf_dir: str) -> str:
    rows, path = stage(derived(spark, sf_dir, "tickets"), "tickets"), new_folder(spark, "history")
    for start, end in zip(HISTORY_RUNS, HISTORY_RUNS[1:]):
        history.advance_tickets(rows, path, start, end)
    return path


def ticket_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The open tickets of each run day, from the kept history."""
    configure(spark)
    spans = history.kept_spans(spark, _kept_tickets(spark, sf_dir), RANGE[0], problem_types=PROBLEM_TYPES)
    last = F.date_sub(F.lit(RANGE[1]).cast("date"), 1)
    days = F.sequence(F.greatest("first_day", F.lit(RANGE[0]).cast("date")), F.least("last_day", last))
    held = spans.filter((F.col("first_day") <= last)).withColumn("day", F.explode(days))
    return held.select("day", "trouble_id", "status", "create_date", "modified_date", "problem_type", "assigned_group")


def kept_tickets_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near tickets of a range of run days, from the kept history."""
    configure(spark)
    spans = history.kept_spans(spark, _kept_tickets(spark, sf_dir), RANGE[0], problem_types=PROBLEM_TYPES)
    near = tickets.spans_near_tower(spans, _events(_panel(spark, sf_dir)), tower_coords(spark, sf_dir), TOWER, MONITOR)
    return near.filter(f"day >= DATE'{RANGE[0]}' AND day < DATE'{RANGE[1]}'")


def published_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two publications of overlapping ranges; a third one was stopped before its last step."""
    panel, path = _panel(spark, sf_dir), new_folder(spark, "published")
    score_range(panel, path, TOWER, MONITOR, "2024-01-16", RANGE[1], published=True)
    score_range(panel, path, TOWER, MONITOR, RANGE[0], "2024-01-24", published=True)
    written = published.read_published(spark, path)
    published.write_version(written.limit(5), path, ["event_date", "day"])
    return published.read_published(spark, path).filter(f"day >= DATE'{RANGE[0]}' AND day < DATE'{RANGE[1]}'")


QUERIES = {
    "date_window": date_window,
    "clean_kpis": clean_kpis,
    "vendor_activity": vendor_activity,
    "silent_to_null": silent_to_null,
    "detect_events": detect_events,
    "event_list_check": event_list_check,
    "events_by_level": events_by_level,
    "pre_event_panel": pre_event_panel,
    "baseline_stats": baseline_stats,
    "post_event_panel": post_event_panel,
    "score_post_event": score_post_event,
    "zero_override": zero_override,
    "tower_coords": tower_coords,
    "sector_azimuth": sector_azimuth,
    "tower_report": tower_report,
    "sector_report": sector_report,
    "carrier_report": carrier_report,
    "latest_tickets": latest_tickets,
    "open_tickets": open_tickets,
    "tickets_near_tower": tickets_near_tower,
    "work_orders_per_tower": work_orders_per_tower,
    "ticket_counts_json": ticket_counts_json,
    "alert_documents": alert_documents,
    "low_score_messages": low_score_messages,
    "flatten_nested": flatten_nested,
    "cause_histogram": cause_histogram,
    "normalise_failures": normalise_failures,
    "impacted_users": impacted_users,
    "table_freshness": table_freshness,
    "missing_days": missing_days,
    "rows_per_day": rows_per_day,
    "latest_days": latest_days,
    "completeness_report": completeness_report,
    "score_range": score_range_query,
    "dated_scan": dated_scan,
    "gzip_glob": gzip_glob,
    "csv_tree": csv_tree,
    "csv_path_list": csv_path_list,
    "sound_rows": sound_rows,
    "rejects": rejects,
    "dated_partitions": dated_partitions,
    "listed_days": listed_days,
    "latest_snapshot": latest_snapshot,
    "stream_parse": stream_parse,
    "stream_to_files": stream_to_files,
    "queue_messages": queue_messages,
    "compacted_messages": compacted_messages,
    "stream_score": stream_score,
    "stream_withdrawn": stream_withdrawn,
    "colocated_scores": colocated_scores,
    "published_scores": published_scores,
    "kept_events": kept_events,
    "kept_baselines": kept_baselines,
    "ticket_history": ticket_history,
    "kept_tickets_near": kept_tickets_near,
}
