"""From raw files to alert documents, day by day and all at once."""

import csv
import re

import pytest
from pyspark.sql import functions as F

from kpi_shift.operators import audit, context
from kpi_shift.operators.impact import CAUSE_CODES
from kpi_shift.plans import jobs
from kpi_shift.plans.monitoring import monitor_panel
from kpi_shift.sources import sinks
from kpi_shift.spec import CATEGORICAL, RAW_COLUMNS, SECTOR, TOWER
from tests.helpers import MONITOR, as_set, day

RAW = {name: raw for raw, name in RAW_COLUMNS.items()}


def raw_values(tower, n, sector=None):
    """Tower 1 switches on day 16, tower 2 on day 18 and gets worse, tower 3 never."""
    switch = {1: 16, 2: 18, 3: 99}[tower]
    worse = 5 if tower == 2 and n >= switch else 1
    row = {RAW["day"]: day(n).strftime("%m/%d/%Y"), RAW["tower"]: str(tower)}
    row |= {RAW[c]: f"{c} {tower}" for c in CATEGORICAL}
    row |= {RAW[c]: "0" if n >= switch else str(10 + n % 3) for c in MONITOR.old_columns}
    row |= {RAW[c]: str((10 + n % 3) * worse) if n >= switch else "0" for c in MONITOR.new_columns}
    row |= {RAW["sip_dc_rate"]: str(1 + n % 2)}
    if n > 5:  # the late column
        row[RAW["rtp_gap"]] = "1"
    if sector is not None:
        row[RAW["sector"]] = sector
    return row


def write_days(folder, sectors=(None,)):
    for n in range(0, 26):
        if n == 7:
            continue  # a day that never arrived
        rows = [raw_values(t, n, s) for t in (1, 2, 3) for s in sectors]
        rows.append(rows[0] | {RAW["site"]: rows[0][RAW["site"]][:4]})
        rows.append(rows[0] | {RAW["tower"]: "*"})
        with open(folder / f"kpi_{day(n)}.csv", "w", newline="") as out:
            writer = csv.DictWriter(out, rows[0].keys())
            writer.writeheader()
            writer.writerows(rows)
    return str(folder / "kpi_{}.csv")


def test_daily_runs_equal_one_backfill(spark, tmp_path):
    pattern = write_days(tmp_path)
    out = str(tmp_path / "daily")
    checks = []
    for n in range(16, 20):
        start, end = str(day(n)), str(day(n + 1))
        panel = jobs.load_panel(spark, pattern, TOWER, MONITOR, start, end)
        checks += jobs.pre_event_job(panel, out, TOWER, MONITOR, start, end).collect()
        events = spark.read.parquet(f"{out}/{jobs.EVENTS}")
        baseline = spark.read.parquet(f"{out}/{jobs.BASELINE}")
        jobs.post_event_job(panel, events, baseline, out, TOWER, MONITOR, start, end)
    assert [(c.event_date, c.n_events) for c in checks if not c.is_empty] == [(day(16), 1), (day(18), 1)]
    scores = spark.read.parquet(f"{out}/{jobs.SCORES}")
    assert as_set(scores.groupBy("tower", "event_date").count()) == [("000001", day(16), 4), ("000002", day(18), 2)]

    whole = str(tmp_path / "whole")
    start, end = str(day(16)), str(day(20))
    panel = jobs.load_panel(spark, pattern, TOWER, MONITOR, start, end)
    assert as_set(panel.filter(F.col("tower") == "000001").select("site").distinct()) == [("site 1",)]
    assert panel.filter(F.col("day") == day(3)).first().rtp_gap == 0.0
    jobs.pre_event_job(panel, whole, TOWER, MONITOR, start, end)
    events, baseline = (spark.read.parquet(f"{whole}/{t}") for t in (jobs.EVENTS, jobs.BASELINE))
    jobs.post_event_job(panel, events, baseline, whole, TOWER, MONITOR, start, end)
    again = spark.read.parquet(f"{whole}/{jobs.SCORES}")
    assert as_set(again.select(scores.columns)) == as_set(scores)
    in_memory = monitor_panel(panel, TOWER, MONITOR, start=start, end=end).scored
    assert as_set(in_memory) == as_set(scores.select(in_memory.columns))

    none = events.limit(0).select("tower", "event_date")
    no_tickets = none.selectExpr("*", "event_date AS day", "0L AS nrb_ticket_counts")
    no_orders = none.selectExpr("*", "event_date AS day", "0L AS w360_ticket_counts")
    coords = spark.createDataFrame([("000002", 30.0, -97.0)], "tower string, latitude double, longitude double")

    def report(scored, cohorts):
        return context.tower_report(scored, coords, no_tickets, no_orders, TOWER)

    jobs.post_event_job(panel, events, baseline, str(tmp_path / "report"), TOWER, MONITOR, start, end, report)
    reported = spark.read.parquet(str(tmp_path / "report" / jobs.SCORES))
    docs = str(tmp_path / "docs")
    jobs.alert_job(reported, docs, TOWER, MONITOR, str(day(19)), "https://x/?t=", {"vendor": "new"})
    (doc,) = spark.read.json(docs).collect()
    assert (doc.enodeb, doc.event_day, doc.abnormal_kpi_count, doc.site) == ("000002", str(day(18)), 2, "site 2")
    assert "bearer_drop_rate" in doc.features and "sip_dc_rate" not in doc.features


def test_sector_job_takes_tower_events(spark, tmp_path):
    pattern = write_days(tmp_path, sectors=("0", "1", "2"))
    start, end = str(day(16)), str(day(20))
    panel = jobs.load_panel(spark, pattern, SECTOR, MONITOR, start, end)
    assert as_set(panel.select("sector").distinct()) == [("1",), ("2",)]
    events = spark.createDataFrame([("000002", day(18)), ("000001", day(2))], "tower string, event_date date")
    out = str(tmp_path / "out")
    jobs.pre_event_job(panel, out, SECTOR, MONITOR, start, end, events)
    baseline = spark.read.parquet(f"{out}/{jobs.BASELINE}")
    assert as_set(baseline, "tower", "sector") == [("000002", "1"), ("000002", "2")]
    jobs.post_event_job(panel, events, baseline, out, SECTOR, MONITOR, start, end)
    assert spark.read.parquet(f"{out}/{jobs.SCORES}").count() == 4


def test_whole_chain_from_files_to_documents_and_users(spark, tmp_path):
    pattern, out = write_days(tmp_path), str(tmp_path / "chain")
    inventory = spark.createDataFrame([("2", "30.0", "-97.0"), ("1", "30.5", "-97.5")], "tower string, latitude string, longitude string")
    ticket = (1, "Open", day(19), day(19), "30.001", "-97.0", "type", "NRB")
    tickets = spark.createDataFrame([ticket], "trouble_id long, status string, create_date date, modified_date date, lat string, lng string, problem_type string, assigned_group string")
    order = (9, "OPEN", f"{day(18)} 06:30:00", None, "0000021234", "30", "-97", day(19))
    orders = spark.createDataFrame([order], "noc_id long, status string, event_start string, event_end string, cell_id string, lat string, lng string, data_date date")
    # the first days have no event yet: their tables are there, and empty
    for n in (14, 16, 18, 19):
        start, end = str(day(n)), str(day(n + 1))
        first = day(0) if n == 14 else day(n - 1)
        panel = jobs.ingest_job(spark, pattern, out, TOWER, MONITOR, str(first), end)
        jobs.pre_event_job(panel, out, TOWER, MONITOR, start, end)
        events, baseline = (sinks.read_partitions(spark, f"{out}/{t}") for t in (jobs.EVENTS, jobs.BASELINE))
        assert n > 14 or events.count() == baseline.count() == 0
        jobs.post_event_job(panel, events, baseline, out, TOWER, MONITOR, start, end)
        report = jobs.tower_report_job(out, inventory, tickets, orders, TOWER, MONITOR, start, end)
        assert n > 14 or report.count() == 0
    assert re.search(r"PartitionFilters: \[[^]]*day", panel.filter(f"day = DATE'{day(3)}'")._jdf.queryExecution().toString())
    docs = str(tmp_path / "documents")
    jobs.alert_job(report, docs, TOWER, MONITOR, str(day(19)), "https://x/?t=", {"vendor": "new"})
    (doc,) = spark.read.json(docs).collect()
    assert (doc.enodeb, doc.nrb_ticket_counts, doc.w360_ticket_counts) == ("000002", 1, 1)
    failures = spark.createDataFrame(
        [(day(19), (f"{code}-x", "000002_1", "1" + "5" * 10, "tel:+1" + "6" * 10)) for code in CAUSE_CODES],
        "day date, data struct<cause_code:string,enodeb:string,msisdn:string,from_uri:string>",
    )
    jobs.impacted_users_job(failures, out, str(tmp_path / "users"), TOWER, str(day(19)))
    assert {r.tower for r in spark.read.parquet(str(tmp_path / "users")).collect()} == {"000002"}
    loads = sinks.read_partitions(spark, f"{out}/{jobs.PANEL}").select(F.lit("panel").alias("table_name"), "day").distinct()
    expected = spark.createDataFrame([("panel", 1, False)], audit.EXPECTED_TABLES)
    jobs.audit_job({"store": loads}, expected, str(tmp_path / "audit"), str(day(20)), [])
    (told,) = spark.read.parquet(str(tmp_path / "audit")).collect()
    # day 7 has no file; the window of 20 days is that of days 0 to 19
    assert (told.side, told.delayed_days, told.missing_days) == ("store", 0, [day(7)])


def test_ingest_refuses_rows_of_other_days(spark, tmp_path):
    pattern = write_days(tmp_path)
    (tmp_path / f"kpi_{day(3)}.csv").write_text((tmp_path / f"kpi_{day(4)}.csv").read_text())
    with pytest.raises(Exception, match="row of another day"):
        jobs.ingest_job(spark, pattern, str(tmp_path / "out"), TOWER, MONITOR, str(day(3)), str(day(4)))


def test_ingest_goes_on_past_a_damaged_day(spark, tmp_path):
    pattern, out = write_days(tmp_path), str(tmp_path / "out")
    whole = jobs.ingest_job(spark, pattern, str(tmp_path / "whole"), TOWER, MONITOR, str(day(2)), str(day(6)), keep_rejects=True)
    names = (tmp_path / f"kpi_{day(4)}.csv").read_text().splitlines()[0]
    (tmp_path / f"kpi_{day(3)}.csv").write_text("\n")
    with (tmp_path / f"kpi_{day(4)}.csv").open("a") as file:
        file.write("\n1,2\n" if "," in names else "")
    panel = jobs.ingest_job(spark, pattern, out, TOWER, MONITOR, str(day(2)), str(day(6)), keep_rejects=True)
    assert as_set(panel) == as_set(whole.filter(f"day <> DATE'{day(3)}'"))
    assert as_set(sinks.read_partitions(spark, f"{out}/{jobs.REJECTS}"), "day", "reason", "record") == [
        (day(3), "no header", None),
        (day(4), "malformed record", "1,2"),
    ]
    assert sinks.read_partitions(spark, f"{tmp_path}/whole/{jobs.REJECTS}").count() == 0
