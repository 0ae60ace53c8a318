import json

from kpi_shift.operators import alerts, context
from kpi_shift.spec import CARRIER, SECTOR, TOWER
from tests.helpers import MONITOR, as_set, day


def test_tower_coords_picks_one_whole_position(spark):
    rows = [("12345", "30.5", "-97"), ("012345", "31.5", "-98"), ("7", None, "1"), (None, "1", "1"), ("8", "x", "1"), ("8", "2", "1")]
    coords = context.tower_coords(spark.createDataFrame(rows, "tower string, latitude string, longitude string"), TOWER)
    assert as_set(coords, "tower", "latitude", "longitude") == [("000008", 2.0, 1.0), ("012345", 31.5, -98.0)]


def test_sector_azimuth_by_level(spark):
    rows = [("1", "1", "1", 10), ("1", "1", "2", 10), ("1", "1", "2", 20)]
    inventory = spark.createDataFrame(rows, "tower string, sector string, carrier string, azimuth_deg int")
    assert as_set(context.sector_azimuth(inventory, SECTOR)) == [("000001", "1", 10), ("000001", "1", 20)]
    assert len(as_set(context.sector_azimuth(inventory, CARRIER))) == 3


def test_tower_report_keeps_all_rows(spark):
    scored = spark.createDataFrame(
        [("a", day(0), day(1), 0.123456), ("a", day(0), day(2), 1.0), ("b", day(0), day(1), 2.0)],
        "tower string, event_date date, day date, Rate double",
    )
    coords = spark.createDataFrame([("a", 30.0, -97.0)], "tower string, latitude double, longitude double")
    near = spark.createDataFrame([("a", day(0), day(1), 4)], "tower string, event_date date, day date, nrb_ticket_counts long")
    ready = spark.createDataFrame([("b", 9)], "tower string, w360_ticket_counts long")
    report = context.tower_report(scored, coords, near, ready, TOWER)
    assert as_set(report, "tower", "day", "rate", "latitude", "nrb_ticket_counts", "w360_ticket_counts") == [
        ("a", day(1), 0.1235, 30.0, 4, None),
        ("a", day(2), 1.0, 30.0, None, None),
        ("b", day(1), 2.0, None, None, 9),
    ]


def test_entity_report(spark):
    rows = [("a", "1", None), ("a", "1", None), ("a", "0", 1.0), ("b", "2", 0.5)]
    scored = spark.createDataFrame(rows, "tower string, sector string, rtp_gap_change_rate double")
    azimuths = spark.createDataFrame([("a", "1", 10), ("a", "1", 20)], "tower string, sector string, azimuth_deg int")
    assert as_set(context.entity_report(scored, azimuths, SECTOR), "tower", "rtp_gap_change_rate", "azimuth_deg") == [
        ("a", 0.0, 10),
        ("a", 0.0, 20),
        ("b", 0.5, None),
    ]


def test_alert_documents(spark):
    names, flags = MONITOR.names, MONITOR.alerts
    schema = (
        "tower string, day date, event_day date, site string, region string, abnormal_kpi int, has_abnormal_kpi int, "
        "nrb_ticket_counts long, w360_ticket_counts long, "
        + ", ".join([f"{n} double" for n in names] + [f"{f} int" for f in flags])
    )
    raised = [1, 0, 0, 1, 0, 0, 0]
    values = [1.5, 2.0, 3.0, 0.25, 5.0, None, 7.0]
    rows = [("a", day(1), day(0), "S", "R", 2, 1, 3, None, *values, *raised), ("b", day(1), day(0), "S", "R", 0, 0, 3, 1, *values, *[0] * 7)]
    docs = alerts.alert_documents(spark.createDataFrame(rows, schema), TOWER, MONITOR, "https://x/?t=", {"vendor": "new"})
    assert docs.columns == [
        "enodeb", "alert_day", "event_day", "site", "region", "abnormal_kpi_count", "nrb_ticket_counts",
        "w360_ticket_counts", "vendor", "features", "features_alert", "link",
    ]
    (doc,) = docs.collect()
    assert doc.features == {"sip_dc_rate": 1.5, "rtp_gap": 0.25}
    assert doc.features_alert.asDict() == dict(zip(flags, raised))
    assert (doc.enodeb, doc.link, doc.vendor, doc.abnormal_kpi_count) == ("a", "https://x/?t=a", "new", 2)


def test_low_score_messages(spark):
    df = spark.createDataFrame([("a", 84.9), ("b", 85.0), ("c", None)], "id string, AVG_SCORE_1_3 double")
    (row,) = alerts.low_score_messages(df, "AVG_SCORE_1_3").collect()
    assert json.loads(row.value) == {"id": "a", "AVG_SCORE_1_3": 84.9}
