from kpi_shift.operators import clean
from kpi_shift.spec import SECTOR, TOWER
from tests.helpers import MONITOR, as_set, day, panel, panel_row

NEW = MONITOR.new_columns


def test_clean_rows(spark):
    raw = spark.createDataFrame(
        [
            ("12345", "01/02/2024", "NEW YORK CITY", "1.5"),
            ("12345", "01/02/2024", "NEW YORK C", "1.5"),
            ("12345", "01/02/2024", "NEW YORK C", "1.5"),
            ("*", "01/02/2024", "X", "1"),
            (None, "01/02/2024", "X", "1"),
            ("1234567", "2024-01-02", "Y", "n/a"),
        ],
        "tower string, day string, site string, kpi string",
    )
    rows = clean.clean_rows(raw, "tower", ["kpi"], ["rtp_gap"])
    assert rows.columns == ["tower", "day", "site", "kpi", "rtp_gap"]
    assert as_set(rows) == [
        ("012345", day(1), "NEW YORK CITY", 1.5, 0.0),
        ("1234567", None, "Y", None, 0.0),
    ]


def test_clean_rows_keeps_rows_that_differ_in_more_than_the_site(spark):
    raw = spark.createDataFrame(
        [("1", "01/02/2024", "A", "1"), ("1", "01/02/2024", "AB", "2")], "tower string, day string, site string, kpi string"
    )
    assert len(as_set(clean.clean_rows(raw, "tower", ["kpi"]))) == 2


def test_clean_kpis_drops_placeholder_sector(spark):
    columns = ["tower", "sector", "day", "site", *[c for c in MONITOR.panel_columns if c != "rtp_gap"]]
    row = ["7", "0", "01/05/2024", "S"] + ["1"] * (len(columns) - 4)
    raw = spark.createDataFrame([tuple(row), tuple([row[0], "2", *row[2:]])], ", ".join(f"{c} string" for c in columns))
    cleaned = clean.clean_kpis(raw, SECTOR, MONITOR)
    assert as_set(cleaned, "tower", "sector", "rtp_gap", "new_dl_data_volume") == [("000007", "2", 0.0, 1.0)]


def test_vendor_activity_is_null_with_a_null_part(spark):
    rows = panel(spark, [panel_row("a", 0, 2.0, 3.0), panel_row("b", 0, 2.0, 3.0, old_dl_data_volume=None)])
    assert as_set(clean.vendor_activity(rows, MONITOR), "tower", "old_activity", "new_activity") == [
        ("a", 10.0, 15.0),
        ("b", None, 15.0),
    ]


def test_silent_to_null(spark):
    rows = panel(
        spark,
        [
            panel_row("gone", 0, new=0.0, site="zero"),
            panel_row("gone", 0, new=4.0, site="dropped"),
            panel_row("gone", 1, new=4.0),
            panel_row("cancel", 0, new=0.0, new_dl_data_volume=1.0, new_bearer_drop_rate=-1.0),
            panel_row("null", 0, new=0.0, new_dl_data_volume=None),
            panel_row(None, 0, new=0.0),
            panel_row(None, 0, new=5.0),
        ],
    )
    result = clean.silent_to_null(rows, NEW, ["tower", "day"])
    assert result.columns == rows.columns
    assert as_set(result, "tower", "day", "site", "new_dl_data_volume", "new_bearer_drop_rate") == sorted(
        [
            ("gone", day(0), "zero", None, None),
            ("gone", day(1), "S", 4.0, 4.0),
            ("cancel", day(0), "S", None, None),
            ("null", day(0), "S", None, 0.0),
            (None, day(0), "S", None, None),
            (None, day(0), "S", 5.0, 5.0),
        ],
        key=repr,
    )
    assert TOWER.ids == ("tower",)
