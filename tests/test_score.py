import statistics

import pytest

from kpi_shift.operators import panels, score
from kpi_shift.spec import SECTOR, TOWER
from tests.helpers import MONITOR, as_set, day, panel, panel_row

EVENT = 20


def listed(spark, *rows):
    return spark.createDataFrame([(t, day(n)) for t, n in rows], "tower string, event_date date")


def scored(spark, rows, *event_list):
    df, found = panel(spark, rows), listed(spark, *event_list)
    baseline = panels.baseline_stats(panels.pre_event_panel(df, found, TOWER, MONITOR), TOWER, MONITOR)
    return score.score_post_event(panels.post_event_panel(df, found, TOWER, MONITOR), baseline, TOWER, MONITOR)


def test_windows_and_repeated_event_rows(spark):
    df = panel(spark, [panel_row("a", n, old=1.0, new=1.0) for n in range(60)])
    found = listed(spark, ("a", EVENT), ("a", EVENT), ("a", EVENT + 20))
    pre = panels.pre_event_panel(df, found, TOWER, MONITOR)
    post = panels.post_event_panel(df, found, TOWER, MONITOR)
    expected_pre = [(day(e), day(n)) for e in (EVENT, EVENT + 20) for n in range(e - 14, e)]
    expected_post = [(day(e), day(n)) for e in (EVENT, EVENT + 20) for n in range(e, e + 15)]
    assert as_set(pre, "event_date", "day") == sorted(expected_pre, key=repr)
    assert as_set(post, "event_date", "day") == sorted(expected_post, key=repr)
    part = panels.post_event_panel(df, found, TOWER, MONITOR, str(day(30)), str(day(32)))
    assert as_set(part, "event_date", "day") == [(day(20), day(30)), (day(20), day(31))]


def test_silent_rule_differs_before_and_after(spark):
    df = panel(spark, [panel_row("a", 19, old=0.0, shared=1.0), panel_row("a", 18, old=0.0, shared=0.0), panel_row("a", 20, new=0.0, shared=1.0)])
    found = listed(spark, ("a", EVENT))
    # before: all KPIs have to be zero, and all are nulled; after: the unshared ones
    assert as_set(panels.pre_event_panel(df, found, TOWER, MONITOR), "day", "dl_data_volume", "rtp_gap") == [
        (day(18), None, None),
        (day(19), 0.0, 1.0),
    ]
    assert as_set(panels.post_event_panel(df, found, TOWER, MONITOR), "dl_data_volume", "rtp_gap") == [(None, 1.0)]


def test_baseline_is_rounded_mean_and_sample_deviation(spark):
    values = [1.0, 2.0, 4.0]
    df = panel(spark, [panel_row("a", 17 + i, old=v) for i, v in enumerate(values)] + [panel_row("b", 19, old=3.0)])
    found = listed(spark, ("a", EVENT), ("b", EVENT))
    baseline = panels.baseline_stats(panels.pre_event_panel(df, found, TOWER, MONITOR), TOWER, MONITOR)
    assert as_set(baseline, "tower", "dl_data_volume_avg", "dl_data_volume_std") == [
        ("a", round(sum(values) / 3, 2), round(statistics.stdev(values), 2)),
        ("b", 3.0, None),
    ]


def one(df, *columns):
    rows = df.select(*columns).collect()
    assert len(rows) == 1
    return tuple(rows[0])


def test_rising_and_falling_alerts(spark):
    history = [panel_row("a", n, old=10.0 + (n % 2), shared=10.0) for n in range(6, 20)]
    # mean 10.5, deviation 0.52: the percentage threshold is laxer, 11.55 and 9.45
    row = scored(spark, history + [panel_row("a", EVENT, new=11.5, shared=10.0)], ("a", EVENT))
    assert one(row, "abnormal_kpi", "has_abnormal_kpi") == (0, 0)
    row = scored(spark, history + [panel_row("a", EVENT, new=11.6, shared=30.0)], ("a", EVENT))
    alerts = one(row, *[f"{k}_alert" for k in ("rrc_setup_failure", "bearer_drop_rate", "sip_dc_rate", "rtp_gap", "dl_data_volume")])
    assert alerts == (1, 1, 1, 1, 0)
    # twice the mean is beyond -1 and clamped there
    assert one(row, "rtp_gap_change_rate", "rrc_setup_failure_change_rate", "abnormal_kpi") == (-1.0, -0.1, 4)
    row = scored(spark, history + [panel_row("a", EVENT, new=9.4, shared=10.0)], ("a", EVENT))
    # the number of users never alerts
    assert one(row, "dl_data_volume_alert", "uptp_user_perceived_throughput_alert", "avgconnected_users_alert") == (1, 1, 0)
    assert one(row, "abnormal_kpi", "dl_data_volume_change_rate") == (2, -0.1)
    row = scored(spark, history + [panel_row("a", EVENT, new=40.0, shared=10.0)], ("a", EVENT))
    assert one(row, "dl_data_volume_change_rate") == (1.0,)


def test_deviation_threshold_when_laxer(spark):
    history = [panel_row("a", n, old=10.0 + 4 * (n % 2)) for n in range(6, 20)]
    # mean 12, deviation 2.08: 16.16 and 7.84
    row = scored(spark, history + [panel_row("a", EVENT, new=16.1)], ("a", EVENT))
    assert one(row, "rrc_setup_failure_alert") == (0,)
    row = scored(spark, history + [panel_row("a", EVENT, new=7.8)], ("a", EVENT))
    assert one(row, "dl_data_volume_alert") == (1,)


def test_missing_and_zero_baselines(spark):
    single = [panel_row("single", 19, old=10.0), panel_row("single", EVENT, new=11.5)]
    zero = [panel_row("zero", n, old=0.0, old_avgconnected_users=5.0) for n in (18, 19)] + [panel_row("zero", EVENT, new=1.0)]
    silent = [panel_row("silent", n, old=0.0, shared=0.0) for n in (18, 19)] + [panel_row("silent", EVENT, new=1.0)]
    found = [(t, EVENT) for t in ("single", "zero", "silent")]
    rows = scored(spark, single + zero + silent, *found)
    result = {r.tower: r for r in rows.collect()}
    # no deviation from one day: the percentage alone decides
    assert result["single"].rrc_setup_failure_alert == 1
    # nothing to divide by, but a threshold of zero to exceed
    assert (result["zero"].rrc_setup_failure_change_rate, result["zero"].rrc_setup_failure_alert) == (None, 1)
    assert (result["silent"].rrc_setup_failure_avg, result["silent"].abnormal_kpi) == (None, 0)


def test_values_are_judged_unrounded(spark):
    history = [panel_row("a", n, old=10.0) for n in (18, 19)]
    row = scored(spark, history + [panel_row("a", EVENT, new=11.001, shared=1.0)], ("a", EVENT))
    assert one(row, "rrc_setup_failure", "rrc_setup_failure_alert") == (11.0, 1)


def test_zero_override(spark):
    rows = scored(spark, [panel_row("a", 19, old=10.0), panel_row("a", EVENT, new=1.0)], ("a", EVENT))
    flagged = rows.withColumns({n: rows.rtp_gap * 0 for n in MONITOR.names})
    assert one(score.zero_override(flagged, MONITOR), "abnormal_kpi", "has_abnormal_kpi", "event_day") == (2, 0, day(EVENT))
    assert one(score.zero_override(rows, MONITOR), "has_abnormal_kpi") == (1,)


def test_finer_level_has_its_own_baseline(spark):
    def sector(name, value, after):
        rows = [panel_row("a", n, old=value) for n in (18, 19)] + [panel_row("a", EVENT, new=after)]
        return [(r[0], name, *r[1:]) for r in rows]

    schema = "tower string, sector string, day date, site string, " + ", ".join(f"{c} double" for c in MONITOR.panel_columns)
    df = spark.createDataFrame(sector("1", 10.0, 10.0) + sector("2", 50.0, 10.0), schema)
    found = listed(spark, ("a", EVENT))
    baseline = panels.baseline_stats(panels.pre_event_panel(df, found, SECTOR, MONITOR), SECTOR, MONITOR)
    rows = score.score_post_event(panels.post_event_panel(df, found, SECTOR, MONITOR), baseline, SECTOR, MONITOR)
    assert as_set(rows, "sector", "dl_data_volume_alert") == [("1", 0), ("2", 1)]
    assert rows.filter("sector = 2").first().dl_data_volume_change_rate == pytest.approx(-0.8)
