from pyspark.sql import functions as F

from kpi_shift.operators import impact
from kpi_shift.spec import TOWER
from tests.helpers import as_set, day, final_plan


def test_flatten_structs_arrays_and_maps(spark):
    schema = "id int, s struct<x:int, t:struct<y:string>>, a array<struct<z:int>>, b array<int>, m map<string,int>"
    rows = [
        (1, (10, ("q",)), [(1,), (2,)], [7, 8], {"k": 1}),
        (2, (20, None), [], [7], None),
        (3, None, [(5,)], None, None),
    ]
    df = spark.createDataFrame(rows, schema)
    flat = impact.flatten_nested(df)
    assert set(flat.columns) == {"id", "b", "m", "s_b_x", "s_b_t_b_y", "a_b_z"}
    assert as_set(flat, "id", "s_b_x", "s_b_t_b_y", "a_b_z", "b") == [
        (1, 10, "q", 1, 7),
        (1, 10, "q", 1, 8),
        (1, 10, "q", 2, 7),
        (1, 10, "q", 2, 8),
    ]
    assert flat.schema["m"].dataType.typeName() == "map"
    kept = impact.flatten_nested(df, keep_empty=True)
    assert as_set(kept.filter("id > 1"), "id", "s_b_x", "a_b_z", "b") == [(2, 20, None, 7), (3, None, 5, None)]


def test_flatten_leaves_flat_rows_alone_and_copes_with_dots(spark):
    flat = spark.createDataFrame([(1,)], "`a.b` int")
    assert impact.flatten_nested(flat).columns == ["a.b"]
    nested = spark.createDataFrame([((1,),)], "s struct<`x.y`:int>")
    assert as_set(impact.flatten_nested(nested)) == [(1,)]


def test_cause_histogram_order(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "cause string")
    assert [tuple(r) for r in impact.cause_histogram(df, "cause").collect()] == [("c", 2), ("a", 1), ("b", 1)]


def test_normalise(spark):
    schema = "day date, data_b_cause_code string, data_b_enodeb string, data_b_msisdn string, data_b_from_uri string"
    rows = [
        (day(0), "8001-x", "012345_2", "12223334444", "tel:+12223334444"),
        (day(0), "8999", "012345_2", "1", "2"),
        (day(0), "x8001", "012345", "1", "2"),
        (day(0), "8001", None, "1", "2"),
        (day(0), None, "1", "1", "2"),
    ]
    out = impact.normalise_failures(spark.createDataFrame(rows, schema))
    assert as_set(out, "cause_code", "tower", "msisdn_num", "fromuri_num") == [("8001", "012345", "2223334444", "2223334444")]


def test_impacted_users_one_row_per_record_and_alert(spark):
    alerts = list(impact.CAUSES_OF_ALERT)
    schema = "tower string, day date, has_abnormal_kpi int, " + ", ".join(f"{a} int" for a in alerts)
    scored = spark.createDataFrame(
        [("a", day(0), 1, 1, 1, 0, 0, 0), ("b", day(0), 0, 1, 1, 1, 1, 1), ("c", day(0), 1, 0, 0, 0, 1, 1)], schema
    )
    failures = spark.createDataFrame(
        [
            ("a", day(0), "8000", "f1", "m1"),
            ("a", day(0), "8002", "f2", "m2"),
            ("a", day(0), "8040", "f3", "m3"),
            ("a", day(1), "8000", "f4", "m4"),
            ("b", day(0), "8000", "f5", "m5"),
            ("c", day(0), "8010", "f6", "m6"),
            ("c", day(0), "8021", "f7", "m7"),
        ],
        "tower string, day date, cause_code string, fromuri_num string, msisdn_num string",
    )
    assert as_set(impact.impacted_users(failures, scored, TOWER), "tower", "msisdn_num", "abnormal_feature") == [
        ("a", "m1", "bearer_drop_rate_alert"),
        ("a", "m1", "sip_dc_rate_alert"),
        ("a", "m2", "sip_dc_rate_alert"),
        ("c", "m6", "rrc_setup_failure_alert"),
        ("c", "m6", "rtp_gap_alert"),
        ("c", "m7", "rtp_gap_alert"),
    ]


def shuffled_rows(df):
    """Rows written by each exchange of a plan that has run."""
    df.collect()
    rows, waiting = [], [df._jdf.queryExecution().executedPlan()]
    while waiting:
        node = waiting.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            waiting.append(node.executedPlan())
            continue
        if node.nodeName().endswith("QueryStage"):
            waiting.append(node.plan())
            continue
        if node.nodeName() == "Exchange":
            rows.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        waiting += [children.apply(i) for i in range(children.size())]
    return rows


def test_failures_are_reduced_by_bloom_filters_before_the_shuffle(spark, settings, tmp_path):
    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        optimizer__runtime__bloomFilter__applicationSideScanSizeThreshold="0",
    )
    alerts = list(impact.CAUSES_OF_ALERT)
    schema = "tower string, day date, has_abnormal_kpi int, " + ", ".join(f"{a} int" for a in alerts)
    spark.createDataFrame([(f"t{i}", day(i % 3), int(i < 20), 1, 0, 0, 0, 0) for i in range(2000)], schema).write.parquet(f"{tmp_path}/scored")
    made = [(f"t{i}", day(d), "8000", f"f{i}", f"m{d}") for i in range(2000) for d in range(3)]
    spark.createDataFrame(made, "tower string, day date, cause_code string, fromuri_num string, msisdn_num string").write.parquet(f"{tmp_path}/failures")
    scored, failures = (spark.read.parquet(f"{tmp_path}/{t}") for t in ("scored", "failures"))
    users = impact.impacted_users(failures, scored, TOWER)
    plan = final_plan(users)
    assert "might_contain" in plan and "bloom_filter_agg" in plan
    assert users.count() == 20
    # only what passes the filters is shuffled
    with_filter = failures.filter(F.col("tower").isin(*[f"t{i}" for i in range(20)])).count()
    written = sum(shuffled_rows(users))
    assert with_filter <= 60 and written < 600
