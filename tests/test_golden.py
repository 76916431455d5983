"""The worked examples of FIXTURES.md, part B, on our operators."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from kerbline.functions import expressions as X
from kerbline.functions import roles
from kerbline.operators import baseline, clicks, layout, quality, trips, versions
from kerbline.operators.clicks import AlertLimits
from kerbline.plans import marts

FUNNEL = (
    "window_start timestamp, window_end timestamp, total_sessions long, total_users long, page_view_sessions long,"
    " product_view_sessions long, add_to_cart_sessions long, purchase_sessions long"
)


def funnel_row(spark, total, page, cart, buy, at=datetime(2026, 3, 9, 10, 0)):
    end = at.replace(minute=at.minute + 5)
    return clicks.with_rates(spark.createDataFrame([(at, end, total, total, page, page, cart, buy)], FUNNEL))


def one(df, column):
    return df.select(column.alias("x")).head()["x"]


@pytest.mark.parametrize(
    ("code", "label"),
    [("1", "credit_card"), ("2", "cash"), ("6", "voided_trip"), ("99", "other"), (None, "other"), ("x", "other")],
)
def test_payment_labels(spark, code, label):
    assert one(spark.createDataFrame([(code,)], "c string"), X.payment_label(F.col("c"))) == label


def test_column_roles():
    columns = ["VendorID", "PULocationID", "DOLocationID", "tpep_pickup_datetime"]
    assert roles.pick(columns, roles.PICKUP_TIME) == "tpep_pickup_datetime"
    assert roles.pick(["PULocationID"], roles.DROPOFF_PLACE) is None
    with pytest.raises(ValueError, match="pickup time"):
        roles.pickup_time_column(["VendorID"])
    assert roles.variant(["lpep_pickup_datetime"]) == "green"
    assert roles.variant(["hvfhs_license_num", "dispatching_base_num"]) == "fhvhv"
    assert roles.variant(["dispatching_base_num"]) == "fhv"
    assert roles.variant([]) == "unknown"


def test_signature_order():
    columns = [
        "total_amount", "fare_amount", "trip_distance", "passenger_count", "DOLocationID", "PULocationID",
        "tpep_dropoff_datetime", "pickup_ts", "tpep_pickup_datetime", "VendorID",
    ]
    assert roles.signature_columns(columns) == [
        "VendorID", "pickup_ts", "tpep_dropoff_datetime", "PULocationID", "DOLocationID", "passenger_count",
        "trip_distance", "fare_amount", "total_amount",
    ]
    assert roles.signature_columns(columns[:3]) == []


def test_missing_and_negative_fields(spark):
    event = spark.createDataFrame(
        [("e1", "u1", "", "page_view", "home", None, -10.5, 2.0, -8.5)],
        "event_id string, user_id string, session_id string, event_type string, page string, timestamp string,"
        " fare_amount double, tip_amount double, total_amount double",
    )
    assert one(event, quality.missing_fields()) == ["session_id", "timestamp"]
    assert one(event, quality.negative_values()) == {"fare_amount": -10.5, "total_amount": -8.5}
    report = quality.event_report(event, amounts=quality.EVENT_AMOUNTS).head()
    assert tuple(report) == (1, 1, 1)


TRIP = (
    "VendorID long, tpep_pickup_datetime string, tpep_dropoff_datetime string, PULocationID long, DOLocationID long,"
    " passenger_count double, trip_distance double, fare_amount double, tip_amount double, total_amount double,"
    " pickup_zone string, pickup_borough string"
)
GOOD = (1, "2023-01-01 00:10:00", "2023-01-01 00:30:00", 10, 20, 1.0, 3.0, 12.0, 2.0, 14.0, "Midtown", "Manhattan")


def flagged(spark, rows, **limits):
    raw = spark.createDataFrame(rows, TRIP)
    return quality.flag(trips.prepare(raw, keep_undated=True), quality.Limits(pickup_year=2023, **limits))


def test_six_issues_in_one_row(spark):
    bad = (1, "2022-12-31 23:00:00", None, 1, 2, 0.0, 250.0, -10.0, 1.0, -9.0, "Unknown", "Unknown")
    raw = spark.createDataFrame([bad], TRIP)
    prepared = trips.prepare(raw, keep_undated=True).withColumn("tip_pct", F.lit(150.0))
    names = quality.flag(prepared, quality.Limits(pickup_year=2023)).head()["dq_issue_names"]
    assert names == [
        "negative_numeric_values",
        "invalid_passenger_count",
        "invalid_trip_distance",
        "invalid_tip_pct",
        "pickup_year_mismatch",
        "unresolved_pickup_zone",
    ]


def test_duplicates_and_summary(spark):
    other = (2, *GOOD[1:])
    rows = [GOOD, GOOD, other]
    summary = quality.summary_of_flagged(flagged(spark, rows)).head()
    assert (summary["total_rows"], summary["duplicate_taxi_record_rows"], summary["clean_rows"]) == (3, 2, 1)
    raw = trips.prepare(spark.createDataFrame(rows, TRIP), keep_undated=True)
    direct = quality.summary(raw, quality.Limits(pickup_year=2023)).head()
    assert direct.asDict() == summary.asDict()
    histogram = quality.issue_histogram(quality.summary(raw, quality.Limits(pickup_year=2023))).collect()
    assert [tuple(row) for row in histogram] == [("duplicate_taxi_record", 2)]


def test_summary_of_no_rows_is_zero(spark):
    raw = trips.prepare(spark.createDataFrame([], TRIP), keep_undated=True)
    for summary in (quality.summary(raw), quality.summary_of_flagged(quality.flag(raw))):
        row = summary.head().asDict()
        assert row.pop("issue_rate_pct") is None
        assert set(row.values()) == {0}


def test_missing_time_is_counted_and_null_place_is_unresolved(spark):
    rows = [(*GOOD[:1], "not a time", *GOOD[2:]), (*GOOD[:10], None, "Manhattan")]
    names = [row["dq_issue_names"] for row in flagged(spark, rows).orderBy("pickup_ts").collect()]
    assert names == [["missing_pickup_timestamp", "missing_required_fields"], ["unresolved_pickup_zone"]]


def test_strict_mode_misses_absent_columns(spark):
    raw = trips.prepare(spark.createDataFrame([("2023-01-01 00:00:00",)], "pickup_datetime string"))
    assert quality.flag(raw).head()["dq_issue_names"] == []
    assert quality.flag(raw, quality.Limits(strict=True)).head()["dq_issue_names"] == ["missing_required_fields"]


def test_rates_and_z_score(spark):
    df = spark.createDataFrame([(5.0, 0.0, 2.0, 8.0)], "a double, z double, b double, c double")
    assert one(df, X.rate(F.col("a"), F.col("z"))) is None
    assert one(df, X.rate(F.col("b"), F.col("c"))) == 25.0
    numbers = spark.createDataFrame([(10.0, 4.0, 0.0, None)], "v double, m double, s double, n double")
    assert one(numbers, X.z_score(F.col("v"), F.col("m"), F.col("s"), 2.0)) == 3.0
    assert one(numbers, X.z_score(F.col("v"), F.col("n"), F.col("s"), 2.0)) is None
    assert one(numbers, X.z_score(F.col("v"), F.col("m"), F.col("s"), 0.0)) is None


def test_finite(spark):
    df = spark.createDataFrame([(1.23456,), (float("nan"),), (float("inf"),), (None,)], "x double")
    assert [r[0] for r in df.select(X.finite(F.col("x"))).collect()] == [1.2346, None, None, None]


def scored(rows, count, mean, stddev):
    return rows.select(
        "*",
        F.lit(count).alias("baseline_window_count"),
        F.lit(mean).cast("double").alias("baseline_session_mean"),
        F.lit(stddev).cast("double").alias("baseline_session_stddev"),
    ).withColumn(
        "traffic_z_score",
        X.z_score(F.col("total_sessions"), F.col("baseline_session_mean"), F.col("baseline_session_stddev"), 0.1),
    )


@pytest.mark.parametrize(
    ("counts", "mean", "stddev", "expected"),
    [
        ((10, 10, 6, 1), 4.0, 1.0, ["traffic_spike", "cart_abandonment_risk"]),
        ((10, 10, 6, 0), 4.0, 1.0, ["traffic_spike", "low_purchase_conversion", "cart_abandonment_risk"]),
        ((2, 2, 0, 0), None, None, ["traffic_drop"]),
        ((1, 1, 0, 0), 6.0, 2.0, ["traffic_drop"]),
        ((20, 1, 1, 1), None, None, ["traffic_spike"]),
        ((2, 2, 0, 0), 2.0, 1.0, None),
    ],
)
def test_alert_rules(spark, counts, mean, stddev, expected):
    rows = scored(funnel_row(spark, *counts), 12, mean, stddev)
    found = clicks.raise_alerts(rows, AlertLimits(), F.col("traffic_z_score")).head()
    assert (found and found["alert_types"]) == expected


def test_conversion_threshold_example(spark):
    rows = scored(funnel_row(spark, 10, 10, 6, 1), 12, 4.0, 1.0)
    limits = AlertLimits(min_page_conversion=15.0, min_cart_conversion=20.0)
    found = clicks.raise_alerts(rows, limits, F.col("traffic_z_score")).head()
    assert found["alert_types"] == ["traffic_spike", "low_purchase_conversion", "cart_abandonment_risk"]


@pytest.mark.parametrize(
    ("alerts", "level"),
    [
        (["traffic_spike"], "high"),
        (["low_purchase_conversion"], "high"),
        (["cart_abandonment_risk", "traffic_drop"], "medium"),
        (["traffic_drop"], "low"),
    ],
)
def test_severity(spark, alerts, level):
    assert one(spark.createDataFrame([(alerts,)], "a array<string>"), clicks.severity(F.col("a"))) == level


def test_funnel_rates(spark):
    row = funnel_row(spark, 10, 10, 6, 1).head()
    assert row["page_to_product_rate"] == 100.0
    assert row["product_to_cart_rate"] == 60.0
    assert row["cart_to_purchase_rate"] == pytest.approx(16.666666666666664)
    assert row["page_to_purchase_rate"] == 10.0


def test_baseline_statistics(spark):
    series = spark.createDataFrame([(3,), (4,), (5,), (4,)], "total_sessions long")
    assert tuple(baseline.baseline_stats(series).head()) == (4, 4.0, 0.7071)
    single = spark.createDataFrame([(3,)], "total_sessions long")
    assert tuple(baseline.baseline_stats(single).head()) == (1, 3.0, 0.0)


def test_z_alert_row(spark):
    history = [3, 4, 5, 4] * 3
    rows = [funnel_row(spark, n, n, 0, 0, datetime(2026, 3, 9, 8 + i // 10, 5 * (i % 10))) for i, n in enumerate(history)]
    rows.append(funnel_row(spark, 10, 10, 6, 1, datetime(2026, 3, 9, 10, 0)))
    table = rows[0]
    for row in rows[1:]:
        table = table.unionByName(row)
    alert = baseline.latest_z_alert(baseline.rolling_baseline(table)).head()
    assert len(alert) == 16
    assert alert["traffic_z_score"] == 8.4854
    assert alert["baseline_window_count"] == 12
    assert alert["severity"] == "high"
    assert alert["cart_to_purchase_rate"] == 16.6667
    assert alert["anomaly_model"] == "zscore_vs_recent_hour"


def test_timing_example(spark):
    run = spark.createDataFrame(
        [(27, 10, 0.5, 1.5), (27, 10, None, 1.5)],
        "event_count long, session_count long, publish_seconds double, processing_seconds double",
    )
    full, half = marts.timing(run).orderBy(F.desc_nulls_last("publish_seconds")).collect()
    assert (full["end_to_end_seconds"], full["events_per_second"], full["sessions_per_second"]) == (2.0, 13.5, 5.0)
    assert (half["end_to_end_seconds"], half["events_per_second"]) == (None, None)


RESULT = "engine string, row_limit_label string, duration_seconds double, row_count long, position int"


def test_engine_ratio(spark):
    results = spark.createDataFrame(
        [
            ("pandas", "full", 1.5, 10, 0), ("pyspark", "full", 4.5, 10, 1), ("pandas", "100,000", 0.5, 5, 2),
            ("pyspark", "20,000", 0.5, 5, 3), ("pandas", "20,000", 0.0, 5, 4), ("pandas", "full", 9.0, 10, -1),
        ],
        RESULT,
    )
    assert [tuple(r) for r in marts.engine_ratio(results).collect()] == [
        ("20,000", 0.0, 0.5, None),
        ("100,000", 0.5, None, None),
        ("full", 1.5, 4.5, 3.0),
    ]


def test_profiles_and_choice(spark):
    results = spark.createDataFrame(
        [
            ("pandas", "100", 0.5, 100, 0), ("pandas", "200", 0.5, 200, 1), ("pyspark", "300", 1.0, 300, 2),
            ("pyspark", "full", 6.0, 200, 3), ("pandas", "none", None, None, 4),
        ],
        RESULT,
    )
    profiles = marts.throughput(results, 9.127)
    spark_full = profiles.where("engine = 'pyspark' and row_limit_label = 'full'").head()
    assert spark_full["time_to_first_result_seconds"] == 15.127
    assert spark_full["rows_per_second"] == pytest.approx(33.3333)
    best = {r["engine"]: r["row_limit_label"] for r in marts.primary(profiles).collect()}
    assert best == {"pandas": "200", "pyspark": "full"}
    assert marts.preferred(results).head()["row_limit_label"] == "full"
    assert marts.preferred(results.where("row_limit_label <> 'full'")).head()["position"] == 4
    assert marts.preferred(results.limit(0)).count() == 0


def test_rows_per_second_example(spark):
    results = spark.createDataFrame([("pandas", "full", 5.5, 1100, 0)], RESULT)
    assert marts.throughput(results).head()["rows_per_second"] == 200.0


def test_layout_gain(spark):
    layouts = spark.createDataFrame([("unpartitioned", 1.0), ("by_date", 0.7)], "layout string, avg_seconds double")
    gains = {r["layout"]: r["improvement_vs_unpartitioned_pct"] for r in layout.improvement(layouts).collect()}
    assert gains == {"unpartitioned": None, "by_date": 30.0}
    alone = layouts.where("layout = 'by_date'")
    assert layout.improvement(alone).head()["improvement_vs_unpartitioned_pct"] is None


def test_schema_change(spark):
    before = spark.createDataFrame([], "order_id string, user_id string, amount double, event_date string")
    after = spark.createDataFrame([], "order_id string, amount double, event_date string, channel string")
    found = [(r["change"], r["name"]) for r in versions.schema_change(before, after).collect()]
    assert found == [("added", "channel"), ("removed", "user_id")]


def test_report_backfill_example(spark):
    from kerbline.sources.reports import REPORT_SCHEMA

    report = {
        "config": {"page_view_sessions": 4},
        "event_metrics": [
            {"window_end": "b", "event_type": "page_view", "event_count": 10},
            {"window_end": "b", "event_type": "purchase", "event_count": 1},
        ],
        "funnel_metrics": [
            {"window_start": "a", "window_end": "b", "total_sessions": 10, "total_users": 9},
            {"window_start": "0", "window_end": "a", "total_sessions": 1, "total_users": 1},
        ],
        "query_progress": [{"trigger_execution_ms": 1500.0}, {"trigger_execution_ms": 900.0}],
        "anomaly_alerts": [{"alert_count": 2, "severity": "high"}, {"alert_count": 1, "severity": "low"}],
    }
    empty = {"config": {"page_view_sessions": 4}}
    done = marts.complete_reports(spark.createDataFrame([report, empty], REPORT_SCHEMA)).collect()
    summary, timing = done[0]["scenario_summary"], done[0]["timing"]
    assert summary["generated_event_count"] == 11
    assert summary["generated_session_count"] == 10
    assert summary["generated_user_count"] == 9
    assert summary["event_type_counts"] == {"page_view": 10, "purchase": 1}
    assert (timing["processing_seconds"], timing["events_per_second"], timing["sessions_per_second"]) == (
        1.5,
        7.3333,
        6.6667,
    )
    assert done[1]["scenario_summary"]["generated_event_count"] == 0
    assert done[1]["scenario_summary"]["generated_session_count"] == 4
    assert done[1]["timing"]["processing_seconds"] is None
    profile = marts.stream_profiles(spark.createDataFrame([report], REPORT_SCHEMA)).head()
    assert (profile["alert_count"], profile["severity"], profile["generated_event_count"]) == (3, "high", 11)
