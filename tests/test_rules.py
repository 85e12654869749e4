"""Rules at their edges."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidegauge import functions as fn
from tidegauge import operators as op
from tidegauge.sources import device_table, rule_table

START = datetime(2024, 1, 1)


def windows(spark, means, step_s=30):
    rows = [(START + timedelta(seconds=step_s * i), m) for i, m in enumerate(means)]
    return spark.createDataFrame(rows, "window_start timestamp, mean double")


@pytest.mark.parametrize(
    ("value", "status"),
    [
        (72.0, "warning"),
        (71.999, "alarm"),
        (95.0, "warning"),
        (95.001, "alarm"),
        (74.3, "ok"),
        (74.2, "warning"),
        (92.7, "ok"),
        (92.8, "warning"),
        (None, "idle"),
        (float("nan"), "alarm"),
    ],
)
def test_sensor_status(spark, value, status):
    readings = spark.createDataFrame([("cook_temp_1", value)], "device_id string, value double")
    assert op.sensor_status(readings, device_table(spark)).first().status == status


def test_unknown_device_is_kept(spark):
    readings = spark.createDataFrame([("toaster", 5.0)], "device_id string, value double")
    assert op.sensor_status(readings, device_table(spark)).first().status == "unknown"


def test_stage_status_is_the_worst_of_its_sensors(spark):
    latest = spark.createDataFrame(
        [
            ("mixer_rpm", 90.0),
            ("mixer_vibration", 1.45),
            ("cook_temp_1", 60.0),
            ("cook_temp_2", 80.0),
            ("cooler_temp", 5.0),
            ("belt_speed", None),
        ],
        "device_id string, value double",
    )
    rows = op.stage_status(latest, device_table(spark)).orderBy("display_order").collect()
    assert [(r.display_stage, r.status, r.sensors_reporting) for r in rows] == [
        ("HOPPER", "idle", 0),
        ("MIXER", "warning", 2),
        ("EXTRUDER", "idle", 0),
        ("COOKER", "alarm", 2),
        ("COOLER", "ok", 1),
        ("PACKAGER", "idle", 0),
    ]


def test_violation_is_strictly_below_the_minimum(spark):
    rows = windows(spark, [72.0, 71.99, None, float("nan")])
    assert [r["mean"] for r in op.violations(rows).collect()] == [71.99]


@pytest.mark.parametrize(
    ("means", "expected"),
    [
        ([80.0], (0, "OK")),
        ([70.0, 80.0], (1, "WARNING")),
        ([70.0, 71.0], (2, "CRITICAL")),
        ([], (0, "OK")),
    ],
)
def test_compliance_levels(spark, means, expected):
    assert tuple(op.compliance_total(windows(spark, means)).first()) == expected


def test_clean_days_stay_in_the_daily_compliance(spark):
    rows = windows(spark, [80.0, 70.0, 70.0, 80.0, 70.0, None], step_s=12 * 3600)
    days = op.compliance_by_day(rows).orderBy("day").collect()
    assert [(r.violations, r.status) for r in days] == [
        (1, "WARNING"),
        (1, "WARNING"),
        (1, "WARNING"),
    ]
    clean = op.compliance_by_day(windows(spark, [80.0])).first()
    assert (clean.violations, clean.status) == (0, "OK")


def test_alert_needs_ten_windows(spark):
    nine = windows(spark, [1.0] * 8 + [100.0])
    assert tuple(op.alert_now(nine).first()) == ("OK", 100.0)
    assert {r.status for r in op.alert_history(nine).collect()} == {"OK"}
    ten = windows(spark, [1.0] * 9 + [100.0])
    assert tuple(op.alert_now(ten).first()) == ("ALERT", 100.0)
    history = op.alert_history(ten).orderBy("window_start").collect()
    assert [r.status for r in history] == ["OK"] * 9 + ["ALERT"]


def test_alert_is_strictly_above_the_ratio(spark):
    # The baseline includes the current window: (9 * 17 + 27) / 10 = 18.
    assert op.alert_now(windows(spark, [17.0] * 9 + [27.0])).first().status == "OK"
    assert op.alert_now(windows(spark, [17.0] * 9 + [27.1])).first().status == "ALERT"


def test_alert_without_windows(spark):
    assert tuple(op.alert_now(windows(spark, [])).first()) == ("NO DATA", None)


def test_last_window_alarm_and_hour(spark):
    rows = windows(spark, [80.0, 71.9])
    assert op.below_minimum(rows).first().below_minimum is True
    assert op.current_window(rows, "mean").first()["mean"] == 71.9


def test_latest_reading_goes_by_arrival(spark):
    rows = spark.createDataFrame(
        [
            ("a", 1.0, START + timedelta(seconds=9), 1),
            ("a", 2.0, START, 2),
            ("b", None, START, 3),
            ("b", 7.0, START, 1),
            ("", 3.0, START, 4),
            (None, 4.0, START, 5),
        ],
        "device_id string, value double, event_time timestamp, arrival long",
    )
    found = {r.device_id: r.value for r in op.latest_per_device(rows, "arrival").collect()}
    assert found == {"a": 2.0, "b": None}
    lag = op.data_lag(rows, "arrival", F.lit(START + timedelta(seconds=2.5)))
    assert lag.first().lag_s == 2.5


def test_lag_is_null_without_a_readable_last_message(spark):
    rows = spark.createDataFrame(
        [(START, 1), (None, 2)], "event_time timestamp, arrival long"
    )
    assert op.data_lag(rows, "arrival", F.lit(START)).first().lag_s is None
    assert op.data_lag(rows.limit(0), "arrival", F.lit(START)).first().lag_s is None


def test_empty_selection_means_all(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "device_id string, arrival long")
    assert op.tail(rows, ["arrival"], "device_id", 200).count() == 2
    assert op.tail(rows, ["arrival"], "device_id", 200, ["b"]).first().arrival == 2


def test_window_bounds(spark):
    rows = spark.createDataFrame(
        [(START + timedelta(minutes=1), 1.0)], "event_time timestamp, value double"
    )
    tumbling = op.window_totals(rows, 60).first()
    assert tumbling.window_start == START + timedelta(minutes=1)
    sliding = op.window_totals(rows, 120, 30).orderBy("window_start").collect()
    assert [r.window_start for r in sliding] == [
        START + timedelta(seconds=s) for s in (-30, 0, 30, 60)
    ]


@pytest.mark.parametrize(
    "text",
    [
        "2024-01-15T10:23:45.123Z",
        "2024-01-15T10:23:45.123000+00:00",
        "2024-01-15T10:23:45.123",
        "2024-01-15T12:23:45.123+02:00",
    ],
)
def test_time_spellings(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(fn.parse_iso(F.col("t"))).first()[0] == datetime(2024, 1, 15, 10, 23, 45, 123000)


@pytest.mark.parametrize("text", ["", "garbage", None])
def test_unreadable_time_is_null(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(fn.parse_iso(F.col("t"))).first()[0] is None


def test_display_rounding_is_half_even(spark):
    df = spark.createDataFrame([(0.25,), (0.35,), (0.75,)], "x double")
    assert [r[0] for r in df.select(fn.round_half_even(F.col("x"))).collect()] == [0.2, 0.4, 0.8]


def test_rule_table_holds_the_thresholds(spark):
    rules = {(r.metric, r.rule): (r.threshold, r.n) for r in rule_table(spark).collect()}
    assert rules["vibration_window", "trailing ratio"] == (1.5, 10)
    assert rules["compliance_window", "minimum"] == (72.0, 2)


def test_rules_come_from_their_table(spark):
    rows = windows(spark, [70.0, 71.0, 80.0])
    both = rows.withColumn("metric", F.lit("compliance_window")).unionByName(
        rows.withColumn("metric", F.lit("vibration_window"))
    )
    found = op.violations_by_rule(both, rule_table(spark)).collect()
    assert sorted((r.metric, r["mean"]) for r in found) == [
        ("compliance_window", 70.0),
        ("compliance_window", 71.0),
    ]
    day = op.compliance_by_rule(both, rule_table(spark)).collect()
    assert [(r.metric, r.violations, r.status) for r in day] == [
        ("compliance_window", 2, "CRITICAL")
    ]


def test_sites_are_judged_apart(spark):
    """Two flat sites are no alert, whatever the other's level."""
    rows = spark.createDataFrame(
        [
            (site, datetime(2024, 1, 1, hour), level)
            for site, level in (("A", 1.0), ("B", 100.0))
            for hour in range(12)
        ],
        "site string, window_start timestamp, mean double",
    )
    now = {tuple(r) for r in op.alert_now(rows, keys=["site"]).collect()}
    assert now == {("A", "OK", 1.0), ("B", "OK", 100.0)}
    last = op.last_windows(rows, 8, ["site"]).groupBy("site").count().collect()
    assert {tuple(r) for r in last} == {("A", 8), ("B", 8)}
    total = op.compliance_total(rows, 50.0, keys=["site"]).collect()
    assert {(r.site, r.violations) for r in total} == {("A", 12), ("B", 0)}
