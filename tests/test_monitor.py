"""The whole line end to end: readings, streams, revision table, views."""

from datetime import datetime, timedelta
from threading import Timer

import pytest
from pyspark.sql import functions as F

from tests.conftest import reading
from tidegauge.model import METRICS
from tidegauge.plans.monitor import line_monitor
from tidegauge.sources import arrived_after, decode, device_table, read_revisions, read_stream
from tidegauge.streaming import await_all, run_until_any_ends, start_metrics

MINUTES = 20


def value_of(device, second):
    if device.startswith("cook_temp"):
        # Too cold in the third and the sixth minute.
        return 70.0 if second // 60 in (2, 5) else 80.0
    if device == "mixer_vibration":
        return 0.2 if second < (MINUTES - 1) * 60 else 3.0
    return {"sausage_count": 2.5, "belt_speed": 1.0, "hopper_fill": 21.0}[device]


@pytest.fixture
def line(spark, drop_file, tmp_path):
    devices = ("cook_temp_1", "cook_temp_2", "mixer_vibration", "sausage_count", "belt_speed", "hopper_fill")
    for minute in range(MINUTES):
        rows = []
        for second in range(minute * 60, minute * 60 + 60, 10):
            clock = f"00:{minute:02d}:{second % 60:02d}"
            rows += [reading(d, clock, value_of(d, second)) for d in devices]
        drop_file(*rows)
    lines = read_stream(spark, "text", drop_file.folder, options={"maxFilesPerTrigger": "7"})
    telemetry = decode(lines).drop("payload")
    table = f"{tmp_path}/table"
    await_all(start_metrics(telemetry, table, f"{tmp_path}/checkpoints", available_now=True))
    stored = decode(spark.read.text(drop_file.folder)).drop("payload")
    arrival = F.unix_seconds("event_time") * 100 + F.pmod(F.xxhash64("device_id"), F.lit(100))
    return line_monitor(
        stored.withColumn("arrival", arrival),
        read_revisions(spark, table),
        device_table(spark),
        "arrival",
        F.lit(datetime(2024, 1, 1, 0, MINUTES)),
        selected_devices=["belt_speed"],
        selected_metrics=["production_hourly"],
    )


def test_every_view(spark, line):
    got = {name: df.collect() for name, df in line.items()}

    assert got["data_lag"][0].lag_s == 10.0
    status = {r.device_id: r.status for r in got["sensors"]}
    assert status["hopper_fill"] == "warning" and status["mixer_vibration"] == "alarm"
    assert status["cook_temp_1"] == "ok" and status["mixer_rpm"] == "idle"
    stages = {r.display_stage: r.status for r in got["stages"]}
    assert stages == {
        "HOPPER": "warning",
        "MIXER": "alarm",
        "EXTRUDER": "idle",
        "COOKER": "ok",
        "COOLER": "idle",
        "PACKAGER": "ok",
    }

    assert len(got["mean_temperature"]) == 2 * MINUTES + 1
    assert got["temperature_alarm"][0].below_minimum is False
    assert got["current_hour"][0].value_sum == int(2.5 * 6 * MINUTES)
    assert [r.hour for r in got["last_hours"]] == ["00:00:00"]

    assert tuple(got["compliance"][0]) == (2, "CRITICAL")
    assert [(r.violations, r.status) for r in got["compliance_days"]] == [(2, "CRITICAL")]
    assert [r.window_start.minute for r in got["violations"]] == [5, 2]
    assert [(r.window_start.minute, r["mean"]) for r in got["top_violations"]] == [(5, 70.0), (2, 70.0)]

    assert got["vibration_alert"][0].status == "ALERT"
    assert got["vibration_alert"][0].value == 3.0

    assert {r.trace for r in got["temperature_chart"]} == {"raw", "mean"}
    raw = [r for r in got["temperature_chart"] if r.trace == "raw"]
    assert min(r.ts for r in raw) == datetime(2024, 1, 1, 0, MINUTES) - timedelta(minutes=5)
    assert sum(r.trace == "mean" for r in got["vibration_chart"]) == 20

    assert [r.device_id for r in got["device_options"]] == sorted(
        ["belt_speed", "cook_temp_1", "cook_temp_2", "hopper_fill", "mixer_vibration", "sausage_count"]
    )
    assert [r.metric for r in got["metric_options"]] == [
        "compliance_window",
        "production_hourly",
        "temp_window",
        "vibration_window",
    ]
    assert {r.device_id for r in got["telemetry_tail"]} == {"belt_speed"}
    assert len(got["telemetry_tail"]) == 6 * MINUTES
    assert {r.metric for r in got["metric_tail"]} == {"production_hourly"}


def test_views_without_data(spark, tmp_path):
    telemetry = spark.createDataFrame(
        [], "device_id string, value double, event_time timestamp, arrival long"
    )
    (tmp_path / "table").mkdir()
    views = line_monitor(
        telemetry,
        read_revisions(spark, f"{tmp_path}/table"),
        device_table(spark),
        "arrival",
        F.current_timestamp(),
    )
    assert views["vibration_alert"].first().status == "NO DATA"
    assert tuple(views["compliance"].first()) == (0, "OK")
    assert views["data_lag"].first().lag_s is None
    assert {r.status for r in views["stages"].collect()} == {"idle"}


def test_reader_that_starts_at_the_latest(spark):
    rows = spark.createDataFrame([(1,), (2,), (3,)], "arrival long")
    assert [r.arrival for r in arrived_after(rows, "arrival", 2).collect()] == [3]


def test_timed_queries_run_until_one_ends(spark, drop_file, tmp_path):
    drop_file(reading("cook_temp_1", "00:00:10", 80.0), reading("sausage_count", "00:00:10", 1.0))
    telemetry = decode(read_stream(spark, "text", drop_file.folder)).drop("payload")
    queries = start_metrics(telemetry, f"{tmp_path}/t", f"{tmp_path}/c", trigger_s=1)
    for query in queries:
        query.processAllAvailable()
    queries[2].stop()
    run_until_any_ends(queries)
    assert not any(q.isActive for q in queries)
    assert read_revisions(spark, f"{tmp_path}/t").select("metric").distinct().count() == 3


def test_queries_that_ended_earlier_stop_nothing(spark, drop_file, tmp_path):
    drop_file(reading("cook_temp_1", "00:00:10", 80.0))
    telemetry = decode(read_stream(spark, "text", drop_file.folder)).drop("payload")
    await_all(
        start_metrics(telemetry, f"{tmp_path}/t", f"{tmp_path}/old", [METRICS[0]], available_now=True)
    )
    queries = start_metrics(telemetry, f"{tmp_path}/t", f"{tmp_path}/c", METRICS[:2], trigger_s=1)
    seen = []
    ender = Timer(3, lambda: (seen.append(all(q.isActive for q in queries)), queries[0].stop()))
    ender.start()
    run_until_any_ends(queries, poll_s=0.2)
    ender.join()
    assert seen == [True]
    assert not any(q.isActive for q in queries)


def test_failed_query_is_raised_and_stops_the_others(spark, drop_file, tmp_path):
    drop_file(reading("cook_temp_1", "00:00:10", 80.0))
    telemetry = decode(read_stream(spark, "text", drop_file.folder)).drop("payload")

    def fail(_stored, _batch_id):
        raise RuntimeError("sink is down")

    healthy = start_metrics(telemetry, f"{tmp_path}/t", f"{tmp_path}/a", [METRICS[1]], trigger_s=1)
    broken = start_metrics(
        telemetry, f"{tmp_path}/t", f"{tmp_path}/b", [METRICS[0]], trigger_s=1, after=fail
    )
    with pytest.raises(Exception, match="sink is down"):
        run_until_any_ends(healthy + broken, poll_s=0.2)
    assert not healthy[0].isActive
