"""Everything a line monitor shows, as lazy DataFrames over the two tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions import clock, round_half_even, severity_name
from tidegauge.model import (
    COMPLIANCE,
    MIN_MEAN,
    PRODUCTION,
    TAIL_ROWS,
    TEMPERATURE,
    VIBRATION,
)
from tidegauge.operators import (
    alert_now,
    below_minimum,
    compliance_by_day,
    compliance_total,
    current_window,
    data_lag,
    last_windows,
    latest_per_device,
    options,
    overlay,
    recent,
    roster_status,
    series,
    stage_status,
    tail,
    violations,
)


def line_monitor(
    telemetry: DataFrame,
    revisions: DataFrame,
    devices: DataFrame,
    arrival: str,
    as_of: Column,
    selected_devices: Sequence[str] = (),
    selected_metrics: Sequence[str] = (),
    minimum: float = MIN_MEAN,
    keys: Sequence[str] = (),
    first_day: str | None = None,
) -> dict[str, DataFrame]:
    """The views by name; nothing runs before one of them is read.

    ``telemetry`` has a unique ``arrival`` order. ``as_of`` is the time that "now"
    stands for. ``keys`` (``("site",)``) gives every metric view per site; it is needed
    wherever the revisions carry sites. ``first_day`` bounds the days of the metric
    views, and with them the directories that are read.
    """
    latest = latest_per_device(telemetry.select("device_id", "value", "event_time", arrival), arrival)
    temperature = series(revisions, TEMPERATURE.name, first_day)
    production = series(revisions, PRODUCTION.name, first_day)
    compliance = series(revisions, COMPLIANCE.name, first_day)
    vibration = series(revisions, VIBRATION.name, first_day)
    broken = violations(compliance, minimum)

    def raw_of(metric):
        return recent(
            telemetry.filter(F.col("device_id").isin(*metric.devices)), "event_time", as_of, 300, 120
        )

    sensors = roster_status(latest, devices).withColumn(
        "status", severity_name(F.col("severity"))
    )
    return {
        "data_lag": data_lag(telemetry, arrival, as_of),
        "sensors": sensors,
        "stages": stage_status(latest, devices),
        "mean_temperature": temperature,
        "temperature_alarm": below_minimum(temperature, minimum, keys),
        "temperature_chart": overlay(raw_of(TEMPERATURE), temperature),
        "current_hour": current_window(production, "value_sum", keys).withColumn(
            "value_sum", F.col("value_sum").cast("long")
        ),
        "last_hours": last_windows(production, 8, keys).withColumn("hour", clock(F.col("window_start"))),
        "compliance": compliance_total(compliance, minimum, keys=keys),
        "compliance_days": compliance_by_day(compliance, minimum, keys=keys),
        "violations": broken.orderBy(F.desc("window_start")),
        "top_violations": broken.orderBy(F.desc("window_start"))
        .limit(5)
        .select(*keys, "window_start", round_half_even(F.col("mean")).alias("mean")),
        "vibration": vibration,
        "vibration_alert": alert_now(vibration, keys=keys),
        "vibration_chart": overlay(raw_of(VIBRATION), last_windows(vibration, 20, keys)),
        "device_options": options(telemetry, "device_id"),
        "metric_options": options(revisions, "metric"),
        "telemetry_tail": tail(
            telemetry, [arrival], "device_id", TAIL_ROWS, selected_devices
        ),
        "metric_tail": tail(
            revisions,
            ["computed_at", "run_id", "batch_id"],
            "metric",
            TAIL_ROWS,
            selected_metrics,
        ),
    }
