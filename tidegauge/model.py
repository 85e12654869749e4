"""Schemas, fixed values and the definitions that drive metrics and rules.

Durations are whole seconds everywhere, so that panes can be derived by gcd and
definitions can live in a table.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

# JSON envelope of one reading; every field is nullable.
ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("device_id", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("timestamp", T.StringType()),
    ]
)

TELEMETRY_SCHEMA = T.StructType(
    [
        T.StructField("device_id", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("event_time", T.TimestampType()),
    ]
)

# Columns stored in the files of the revision table; `metric`, `run_id`, `batch_id` and
# `window_date` (the UTC day of the window's start) are directory levels.
REVISION_FIELDS = T.StructType(
    [
        T.StructField("site", T.StringType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("value_sum", T.DoubleType()),
        T.StructField("value_count", T.LongType()),
        T.StructField("computed_at", T.TimestampType()),
    ]
)
REVISION_PARTITIONS = T.StructType(
    [
        T.StructField("metric", T.StringType()),
        T.StructField("run_id", T.LongType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("window_date", T.DateType()),
    ]
)
REVISION_SCHEMA = T.StructType(REVISION_FIELDS.fields + REVISION_PARTITIONS.fields)

# The compacted table keeps run and batch in its files; `metric`, `version` and
# `window_date` are its directory levels.
COMPACTED_SCHEMA = T.StructType(
    [
        *REVISION_FIELDS.fields,
        T.StructField("run_id", T.LongType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("metric", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("window_date", T.DateType()),
    ]
)

# A window of one metric (and site) has one row per revision.
WINDOW_KEY = ("metric", "site", "window_start", "window_end")
REVISION_ORDER = ("run_id", "batch_id")


@dataclass(frozen=True)
class MetricDef:
    """One windowed metric: whose readings, which windows, how late is too late.

    ``message`` names the fields of the published message, as pairs of
    (message field, our column); see :mod:`tidegauge.plans.messages`.
    """

    name: str
    devices: tuple[str, ...]
    size_s: int
    slide_s: int
    delay_s: int = 120
    decimals: int | None = None
    message: tuple[tuple[str, str], ...] = ()

    def widened(self, **changes) -> MetricDef:
        return replace(self, **changes)


# --- Fixed values: devices, metrics and thresholds of the sensor line ---------

# device_id, stage, display_stage, display_order, unit, lo, hi
DEVICES = (
    ("hopper_fill", "hopper", "HOPPER", 1, "%", 20.0, 95.0),
    ("mixer_rpm", "mixer", "MIXER", 2, "RPM", 60.0, 120.0),
    ("mixer_vibration", "mixer", "MIXER", 2, "g", 0.1, 1.5),
    ("extruder_pressure", "extruder", "EXTRUDER", 3, "bar", 3.0, 8.0),
    ("cook_temp_1", "cooker", "COOKER", 4, "°C", 72.0, 95.0),
    ("cook_temp_2", "cooker", "COOKER", 4, "°C", 72.0, 95.0),
    ("steam_pressure", "cooker", "COOKER", 4, "bar", 1.5, 3.0),
    ("cooler_temp", "cooler", "COOLER", 5, "°C", 2.0, 8.0),
    ("belt_speed", "conveyor", "PACKAGER", 6, "m/min", 0.5, 2.0),
    ("sausage_count", "packager", "PACKAGER", 6, "ct", 0.0, 10.0),
)

MIN_MEAN = 72.0  # a window mean below this is a violation
ALERT_RATIO = 1.5  # last window against its trailing baseline
CRITICAL_VIOLATIONS = 2  # violations that make a day CRITICAL
BASELINE_WINDOWS = 10  # windows in the trailing baseline, current one included
WATERMARK_S = 120
TRIGGER_S = 10
TAIL_ROWS = 200  # newest messages shown per metric
BUFFER_ROWS = 3000  # newest messages kept per stream

TEMPERATURE = MetricDef(
    "temp_window",
    ("cook_temp_1", "cook_temp_2"),
    size_s=60,
    slide_s=30,
    message=(
        ("window_start", "window_start"),
        ("window_end", "window_end"),
        ("temp_sum", "value_sum"),
        ("temp_count", "value_count"),
    ),
)
PRODUCTION = MetricDef(
    "production_hourly",
    ("sausage_count",),
    size_s=3600,
    slide_s=3600,
    message=(("hour", "window_start"), ("total_sausages", "value_sum")),
)
COMPLIANCE = MetricDef(
    "compliance_window",
    ("cook_temp_1", "cook_temp_2"),
    size_s=60,
    slide_s=60,
    message=(
        ("window_start", "window_start"),
        ("window_end", "window_end"),
        ("mean_temp", "mean"),
    ),
)
VIBRATION = MetricDef(
    "vibration_window",
    ("mixer_vibration",),
    size_s=120,
    slide_s=30,
    message=(
        ("window_start", "window_start"),
        ("window_end", "window_end"),
        ("mean_vibration", "mean"),
    ),
)
METRICS = (TEMPERATURE, PRODUCTION, COMPLIANCE, VIBRATION)

# metric, rule, threshold, n
RULES = (
    ("temp_window", "minimum", MIN_MEAN, None),
    ("compliance_window", "minimum", MIN_MEAN, CRITICAL_VIOLATIONS),
    ("vibration_window", "trailing ratio", ALERT_RATIO, BASELINE_WINDOWS),
)
