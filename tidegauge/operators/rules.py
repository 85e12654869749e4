"""Rules on the latest view (RUL-1 … RUL-7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions import compliance_level, severity_name, status_severity
from tidegauge.model import ALERT_RATIO, BASELINE_WINDOWS, CRITICAL_VIOLATIONS, MIN_MEAN
from tidegauge.operators.trailing import trailing
from tidegauge.operators.views import last_windows


def sensor_status(readings: DataFrame, devices: DataFrame) -> DataFrame:
    """Status of every reading against its device's limits (RUL-1, JN-1).

    Keeps readings of devices that are not on the roster, as ``unknown``.
    """
    roster = devices.withColumn("_known", F.lit(True))
    severity = status_severity(F.col("value"), F.col("lo"), F.col("hi"))
    return (
        readings.join(roster, "device_id", "left")
        .withColumn(
            "status", F.when(F.col("_known"), severity_name(severity)).otherwise("unknown")
        )
        .drop("_known")
    )


def roster_status(latest: DataFrame, devices: DataFrame) -> DataFrame:
    """Every device of the roster with its latest value; silent ones are idle (JN-2)."""
    severity = status_severity(F.col("value"), F.col("lo"), F.col("hi"))
    return devices.join(latest, "device_id", "left").withColumn("severity", severity)


def stage_status(latest: DataFrame, devices: DataFrame) -> DataFrame:
    """Worst status per displayed stage, a silent stage being idle (RUL-2, AGG-6)."""
    return (
        roster_status(latest, devices)
        .groupBy("display_stage", "display_order")
        .agg(
            severity_name(F.max("severity")).alias("status"),
            F.count("value").alias("sensors_reporting"),
        )
    )


def violations(windows: DataFrame, minimum: float = MIN_MEAN) -> DataFrame:
    """Windows whose mean is below the minimum; a null mean is none (RUL-3, FLT-5)."""
    return windows.filter(F.col("mean") < minimum)


def _violation_count(minimum: float):
    return F.count_if(F.col("mean") < minimum).alias("violations")


def compliance_by_day(
    windows: DataFrame,
    minimum: float = MIN_MEAN,
    critical_at: int = CRITICAL_VIOLATIONS,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Violations and level per UTC day; counts conditionally so that clean days stay."""
    day = F.window("window_start", "1 day")
    return (
        windows.groupBy(*keys, day.alias("day"))
        .agg(_violation_count(minimum))
        .select(
            *keys,
            F.col("day.start").alias("day"),
            "violations",
            compliance_level(F.col("violations"), critical_at).alias("status"),
        )
    )


def compliance_total(
    windows: DataFrame,
    minimum: float = MIN_MEAN,
    critical_at: int = CRITICAL_VIOLATIONS,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Violations and level over all windows given, per ``keys``; without keys one row,
    also for no windows (RUL-4)."""
    return windows.groupBy(*keys).agg(_violation_count(minimum)).withColumn(
        "status", compliance_level(F.col("violations"), critical_at)
    )


def _minimum_rules(rules: DataFrame) -> DataFrame:
    return rules.filter(F.col("rule") == "minimum").select("metric", "threshold", "n")


def violations_by_rule(windows: DataFrame, rules: DataFrame) -> DataFrame:
    """Violations of each metric's own minimum, from rows of a rule table (RUL-3, EXT-3)."""
    judged = windows.join(_minimum_rules(rules).drop("n"), "metric")
    return judged.filter(F.col("mean") < F.col("threshold"))


def compliance_by_rule(windows: DataFrame, rules: DataFrame) -> DataFrame:
    """Daily compliance of each metric by its own rule; ``n`` violations are critical."""
    judged = windows.join(_minimum_rules(rules).filter("n IS NOT NULL"), "metric")
    day = F.window("window_start", "1 day")
    return (
        judged.groupBy("metric", "n", day.alias("day"))
        .agg(F.count_if(F.col("mean") < F.col("threshold")).alias("violations"))
        .select(
            "metric",
            F.col("day.start").alias("day"),
            "violations",
            compliance_level(F.col("violations"), F.col("n")).alias("status"),
        )
    )


def alert_history(
    windows: DataFrame,
    keys: Sequence[str] = (),
    ratio: float = ALERT_RATIO,
    n: int = BASELINE_WINDOWS,
    chunk_s: int = 7 * 86_400,
) -> DataFrame:
    """The relative alert as it stood at each window (RUL-5, WIN-3).

    ALERT where a window's mean is above ``ratio`` times the mean of the last ``n``
    windows, itself included; OK before there are ``n``.
    """
    baseline = trailing(
        windows,
        keys,
        "window_start",
        n,
        {"baseline": F.avg("mean"), "baseline_windows": F.count(F.lit(1))},
        chunk_s=chunk_s,
    )
    alert = (F.col("baseline_windows") >= n) & (F.col("mean") > F.col("baseline") * ratio)
    return baseline.withColumn("status", F.when(alert, "ALERT").otherwise("OK"))


def alert_now(
    windows: DataFrame,
    ratio: float = ALERT_RATIO,
    n: int = BASELINE_WINDOWS,
    keys: Sequence[str] = (),
) -> DataFrame:
    """The alert at the last window, of each of ``keys`` if given (RUL-5).

    Without keys one row, NO DATA without windows; windows of several sites must not be
    judged without the site as a key, as their means are no common series. Reads the
    last ``n`` windows only, by a distributed top-n.
    """
    last = last_windows(windows.select(*keys, "window_start", "mean"), n, keys)
    found = last.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("windows"),
        F.max_by("mean", "window_start").alias("value"),
        F.avg("mean").alias("baseline"),
    )
    alert = (F.col("windows") >= n) & (F.col("value") > F.col("baseline") * ratio)
    return found.select(
        *keys,
        F.when(F.col("windows") == 0, "NO DATA")
        .when(alert, "ALERT")
        .otherwise("OK")
        .alias("status"),
        "value",
    )


def current_window(windows: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Value of the last window, which may still be partial (WIN-4, RUL-7)."""
    return windows.groupBy(*keys).agg(
        F.max("window_start").alias("window_start"),
        F.max_by(value, "window_start").alias(value),
    )


def below_minimum(
    windows: DataFrame, minimum: float = MIN_MEAN, keys: Sequence[str] = ()
) -> DataFrame:
    """Whether the last window's mean is below the minimum (RUL-6)."""
    return current_window(windows, "mean", keys).withColumn(
        "below_minimum", F.col("mean") < minimum
    )
