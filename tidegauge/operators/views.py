"""Series, tails and other reads of the latest view (RUL-7 … RUL-11, SET, LIM, SRT)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions import seconds_between
from tidegauge.operators.latest import latest_revision, newest
from tidegauge.operators.windows import with_mean


def series(revisions: DataFrame, metric: str, first_day: str | None = None) -> DataFrame:
    """Latest revision per window of one metric, with its mean (RUL-8, RUL-9, FLT-4).

    ``first_day`` leaves out windows that start before that UTC day; where revisions
    have a ``window_date`` its directories are not even listed as files to read. Sort
    by ``window_start`` where it is shown (SRT-1, SRT-2).
    """
    rows = revisions.filter(F.col("metric") == metric)
    if first_day is not None:
        day = F.col("window_date") if "window_date" in rows.columns else F.to_date("window_start")
        rows = rows.filter(day >= F.lit(first_day).cast("date"))
    return with_mean(latest_revision(rows))


def last_windows(windows: DataFrame, n: int, keys: Sequence[str] = ()) -> DataFrame:
    """The last ``n`` windows, of each of ``keys`` if given, in ascending order (LIM-2).

    With keys every task keeps ``n`` rows of a key before the shuffle.
    """
    if not keys:
        return windows.orderBy(F.desc("window_start")).limit(n).orderBy("window_start")
    newest_first = Window.partitionBy(*keys).orderBy(F.desc("window_start"))
    ranked = windows.withColumn("_nth", F.row_number().over(newest_first))
    return ranked.filter(F.col("_nth") <= n).drop("_nth").orderBy(*keys, "window_start")


def overlay(
    readings: DataFrame, windows: DataFrame, value: str = "mean", label: str = "mean"
) -> DataFrame:
    """Raw readings and a metric's series on one time axis (SET-2)."""
    raw = readings.select(
        F.col("event_time").alias("ts"), F.col("value"), F.lit("raw").alias("trace")
    )
    metric = windows.select(
        F.col("window_end").alias("ts"), F.col(value).alias("value"), F.lit(label).alias("trace")
    )
    return raw.unionByName(metric)


def recent(df: DataFrame, ts: str, as_of: Column, back_s: int, ahead_s: int) -> DataFrame:
    """Rows around ``as_of`` (FLT-8); bounds are constant, so they reach the scan."""
    lo = as_of - F.expr(f"interval {back_s} seconds")
    hi = as_of + F.expr(f"interval {ahead_s} seconds")
    return df.filter(F.col(ts).between(lo, hi))


def options(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values, for a selection list (AGG-7)."""
    return df.select(column).distinct().orderBy(column)


def tail(
    df: DataFrame,
    arrival: Sequence[str],
    column: str,
    n: int,
    selected: Sequence[str] = (),
) -> DataFrame:
    """Newest ``n`` rows of a stream, for the selected values or for all (RUL-11, FLT-6)."""
    rows = df.filter(F.col(column).isin(*selected)) if selected else df
    return newest(rows, arrival, n)


def data_lag(df: DataFrame, arrival: str, as_of: Column, ts: str = "event_time") -> DataFrame:
    """Seconds from the event time of the last arrival to ``as_of`` (RUL-10).

    Null when nothing arrived or its event time was unreadable.
    """
    last = df.agg(F.max_by(ts, arrival).alias("ts"))
    return last.select(seconds_between(F.col("ts"), as_of).alias("lag_s"))
