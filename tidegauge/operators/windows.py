"""Event-time window aggregates (STR-2 … STR-5, AGG-1 … AGG-4, EXT-3)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions import as_type, micros
from tidegauge.model import MetricDef


def _seconds(n: int) -> str:
    return f"{n} seconds"


def _grouped(
    df: DataFrame,
    size_s: int,
    slide_s: int,
    keys: Sequence[str],
    ts: str,
    total: Column,
    count: Column,
) -> DataFrame:
    span = F.window(ts, _seconds(size_s), _seconds(slide_s))
    return (
        df.groupBy(*keys, span.alias("span"))
        .agg(total.alias("value_sum"), count.alias("value_count"))
        .select(
            *keys,
            F.col("span.start").alias("window_start"),
            F.col("span.end").alias("window_end"),
            "value_sum",
            "value_count",
        )
    )


def panes(
    df: DataFrame,
    pane_s: int,
    keys: Sequence[str] = (),
    ts: str = "event_time",
    value: str = "value",
) -> DataFrame:
    """Sum and count per short tumbling pane, the mergeable parts of any wider window.

    Map-side aggregation shrinks the raw rows to one per key, pane and task before
    the shuffle, so a key with a third of all rows costs no more than another.
    """
    return _grouped(df, pane_s, pane_s, keys, ts, F.sum(value), F.count(value)).drop("window_end")


def _rounded(df: DataFrame, decimals: int | None) -> DataFrame:
    if decimals is None:
        return df
    return df.withColumn("value_sum", F.round("value_sum", decimals))


def window_totals(
    df: DataFrame,
    size_s: int,
    slide_s: int | None = None,
    keys: Sequence[str] = (),
    ts: str = "event_time",
    value: str = "value",
    decimals: int | None = None,
) -> DataFrame:
    """Sum and count per key and window; tumbling without ``slide_s``.

    ``value_count`` counts non-null values, so a window of null readings exists
    with sum null and count 0. Rows without event time are in no window (FLT-7).

    Stored tables with overlapping windows go through panes first: each reading is
    aggregated once instead of once per window that covers it. A stream keeps the
    direct form, since a pane would close before the window that needs it.

    ``decimals``: readings with a fixed number of decimals have exact sums; rounding
    takes off the floating error that depends on the order of addition.
    """
    slide_s = slide_s or size_s
    if df.isStreaming or slide_s == size_s:
        totals = _grouped(df, size_s, slide_s, keys, ts, F.sum(value), F.count(value))
    else:
        parts = panes(df, gcd(size_s, slide_s), keys, ts, value)
        totals = _grouped(
            parts,
            size_s,
            slide_s,
            keys,
            "window_start",
            F.sum("value_sum"),
            F.sum("value_count"),
        )
    return _rounded(totals, decimals)


def with_mean(totals: DataFrame) -> DataFrame:
    """Adds ``mean``, null where a window has no value (PRJ-4, AGG-3, AGG-4)."""
    return totals.withColumn("mean", F.try_divide("value_sum", "value_count"))


def tumbling_from_sliding(totals: DataFrame, size_s: int) -> DataFrame:
    """Tumbling windows out of sliding ones of the same size (STR-4 out of STR-2).

    They are the sliding windows that start on a multiple of the size, so the
    tumbling metric needs neither a scan nor state of its own.
    """
    return totals.filter(micros(F.col("window_start")) % F.lit(size_s * 1_000_000) == 0)


def metric_totals(df: DataFrame, metric: MetricDef, keys: Sequence[str] = ()) -> DataFrame:
    """One metric over telemetry: device filter, then its windows (FLT-1 … FLT-3)."""
    wanted = df.filter(F.col("device_id").isin(*metric.devices))
    totals = window_totals(
        wanted, metric.size_s, metric.slide_s, keys, decimals=metric.decimals
    )
    return totals.select(F.lit(metric.name).alias("metric"), *totals.columns)


def common_pane(metrics: Iterable[MetricDef]) -> int:
    """The longest pane that every size and slide is a multiple of."""
    return reduce(gcd, (s for m in metrics for s in (m.size_s, m.slide_s)))


def metrics_by_definition(
    df: DataFrame,
    definitions: DataFrame,
    pane_s: int,
    keys: Sequence[str] = (),
    decimals: int | None = None,
) -> DataFrame:
    """All metrics of a definition table over stored telemetry, in one scan (EXT-3).

    ``definitions`` has ``metric, device_id, size_s, slide_s``. Readings of devices that
    no definition lists leave before anything is shuffled. The rest shrinks to panes per
    device before it meets the definitions, so the join and the spread over overlapping
    windows work on panes, whatever the number of readings; a pane becomes as many rows
    as windows cover it (size / slide of each definition).
    ``pane_s`` must divide every size and slide; a definition that breaks this ends
    the query.
    """
    pane_us = F.lit(pane_s * 1_000_000)
    checked = definitions.select(
        "metric",
        "device_id",
        *[
            F.when(F.col(c) % pane_s == 0, F.col(c) * 1_000_000)
            .otherwise(F.raise_error(F.lit(f"{c} is not a multiple of {pane_s} seconds")))
            .alias(c.replace("_s", "_us"))
            for c in ("size_s", "slide_s")
        ],
    )
    listed = df.join(definitions.select("device_id").distinct(), "device_id", "left_semi")
    parts = panes(listed, pane_s, ("device_id", *keys))
    start = micros(F.col("window_start"))
    newest_start = start - F.pmod(start, F.col("slide_us"))
    oldest_reach = start - F.col("size_us") + pane_us
    # Starts of the windows that cover the pane, newest first.
    spread = (
        parts.join(checked, "device_id")
        .withColumn("newest_us", newest_start)
        .withColumn("oldest_us", oldest_reach)
        .filter(F.col("newest_us") >= F.col("oldest_us"))
        .withColumn(
            "start_us",
            F.explode(F.sequence("newest_us", "oldest_us", -F.col("slide_us"))),
        )
    )
    totals = (
        spread.groupBy("metric", *keys, "start_us", "size_us")
        .agg(F.sum("value_sum").alias("value_sum"), F.sum("value_count").alias("value_count"))
        .select(
            "metric",
            *keys,
            as_type(F.col("start_us"), parts, "window_start").alias("window_start"),
            as_type(F.col("start_us") + F.col("size_us"), parts, "window_start").alias(
                "window_end"
            ),
            "value_sum",
            "value_count",
        )
    )
    return _rounded(totals, decimals)
