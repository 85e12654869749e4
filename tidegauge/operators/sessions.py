"""Session windows: stretches of readings with no longer pause than a gap of their device."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions import as_type, micros


def _gap_us(gap_s: int | str) -> Column:
    return (F.col(gap_s) if isinstance(gap_s, str) else F.lit(gap_s)).cast("long") * 1_000_000


def _merged(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Parts of a group that lie no further apart than their gap, as one; ``_edge`` marks the
    first and the last one that is left in the group."""
    group = Window.partitionBy(*keys, "_level", "_group")
    order = group.orderBy("_first", "_last")
    pause = F.col("_first") - F.lag("_last").over(order)
    return (
        parts.withColumn("_begins", F.when(pause <= F.col("_gap"), 0).otherwise(1))
        .withColumn("_nth", F.sum("_begins").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_of", F.sum("_begins").over(group))
        .groupBy(*keys, "_level", "_group", "_gap", "_nth", "_of")
        .agg(
            F.min("_first").alias("_first"),
            F.max("_last").alias("_last"),
            *[F.sum(c).alias(c) for c in ("value_sum", "value_count", "readings")],
        )
        .withColumn("_edge", (F.col("_nth") == 1) | (F.col("_nth") == F.col("_of")))
        .drop("_nth", "_of")
    )


def session_totals(
    df: DataFrame,
    gap_s: int | str,
    keys: Sequence[str] = ("device_id",),
    ts: str = "event_time",
    value: str = "value",
    chunk_s: Sequence[int] = (86_400, 30 * 86_400),
    decimals: int | None = None,
) -> DataFrame:
    """Sum, count and number of readings per key and session, with its first reading
    (``session_start``), its last one (``last_reading``) and ``session_end``, a gap later.

    Readings up to and including ``gap_s`` seconds apart are in one session; ``gap_s`` may
    name a column that is constant per key (a gap per device). Rows without event time or
    gap are in no session. Sums and counts merge, so a mean is derived.

    On a stream (behind a watermark) Spark merges the open sessions in its state and a
    session is emitted once the watermark has passed its end. On a table, readings first
    shrink to one row for each bucket of a gap's length, in which no session can end, by
    partial aggregation. Buckets are then joined up within chunks of time; only the first
    and the last part of a chunk can go on beyond it and are passed to the next, longer
    chunks and at last to the key as a whole. So no task sees a series: a key with a third
    of all rows is one row per bucket, and two parts per chunk further up.
    """
    if df.isStreaming:
        return _streamed(df, gap_s, keys, ts, value, decimals)
    at = micros(F.col(ts))
    gap = _gap_us(gap_s)
    rows = df.select(*keys, at.alias("_at"), gap.alias("_gap"), F.col(value).alias("_value"))
    parts = (
        rows.where("_at is not null and _gap > 0")
        .groupBy(*keys, "_gap", F.floor(F.col("_at") / F.col("_gap")).alias("_bucket"))
        .agg(
            F.min("_at").alias("_first"),
            F.max("_at").alias("_last"),
            F.sum("_value").alias("value_sum"),
            F.count("_value").alias("value_count"),
            F.count(F.lit(1)).alias("readings"),
        )
        .drop("_bucket")
    )
    # Parts that cannot go on beyond their chunk keep its level and pass the later ones
    # in their group.
    parts = parts.withColumns({"_edge": F.lit(True), "_level": F.lit(-1), "_group": F.lit(None).cast("long")})
    for level, size_s in enumerate([*chunk_s, None]):
        # A chunk of few gaps would only pass everything on.
        longer = F.lit(None).cast("long")
        if size_s is not None:
            size = F.greatest(F.lit(size_s * 1_000_000), 4 * F.col("_gap"))
            longer = F.floor(F.col("_first") / size)
        here = (F.col("_level") == level - 1) & F.col("_edge")
        parts = parts.withColumns(
            {
                "_group": F.when(here, longer).otherwise(F.col("_group")),
                "_level": F.when(here, level).otherwise(F.col("_level")),
            }
        )
        parts = _merged(parts.drop("_edge"), keys)
    return _finish(parts, df, keys, ts, decimals)


def _streamed(
    df: DataFrame, gap_s: int | str, keys: Sequence[str], ts: str, value: str, decimals: int | None
) -> DataFrame:
    seconds = F.col(gap_s) if isinstance(gap_s, str) else F.lit(gap_s)
    span = F.session_window(ts, F.concat(seconds.cast("string"), F.lit(" seconds")))
    total = F.sum(value)
    return (
        df.groupBy(*keys, span.alias("span"))
        .agg(
            F.max(ts).alias("last_reading"),
            (total if decimals is None else F.round(total, decimals)).alias("value_sum"),
            F.count(value).alias("value_count"),
            F.count(F.lit(1)).alias("readings"),
        )
        .select(
            *keys,
            F.col("span.start").alias("session_start"),
            "last_reading",
            F.col("span.end").alias("session_end"),
            "value_sum",
            "value_count",
            "readings",
        )
    )


def _finish(
    parts: DataFrame, df: DataFrame, keys: Sequence[str], ts: str, decimals: int | None
) -> DataFrame:
    total = F.col("value_sum") if decimals is None else F.round("value_sum", decimals)
    return parts.select(
        *keys,
        as_type(F.col("_first"), df, ts).alias("session_start"),
        as_type(F.col("_last"), df, ts).alias("last_reading"),
        as_type(F.col("_last") + F.col("_gap"), df, ts).alias("session_end"),
        total.alias("value_sum"),
        "value_count",
        "readings",
    )
