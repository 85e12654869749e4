"""Late data: revision log, convergence, finality (LATE-1, LATE-2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.operators.windows import metrics_by_definition, window_totals


def accumulate(
    parts: DataFrame,
    keys: Sequence[str] = (),
    batch: str = "batch_start",
    decimals: int | None = None,
) -> DataFrame:
    """Totals per (window, arrival batch) to totals of everything arrived so far.

    The running part sees one row per batch that touched a window, never readings.
    """
    window = Window.partitionBy(*keys, "window_start", "window_end").orderBy(batch)
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("value_sum").over(so_far)
    return parts.select(
        *keys,
        "window_start",
        "window_end",
        batch,
        F.row_number().over(window).alias("revision"),
        (total if decimals is None else F.round(total, decimals)).alias("value_sum"),
        F.sum("value_count").over(so_far).alias("value_count"),
    )


def arrival_batch(df: DataFrame, batch_s: int, arrival: str = "arrival_time") -> DataFrame:
    """Adds ``batch_start``, the start of the batch in which a reading arrived."""
    return df.withColumn("batch_start", F.window(arrival, f"{batch_s} seconds")["start"])


def revision_log(
    df: DataFrame,
    size_s: int,
    batch_s: int,
    keys: Sequence[str] = (),
    slide_s: int | None = None,
    arrival: str = "arrival_time",
    decimals: int | None = None,
) -> DataFrame:
    """What was known of each window after each arrival batch that touched it (LATE-1).

    A row per (window, arrival batch): totals of everything arrived so far and a
    revision number.
    """
    arrived = arrival_batch(df, batch_s, arrival)
    parts = window_totals(arrived, size_s, slide_s, (*keys, "batch_start"))
    return accumulate(parts, keys, decimals=decimals)


def revisions_by_definition(
    df: DataFrame,
    definitions: DataFrame,
    pane_s: int,
    batch_s: int,
    arrival: str = "arrival_time",
    decimals: int | None = None,
) -> DataFrame:
    """The revision logs of all metrics of a definition table, in one scan."""
    arrived = arrival_batch(df, batch_s, arrival)
    parts = metrics_by_definition(arrived, definitions, pane_s, ("batch_start",))
    return accumulate(parts, ("metric",), decimals=decimals)


def convergence(
    streamed: DataFrame,
    recomputed: DataFrame,
    keys: Sequence[str] = ("metric", "site", "window_start", "window_end"),
    tolerance: float = 1e-9,
) -> DataFrame:
    """Windows on which a stream's latest view and a batch recompute differ (LATE-2).

    Empty when every late reading was taken in. Sums may differ by the relative
    ``tolerance``, as floating addition depends on the order.
    """
    s, b = streamed.alias("s"), recomputed.alias("b")
    same_window = [F.col(f"s.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    ssum, bsum = F.col("s.value_sum"), F.col("b.value_sum")
    scount, bcount = F.col("s.value_count"), F.col("b.value_count")
    slack = F.lit(tolerance) * F.greatest(F.abs(ssum), F.abs(bsum), F.lit(1.0))
    sums_agree = ssum.eqNullSafe(bsum) | F.coalesce(F.abs(ssum - bsum) <= slack, F.lit(False))
    return (
        s.join(b, same_window, "full_outer")
        .filter(~(scount.eqNullSafe(bcount) & sums_agree))
        .select(
            *[F.coalesce(F.col(f"s.{k}"), F.col(f"b.{k}")).alias(k) for k in keys],
            ssum.alias("stream_sum"),
            scount.alias("stream_count"),
            bsum.alias("batch_sum"),
            bcount.alias("batch_count"),
        )
    )


def mark_final(windows: DataFrame, as_of: Column, delay_s: int) -> DataFrame:
    """Adds ``is_final``: false while a window may still be partial or corrected."""
    closed = F.col("window_end") + F.expr(f"interval {delay_s} seconds") <= as_of
    return windows.withColumn("is_final", closed)
