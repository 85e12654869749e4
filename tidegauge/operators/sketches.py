"""Quantiles and distinct counts per window from mergeable sketches (AGG, STR-2 … STR-5).

A sketch is a short binary value that stands for a set of readings: two of them merge into
the sketch of both sets. Panes keep one each, sliding windows merge the panes they cover,
and a stream keeps the revisions of its panes, so a wider window or a coarser key never
needs the readings again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of a quantile sketch (its k): sets up to this size are kept whole, larger ones
#: within :func:`rank_error`.
SKETCH_SIZE = 400
#: log2 of the registers of a distinct-count sketch: 1.04 / 2 ** (lg / 2) relative error.
DISTINCT_LG = 12


def rank_error(size: int = SKETCH_SIZE) -> float:
    """How far the rank of a returned quantile may be off, at 99 % confidence, as a share
    of the readings (published for KLL sketches, the same after any merging)."""
    return 2.296 / size**0.9723


def distinct_error(lg: int = DISTINCT_LG) -> float:
    """Relative standard error of a distinct count."""
    return 1.04 / 2 ** (lg / 2)


def sketch_panes(
    df: DataFrame,
    pane_s: int,
    keys: Sequence[str] = (),
    distinct: Sequence[str] = (),
    ts: str = "event_time",
    value: str = "value",
    size: int = SKETCH_SIZE,
    lg: int = DISTINCT_LG,
) -> DataFrame:
    """Sketches per key and tumbling pane: ``window_start``, ``value_count``,
    ``value_sketch`` and for each column of ``distinct`` its ``<name>_sketch``.

    Runs on tables and, behind a watermark, on streams. Each task sketches its own readings
    before the shuffle, so a key with a third of all rows moves no more than another. Null
    and NaN values are not in the sketch; null values of a distinct column are no value.
    """
    span = F.window(ts, f"{pane_s} seconds")
    number = F.when(~F.isnan(value), F.col(value))
    return (
        df.groupBy(*keys, span.alias("span"))
        .agg(
            F.count(number).alias("value_count"),
            F.kll_sketch_agg_double(number, F.lit(size)).alias("value_sketch"),
            *[
                F.hll_sketch_agg(F.col(c).cast("string"), F.lit(lg)).alias(f"{c}_sketch")
                for c in distinct
            ],
        )
        .withColumn("window_start", F.col("span.start"))
        .select(
            *keys, "window_start", "value_count", "value_sketch", *[f"{c}_sketch" for c in distinct]
        )
    )


def merged_sketches(
    panes: DataFrame,
    size_s: int,
    slide_s: int | None = None,
    keys: Sequence[str] = (),
    distinct: Sequence[str] = (),
) -> DataFrame:
    """Sketches of windows, from those of the panes that they cover; with fewer ``keys``
    than the panes have, also over keys. ``size_s`` and ``slide_s`` are multiples of the pane."""
    span = F.window("window_start", f"{size_s} seconds", f"{slide_s or size_s} seconds")
    return (
        panes.groupBy(*keys, span.alias("span"))
        .agg(
            F.sum("value_count").alias("value_count"),
            F.kll_merge_agg_double("value_sketch").alias("value_sketch"),
            *[F.hll_union_agg(f"{c}_sketch").alias(f"{c}_sketch") for c in distinct],
        )
        .withColumns({"window_start": F.col("span.start"), "window_end": F.col("span.end")})
        .drop("span")
    )


def sketch_values(
    windows: DataFrame, quantiles: Mapping[str, float], distinct: Sequence[str] = ()
) -> DataFrame:
    """Sketches replaced by what they say: a column for each quantile, null where a window
    has no value, and ``<name>_count`` for each distinct column."""

    def quantile(q: float) -> Column:
        # A sketch of no value has no quantiles and must not be asked.
        found = F.kll_sketch_get_quantile_double("value_sketch", F.lit(q))
        return F.when(F.col("value_count") > 0, found)

    return windows.withColumns(
        {
            **{name: quantile(q) for name, q in quantiles.items()},
            **{f"{c}_count": F.hll_sketch_estimate(f"{c}_sketch") for c in distinct},
        }
    ).drop("value_sketch", *[f"{c}_sketch" for c in distinct])
