"""Frames by time around each row, without one task per key (AGG-8, WIN-3 by time)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidegauge.functions import micros

US = 1_000_000


def time_frames(
    df: DataFrame,
    keys: Sequence[str],
    aggregates: Mapping[str, Column],
    before_s: float,
    after_s: float = 0,
    ts: str = "event_time",
    chunk_s: int | None = None,
    lowest: Mapping[str, str] | None = None,
    highest: Mapping[str, str] | None = None,
) -> DataFrame:
    """Adds aggregates over the rows of the same keys from ``before_s`` seconds before each
    row to ``after_s`` after it, both included: the row itself and its equals in time too.
    ``lowest`` and ``highest`` name columns for the smallest and the largest value of another
    one, nulls left out.

    Unlike the frames of :func:`neighbour_frames` these go by time, not by position. Keys are
    cut into chunks of ``chunk_s`` seconds (four frames unless told otherwise); a row is
    copied as a halo into the other chunks whose frames reach it, and dropped there when the
    frames are done. A task sorts one chunk and its halo, so a key with a third of all rows
    is spread over its chunks, and a sparse one has few copies. Rows without time have no
    frame and are left out. For each of ``aggregates`` a frame is gone through anew; the cost of
    ``lowest`` and ``highest`` does not grow with the rows in a frame, and for sums and counts
    of dense readings see :func:`time_totals`.
    """
    before, after = round(before_s * US), round(after_s * US)
    spread = _with_halo(df, before, after, ts, chunk_s)
    frame = Window.partitionBy(*keys, "_chunk").orderBy("_at").rangeBetween(-before, after)
    found = spread.withColumns({n: a.over(frame) for n, a in aggregates.items()})
    wanted = [(n, c, F.min, F.least) for n, c in (lowest or {}).items()]
    wanted += [(n, c, F.max, F.greatest) for n, c in (highest or {}).items()]
    if wanted:
        found = _with_extremes(found, keys, before, after, wanted)
    return found.where("_chunk = _own").select(*df.columns, *aggregates, *[n for n, *_ in wanted])


def _with_extremes(
    spread: DataFrame,
    keys: Sequence[str],
    before: int,
    after: int,
    wanted: Sequence[tuple[str, str, Callable[..., Column], Callable[..., Column]]],
) -> DataFrame:
    """Adds smallest and largest values of frames to rows :func:`_with_halo` has dealt.

    ``wanted`` holds name, column, aggregate and the function of two values that goes with it.
    Time is cut into blocks as long as a frame, so a frame is the end of one block and the
    beginning of the next. Each row first gets the extremes of its block from its beginning to
    the row, and from the row to its end; a frame then looks up the first of these at its last
    row and the second at its first one. All windows begin with their chunk or block and only
    grow, those that look back in the order of time reversed.
    """
    at, size = F.col("_at"), before + after + 1
    # Dealt once, by chunk: windows over a block of a chunk need no shuffle of their own.
    rows = spread.repartition(*keys, "_chunk").withColumns({"_block": F.floor(at / size), "_back": -at})
    chunk, block = [*keys, "_chunk"], [*keys, "_chunk", "_block"]

    def seen(by: Sequence[str], order: str, ahead: int) -> WindowSpec:
        return Window.partitionBy(*by).orderBy(order).rangeBetween(Window.unboundedPreceding, ahead)

    def of(order: str, name: str, reach: int) -> DataFrame:
        extremes = [aggregate(c).over(seen(block, order, 0)).alias(n) for n, c, aggregate, _ in wanted]
        place = F.struct(F.col("_block").alias("block"), *extremes)
        return rows.withColumn(name, place).withColumn(name, F.last(name).over(seen(chunk, order, reach)))

    rows = of("_at", "_until", after)
    rows = of("_back", "_since", before)
    first = F.floor((at - before) / size)
    return rows.withColumns(
        {
            n: both(
                F.when(F.col("_since.block") == first, F.col(f"_since.{n}")),
                F.when(F.col("_until.block") > first, F.col(f"_until.{n}")),
            )
            for n, _, _, both in wanted
        }
    )


def _with_halo(df: DataFrame, before: int, after: int, ts: str, chunk_s: int | None) -> DataFrame:
    """Rows with their time, their chunk, and copies for other chunks whose frames reach them."""
    size = (chunk_s * US) if chunk_s else max(US, 4 * (before + after))
    at = F.col("_at")
    # Frames that reach a row are those of rows up to `before` behind it, `after` ahead.
    reached = F.sequence(F.floor((at - after) / size), F.floor((at + before) / size))
    return (
        df.withColumn("_at", micros(F.col(ts)))
        .where("_at is not null")
        .withColumns({"_own": F.floor(at / size), "_chunk": F.explode(reached)})
    )


def time_totals(
    df: DataFrame,
    keys: Sequence[str],
    before_s: float,
    after_s: float = 0,
    ts: str = "event_time",
    value: str = "value",
    chunk_s: int | None = None,
    decimals: int | None = None,
) -> DataFrame:
    """Adds ``frame_sum``, ``frame_values`` (non-null ones) and ``frame_rows`` over the same
    frames as :func:`time_frames`, at a cost that does not grow with the rows in a frame.

    A frame is what has come up to its end less what had come before its beginning, two
    running totals of the chunk and its halo. ``frame_sum`` is null without a value; NaN and
    infinite values make the frames behind them in their chunk NaN. The floating error is
    that of sums over a chunk; ``decimals`` takes it off, as in :func:`window_totals`.
    """
    before, after = round(before_s * US), round(after_s * US)
    running = Window.partitionBy(*keys, "_chunk").orderBy("_at")
    until = running.rangeBetween(Window.unboundedPreceding, after)
    ahead = running.rangeBetween(Window.unboundedPreceding, -before - 1)

    def frame(total: Column) -> Column:
        return F.coalesce(total.over(until), F.lit(0)) - F.coalesce(total.over(ahead), F.lit(0))

    total = frame(F.sum(value))
    total = total if decimals is None else F.round(total, decimals)
    found = _with_halo(df, before, after, ts, chunk_s).withColumns(
        {
            "_total": total,
            "frame_values": frame(F.count(value)),
            "frame_rows": frame(F.count(F.lit(1))),
        }
    )
    return (
        found.where("_chunk = _own")
        .withColumn("frame_sum", F.when(F.col("frame_values") > 0, F.col("_total")))
        .select(*df.columns, "frame_sum", "frame_values", "frame_rows")
    )
