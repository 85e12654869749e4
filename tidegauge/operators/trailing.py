"""Frames over neighbouring rows, without one task per key (WIN-3)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def neighbour_frames(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    before: int,
    after: int,
    aggregates: Mapping[str, Column],
    chunk_s: int | Sequence[int] = 7 * 86_400,
    tie: Sequence[str] = (),
    keep: Column | None = None,
) -> DataFrame:
    """Adds aggregates over each row, ``before`` rows ahead of it and ``after`` behind.

    Rows are neighbours by position in ``order`` (a timestamp; ``tie`` makes it
    total) within ``keys``, not by time, so gaps do not matter. ``keep`` returns only
    rows whose aggregates satisfy it.

    A window over the keys alone would put a whole series into one task. Here each
    key is cut into time chunks, and only the edges of a chunk, its first and last
    ``before + after`` rows, which hold all rows that a frame across its ends can
    reach, go on to the next, longer chunks of ``chunk_s``, and at last to a window
    over the key. So behind the first level a task sees of a key at most twice
    ``before + after`` rows for each shorter chunk in a longer one, at any density, and
    the last window as many for each longest chunk. Other rows pass the later windows in
    their own chunks, or leave before them by ``keep``. The input is read once.
    """
    levels = [chunk_s] if isinstance(chunk_s, int) else list(chunk_s)
    reach = before + after
    by_order = [F.col(order), *[F.col(t) for t in tie]]
    window = Window.partitionBy(*keys, "_level", "_group").orderBy(*by_order)

    def followed_by(n: int) -> Column:
        return F.lead(F.lit(True), n, False).over(window)

    def chunk(size_s: int) -> Column:
        return F.window(order, f"{size_s} seconds")["start"]

    rows = df.filter(F.col(order).isNotNull()).withColumns(
        {"_level": F.lit(0), "_group": chunk(levels[0])}
    )
    names = list(aggregates)
    for level in range(len(levels) + 1 if reach else 1):
        here = F.col("_level") == level
        over = {n: agg.over(window.rowsBetween(-before, after)) for n, agg in aggregates.items()}
        found = rows.withColumns(
            {
                "_nth": F.row_number().over(window),
                "_whole": followed_by(after),
                "_inner": followed_by(reach),
                **{f"_{n}": v for n, v in over.items()},
            }
        )
        # Rows whose frame an earlier level has seen whole keep what it found.
        open_ = here & ~F.col("_done") if level else here
        rows = found.withColumns(
            {n: F.when(open_, F.col(f"_{n}")).otherwise(F.col(n)) for n in names}
            if level
            else {n: F.col(f"_{n}") for n in names}
        )
        if level == len(levels) or not reach:
            break
        whole = here & (F.col("_nth") > before) & F.col("_whole")
        edge = here & ((F.col("_nth") <= reach) | ~F.col("_inner"))
        if keep is not None:
            rows = rows.filter(edge | keep)
        following = chunk(levels[level + 1]) if level + 1 < len(levels) else None
        longer = F.lit(None) if following is None else following
        rows = rows.withColumns(
            {
                "_done": (F.col("_done") | whole) if level else whole,
                "_group": F.when(edge, longer).otherwise(F.col("_group")),
                "_level": F.when(edge, level + 1).otherwise(F.col("_level")),
            }
        ).drop("_nth", "_whole", "_inner", *[f"_{n}" for n in names])
    result = rows.select(*df.columns, *aggregates)
    return result if keep is None else result.filter(keep)


def trailing(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    n: int,
    aggregates: Mapping[str, Column],
    **how,
) -> DataFrame:
    """Adds aggregates over the last ``n`` rows, the current one included."""
    return neighbour_frames(df, keys, order, n - 1, 0, aggregates, **how)
