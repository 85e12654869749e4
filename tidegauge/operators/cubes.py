"""Totals of several groupings at once, and tables compared row by row with their counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.operators.windows import panes


def grouped_totals(
    df: DataFrame,
    sets: Sequence[Sequence[str]],
    pane_s: int,
    attributes: DataFrame | None = None,
    on: str = "device_id",
    ts: str = "event_time",
    value: str = "value",
    decimals: int | None = None,
) -> DataFrame:
    """Sum and count per pane for every grouping of ``sets``, with ``grouping_id``.

    Readings shrink to panes per finest key, in each task before the shuffle; panes get
    the ``attributes`` of their device (a roster, joined by ``on``), and only these few
    rows are expanded to the groupings. A column that a grouping leaves out is null, and its
    bit in ``grouping_id`` is one (the first column named is the highest bit), which tells
    it from a null key. ``sets`` may be those of :func:`rollup_sets`.
    """
    names = list(dict.fromkeys(c for s in sets for c in s))
    taken = [] if attributes is None else [c for c in attributes.columns if c != on]
    finest = [c for c in names if c not in taken]
    if attributes is not None and on not in finest:
        finest.append(on)
    parts = panes(df, pane_s, finest, ts, value)
    if attributes is not None:
        parts = parts.join(attributes, on, "left")
    sets = [[*map(F.col, s), F.col("window_start")] for s in sets]
    total = F.sum("value_sum")
    return (
        parts.groupingSets(sets, *names, "window_start")
        .agg(
            # The time is in every set, its lowest bit is always zero.
            F.shiftright(F.grouping_id(), 1).cast("int").alias("grouping_id"),
            (total if decimals is None else F.round(total, decimals)).alias("value_sum"),
            F.sum("value_count").alias("value_count"),
        )
        .select(*names, "grouping_id", "window_start", "value_sum", "value_count")
    )


def rollup_sets(columns: Sequence[str]) -> list[list[str]]:
    """All columns, then one less from the right each time, down to none."""
    return [list(columns[:n]) for n in range(len(columns), -1, -1)]


def multiset_difference(left: DataFrame, right: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows whose number differs between two tables: the row, ``n_left``, ``n_right`` and
    ``excess`` (left minus right). Reconciles a replay with its source.

    Null equals null. Each task counts its rows before the one shuffle that both sides
    share, so a row that a third of a table repeats is one row there; no side is joined.
    """
    names = list(columns or left.columns)

    def counted(df: DataFrame, n_left: int, n_right: int) -> DataFrame:
        return df.select(*names, F.lit(n_left).alias("_left"), F.lit(n_right).alias("_right"))

    return (
        counted(left, 1, 0)
        .unionByName(counted(right, 0, 1))
        .groupBy(*names)
        .agg(F.sum("_left").alias("n_left"), F.sum("_right").alias("n_right"))
        .withColumn("excess", F.col("n_left") - F.col("n_right"))
        .where("excess <> 0")
    )
