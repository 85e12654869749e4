"""Newest row per key and newest rows overall (WIN-1, WIN-2, LIM-3, LIM-4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.model import REVISION_ORDER, WINDOW_KEY


def latest_per_device(df: DataFrame, arrival: str, key: str = "device_id") -> DataFrame:
    """The reading that arrived last, per device (WIN-1, FLT-9).

    ``arrival`` must be unique per device (a sequence number, an offset): each field
    is picked by it on its own, which keeps the aggregation in fixed-width hash
    buffers. Arrival counts, not event time. Runs on streams in update mode, with
    one state row per device.
    """
    fields = [c for c in df.columns if c not in (key, arrival)]
    known = df.filter(F.col(key).isNotNull() & (F.col(key) != ""))
    return known.groupBy(key).agg(
        *[F.max_by(c, arrival).alias(c) for c in fields], F.max(arrival).alias(arrival)
    )


def _total_order(df: DataFrame, order: Sequence[str]) -> Column:
    """One column that sorts like ``order``, of a fixed width wherever whole numbers allow:
    aggregation then stays in hash buffers instead of sorting all rows first."""
    kinds = dict(df.dtypes)
    if len(order) == 1:
        return F.col(order[0])
    if len(order) == 2 and all(kinds[c] in ("bigint", "int") for c in order):
        high, low = (F.col(c).cast("decimal(19,0)") for c in order)
        return (high * F.lit("1" + "0" * 19).cast("decimal(20,0)") + low).cast("decimal(38,0)")
    return F.struct(*order)


def latest_revision(
    revisions: DataFrame,
    keys: Sequence[str] = WINDOW_KEY,
    order: Sequence[str] = REVISION_ORDER,
) -> DataFrame:
    """The last revision of each window (WIN-2).

    ``order`` is the run and then the batch of the query that owns the metric; the
    time of computation is no order, as it has ties and clocks move. It must tell the
    revisions of a window apart, as each field is picked by it on its own.
    """
    last = _total_order(revisions, order)
    fields = [c for c in revisions.columns if c not in keys]
    picked = revisions.groupBy(*keys).agg(*[F.max_by(c, last).alias(c) for c in fields])
    return picked.select(*keys, *[c for c in fields if c not in order], *order)


def newest(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The newest ``n`` rows: each task keeps its own ``n``, then they are merged."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)
