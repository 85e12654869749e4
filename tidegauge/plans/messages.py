"""Published shapes of the metrics (SNK-3 … SNK-6, PRJ-5, FN-4, FN-7)."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions import iso
from tidegauge.model import MetricDef
from tidegauge.operators.windows import with_mean


def encode(windows: DataFrame, metric: MetricDef, computed_at: Column | None = None) -> DataFrame:
    """Window rows as the records of a metric's topic.

    Window bounds are ISO text without offset, the computation time carries one.
    Without ``computed_at`` it is the time of the batch.
    """
    stamp = F.current_timestamp() if computed_at is None else computed_at
    rows = with_mean(windows)

    def field(name: str) -> Column:
        return iso(F.col(name)) if name.startswith("window_") else F.col(name)

    return rows.select(
        F.lit(metric.name).alias("metric"),
        *[field(ours).alias(theirs) for theirs, ours in metric.message],
        iso(stamp, offset=True).alias("computed_at"),
    )


def metric_topic(records: Iterable[DataFrame]) -> DataFrame:
    """Records of several metrics as one stream; fields a metric lacks are null (SET-1)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), records)
