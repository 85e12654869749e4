"""Several metrics in one streaming query (EXT-3).

Cheaper than a query per metric, but late readings are judged differently: the
metrics share one watermark. In :func:`combined_stream` the slowest metric rules, so
more is accepted; in :func:`definition_stream` any listed device moves the clock, so
less is.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegauge.model import REVISION_FIELDS, REVISION_PARTITIONS, TRIGGER_S, MetricDef
from tidegauge.operators.windows import window_totals
from tidegauge.streaming.runner import _trigger, metric_stream
from tidegauge.streaming.sinks import FILES_PER_DAY, dealt_by_day, run_identity


def combined_stream(telemetry: DataFrame, metrics: Iterable[MetricDef]) -> DataFrame:
    """The streams of several metrics as one."""
    return reduce(
        DataFrame.unionByName,
        [metric_stream(telemetry, m).withColumn("metric", F.lit(m.name)) for m in metrics],
    )


def definition_stream(
    telemetry: DataFrame,
    definitions: DataFrame,
    shapes: Iterable[tuple[int, int]],
    delay_s: int,
    decimals: int | None = None,
) -> DataFrame:
    """All metrics of a definition table over a stream, one branch per window shape.

    ``shapes`` are the pairs (size_s, slide_s) that the definitions use; each is a branch
    of the plan with state of its own. A definition of another shape ends the query. New rows
    for known shapes need no new code, only a restart on a new checkpoint. Readings of
    devices that no definition lists leave before the watermark.
    """
    shapes = sorted(set(shapes))
    known = reduce(
        lambda a, b: a | b,
        [(F.col("size_s") == size) & (F.col("slide_s") == slide) for size, slide in shapes],
    )
    unknown = F.concat(
        F.lit("no branch for windows of "), "size_s", F.lit(" by "), "slide_s", F.lit(" seconds")
    )
    checked = definitions.withColumn(
        "metric", F.when(known, F.col("metric")).otherwise(F.raise_error(unknown))
    )
    listed = telemetry.join(
        checked.filter(F.col("metric").isNotNull()).select("device_id").distinct(),
        "device_id",
        "left_semi",
    )
    timed = listed.withWatermark("event_time", f"{delay_s} seconds")

    def branch(size_s: int, slide_s: int) -> DataFrame:
        of_shape = (F.col("size_s") == size_s) & (F.col("slide_s") == slide_s)
        wanted = definitions.filter(of_shape).select("metric", "device_id")
        return window_totals(
            timed.join(wanted, "device_id"), size_s, slide_s, ["metric"], decimals=decimals
        )

    return reduce(DataFrame.unionByName, [branch(*shape) for shape in shapes])


def start_combined(
    windows: DataFrame,
    table: str,
    checkpoint: str,
    available_now: bool = False,
    trigger_s: int = TRIGGER_S,
    files: int = FILES_PER_DAY,
) -> StreamingQuery:
    """Stores such a stream in the revision table.

    A batch replaces exactly the directories it writes, so repeating it is safe. It
    writes at most ``files`` files for each metric and day.
    """
    run_id = run_identity(windows.sparkSession, checkpoint, table)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumns(
            {
                "site": F.lit(None).cast("string"),
                "computed_at": F.current_timestamp(),
                "run_id": F.lit(run_id),
                "batch_id": F.lit(batch_id),
                "window_date": F.to_date("window_start"),
            }
        )
        partitions = REVISION_PARTITIONS.fieldNames()
        stored = rows.select(*REVISION_FIELDS.fieldNames(), *partitions)
        (
            dealt_by_day(stored, files, ["window_start"])
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partitions)
            .parquet(table)
        )

    return (
        windows.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(available_now, trigger_s))
        .foreachBatch(write)
        .start()
    )
