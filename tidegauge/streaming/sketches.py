"""A stream that keeps sketches of its panes, revision by revision."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegauge.model import TRIGGER_S
from tidegauge.operators.latest import latest_revision
from tidegauge.operators.sketches import sketch_panes
from tidegauge.streaming.runner import _trigger
from tidegauge.streaming.sinks import FILES_PER_DAY, dealt_by_day, run_identity


def start_sketches(
    telemetry: DataFrame,
    table: str,
    checkpoint: str,
    pane_s: int,
    delay_s: int,
    keys: Sequence[str] = ("device_id",),
    distinct: Sequence[str] = (),
    available_now: bool = False,
    trigger_s: int = TRIGGER_S,
    files: int = FILES_PER_DAY,
) -> StreamingQuery:
    """Starts the query that stores the sketches of the panes each batch changed.

    A late reading within ``delay_s`` gives its pane one more revision. State is one sketch
    per open pane and key, whatever the number of readings. Rows are laid out by the day of
    their pane; a batch owns its directory and overwrites it.
    """
    run = run_identity(telemetry.sparkSession, checkpoint, table)
    panes = sketch_panes(
        telemetry.withWatermark("event_time", f"{delay_s} seconds"), pane_s, keys, distinct
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        place = f"{table}/run_id={run}/batch_id={batch_id}"
        dated = batch.withColumn("window_date", F.to_date("window_start"))
        dealt = dealt_by_day(dated, files, [*keys, "window_start"])
        dealt.write.mode("overwrite").partitionBy("window_date").parquet(place)

    return (
        panes.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(available_now, trigger_s))
        .foreachBatch(write)
        .start()
    )


def read_sketches(
    spark: SparkSession, table: str, keys: Sequence[str] = ("device_id",), first_day: str | None = None
) -> DataFrame:
    """The last revision of every pane; with ``first_day`` of panes from that day on, no
    other directory being read."""
    rows = spark.read.parquet(table)
    if first_day is not None:
        rows = rows.where(F.col("window_date") >= F.lit(first_day).cast("date"))
    last = latest_revision(rows.drop("window_date"), (*keys, "window_start"))
    return last.drop("run_id", "batch_id")
