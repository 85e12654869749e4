"""Streaming runner: watermark, update mode, trigger, checkpoint (STR-1, STR-6 … STR-11)."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidegauge.model import METRICS, TRIGGER_S, MetricDef
from tidegauge.operators.latest import latest_per_device
from tidegauge.operators.windows import window_totals
from tidegauge.streaming.sinks import FILES_PER_DAY, revision_writer, run_identity


def metric_stream(
    telemetry: DataFrame, metric: MetricDef, keys: Sequence[str] = ()
) -> DataFrame:
    """Windowed totals of one metric over a telemetry stream (STR-1 … STR-5).

    The device filter comes before the watermark: the metric's own devices alone
    move its clock. A silent device therefore holds its windows open, and the
    allowed delay bounds disorder within the metric only. Each metric may have a
    delay of its own (EXT-5).
    """
    own = telemetry.filter(F.col("device_id").isin(*metric.devices)).withWatermark(
        "event_time", f"{metric.delay_s} seconds"
    )
    return window_totals(
        own, metric.size_s, metric.slide_s, keys, decimals=metric.decimals
    )


def _trigger(available_now: bool, trigger_s: int) -> dict:
    if available_now:
        return {"availableNow": True}
    return {"processingTime": f"{trigger_s} seconds"}


def start_metric(
    telemetry: DataFrame,
    metric: MetricDef,
    table: str,
    checkpoints: str,
    keys: Sequence[str] = (),
    available_now: bool = False,
    trigger_s: int = TRIGGER_S,
    after: Callable[[DataFrame, int], None] | None = None,
    files: int = FILES_PER_DAY,
) -> StreamingQuery:
    """Starts the query of one metric into the revision table (STR-6 … STR-8).

    Update mode: a batch brings the windows it changed, partial ones included, so a
    late reading shows up as one more revision of its window. State lives as long
    as the watermark needs it (STR-11). ``keys`` may be ``("site",)`` (EXT-7).
    """
    checkpoint = f"{checkpoints.rstrip('/')}/{metric.name}"
    spark = telemetry.sparkSession
    run_id = run_identity(spark, checkpoint, table)
    writer = (
        metric_stream(telemetry, metric, keys)
        .writeStream.queryName(metric.name)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(available_now, trigger_s))
        .foreachBatch(revision_writer(table, metric, run_id, after, files))
    )
    # The query's thread inherits the pool: under the FAIR scheduler a metric with a
    # long batch does not hold up the others.
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", metric.name)
    try:
        return writer.start()
    finally:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)


def start_metrics(
    telemetry: DataFrame,
    table: str,
    checkpoints: str,
    metrics: Iterable[MetricDef] = METRICS,
    **how,
) -> list[StreamingQuery]:
    """One query per metric, side by side (STR-9).

    Merging them into one query would tie their watermarks together and change
    which late readings are accepted. If one cannot be started, those that were are
    stopped again.
    """
    started: list[StreamingQuery] = []
    try:
        for metric in metrics:
            started.append(start_metric(telemetry, metric, table, checkpoints, **how))
    except BaseException:
        _stop(started)
        raise
    return started


def _stop(queries: Iterable[StreamingQuery]) -> None:
    for query in queries:
        if query.isActive:
            query.stop()


def latest_reading_query(
    telemetry: DataFrame,
    arrival: str,
    path: str,
    checkpoint: str,
    available_now: bool = False,
    trigger_s: int = TRIGGER_S,
) -> StreamingQuery:
    """Keeps the latest reading per device (WIN-1); state is one row per device.

    Each batch stores the devices it changed under its batch number.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # One row per device that changed, in few files; the state's tasks stay as they are.
        batch.repartition(FILES_PER_DAY, "device_id").write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        latest_per_device(telemetry, arrival)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(available_now, trigger_s))
        .foreachBatch(write)
        .start()
    )


def await_all(queries: Iterable[StreamingQuery]) -> None:
    """Waits for queries that end by themselves; the first error is raised."""
    for query in queries:
        query.awaitTermination()


def run_until_any_ends(queries: Sequence[StreamingQuery], poll_s: float = 1.0) -> None:
    """Blocks until one of ``queries`` ends or fails, then stops the others (STR-9, SNK-8).

    Waits for each in turn, for ``poll_s`` seconds in all, so other queries of the session,
    running or ended, have no part in it. The error of a failed query is raised.
    """
    if not queries:
        return
    try:
        while not any(q.awaitTermination(poll_s / len(queries)) for q in queries):
            pass
    finally:
        _stop(queries)


PROGRESS_SCHEMA = (
    "query_id string, run_id string, name string, batch_id long, input_rows long, "
    "watermark string, dropped long, state_rows long"
)


def _progress_row(p) -> dict:
    return {
        "query_id": str(p.id),
        "run_id": str(p.runId),
        "name": p.name,
        "batch_id": p.batchId,
        "input_rows": p.numInputRows,
        "watermark": p.eventTime.get("watermark"),
        "dropped": sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
        "state_rows": sum(s.numRowsTotal for s in p.stateOperators),
    }


class ProgressLog(StreamingQueryListener):
    """Writes the progress of every batch of a session's streams to a table (EXT-4).

    Spark itself keeps only the last hundred events of a query. Rows are written in
    blocks of ``block`` events and whenever a query ends. Add it before the queries start
    and call :meth:`close` at the end.
    """

    def __init__(self, spark: SparkSession, path: str, block: int = 100):
        self._spark, self._path, self._block = spark, path, block
        self._rows: list[dict] = []
        self._lock = Lock()
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self._lock:
            self._rows.append(_progress_row(event.progress))
            if len(self._rows) >= self._block:
                self._write()

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._write()

    def _write(self) -> None:
        if self._rows:
            rows = self._spark.createDataFrame(self._rows, PROGRESS_SCHEMA)
            rows.coalesce(1).write.mode("append").parquet(self._path)
            self._rows = []

    def close(self) -> None:
        """Waits for events under way, writes the rest and stops listening."""
        self._spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        self._spark.streams.removeListener(self)
        with self._lock:
            self._write()


def watermark_report(spark: SparkSession, path: str) -> DataFrame:
    """Watermark and dropped rows of every batch that a :class:`ProgressLog` wrote
    (STR-10, EXT-4). For sliding windows a dropped row is counted once per window."""
    return spark.read.schema(PROGRESS_SCHEMA).parquet(path)


def recent_progress(query: StreamingQuery) -> list[dict]:
    """The same of the last batches of one query, as many as Spark keeps."""
    return [_progress_row(p) for p in query.recentProgress]
