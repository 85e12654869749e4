"""Named queries on the `events` table that go by time: sketches, sessions, late readings
kept aside, timers, joins by time, frames by time, ranks and groupings."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge import operators as op
from tidegauge.plans.events import (
    AS_OF,
    BEFORE_FLUSH,
    HOUR,
    ONE_CUT,
    STATE_PARTS,
    WIDE_PRODUCTION,
    Query,
    _folders,
    _instants,
    _local,
    _wanted,
    arrivals,
    devices,
    telemetry,
)
from tidegauge.plans.replay import replay
from tidegauge.session import shared_folder, stream_session, utc
from tidegauge.sources import read_revisions
from tidegauge.streaming import (
    gaps_of,
    read_routed,
    read_sketches,
    silence_events,
    start_metrics,
    start_routed,
    start_sketches,
)

QUANTILES = {"p50": 0.5, "p95": 0.95}
DELAY_S = 2 * HOUR
SILENT_S = 1200

#: Seconds of silence that end a session, per device.
SESSION_GAPS = (("view", 1200), ("click", 1800), ("signup", 900), ("purchase", 2700), ("error", 1200))

#: Limits and the day from which they hold.
LIMIT_HISTORY = (
    ("view", "2024-01-03", 2.5, 150.0),
    ("view", "2024-01-17", 5.0, 90.0),
    ("click", "2023-12-01", 2.5, 150.0),
    ("click", "2024-01-09", 4.0, 120.0),
    ("click", "2024-01-25", 8.0, 60.0),
    ("error", "2024-01-30", 2.5, 150.0),
    ("signup", "2024-03-01", 2.5, 150.0),
)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared folder."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --- Sketches ------------------------------------------------------------------


def sketch_windows(spark, sf_dir):
    """Median, 95 % quantile, devices and sites per hour every half hour."""
    distinct = ("device_id", "site")
    panes = op.sketch_panes(telemetry(spark, sf_dir), HOUR // 2, distinct=distinct)
    windows = op.merged_sketches(panes, HOUR, HOUR // 2, distinct=distinct)
    return op.sketch_values(windows, QUANTILES, distinct)


def stream_sketches(spark, sf_dir):
    """The same from panes per device that a stream kept, late readings included."""
    table, checkpoint, landing = _folders(spark, "sketches", "checkpoint", "landing")
    fields = ("device_id", "site", "value", "event_time", "arrival_time")
    sent = _instants(arrivals(stream_session(spark, STATE_PARTS), sf_dir).select(*fields))

    def start(stream: DataFrame):
        return [
            start_sketches(
                stream, table, checkpoint, HOUR // 2, DELAY_S, distinct=["site"], available_now=True
            )
        ]

    replay(sent, "arrival_time", ONE_CUT, landing, start, [checkpoint, f"{checkpoint}-run"])
    panes = read_sketches(utc(spark), table)
    windows = op.merged_sketches(panes, HOUR, HOUR // 2, distinct=["site"])
    return _local(op.sketch_values(windows, QUANTILES, ["site"]))


# --- Late readings -------------------------------------------------------------


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counter readings under a delay too short for the flushes, kept and late ones."""
    table, checkpoint, landing = _folders(spark, "routed", "checkpoint", "landing")
    live = stream_session(spark, STATE_PARTS, small_state=True)
    rows = _instants(arrivals(live, sf_dir).drop("site"))
    own = rows.filter(F.col("device_id") == "purchase")

    def start(stream: DataFrame):
        readings = stream.drop("arrival_time", "_slice")
        return [start_routed(readings, table, checkpoint, HOUR, 120, available_now=True)]

    replay(own, "arrival_time", BEFORE_FLUSH, landing, start, [checkpoint, f"{checkpoint}-run"])
    return _local(read_routed(utc(spark), table, own.drop("arrival_time").schema))


def late_rows(spark, sf_dir):
    return _routed(spark, sf_dir).select("event_id", "device_id", "value", "event_time", "late")


def late_corrected(spark, sf_dir):
    """Hourly totals as the stream's metric had them, what came too late, and both."""
    totals = op.window_totals(_routed(spark, sf_dir), HOUR, keys=("late",))
    late = F.col("late")

    def part(which) -> F.Column:
        return F.round(F.coalesce(F.sum(F.when(which, F.col("value_sum"))), F.lit(0.0)), 2)

    return totals.groupBy("window_start").agg(
        part(~late).alias("kept_sum"),
        part(late).alias("late_sum"),
        part(F.lit(True)).alias("value_sum"),
        F.sum("value_count").alias("value_count"),
    )


def stream_revision_steps(spark, sf_dir):
    """Every revision that the hasty metric's batches stored, numbered by batch: late readings
    revise no window that has left the state, and a slice without readings stores nothing."""
    hasty = WIDE_PRODUCTION.widened(name="production_hasty", delay_s=120)
    table, checkpoints, landing = _folders(spark, "revisions", "checkpoints", "landing")

    def start(stream: DataFrame):
        return start_metrics(stream, table, checkpoints, [hasty], available_now=True)

    # Nothing arrives between the first cut and the next, a microsecond later.
    first, *others = BEFORE_FLUSH
    cuts = (first, f"{first}.000001", *others)
    replay(_wanted(spark, sf_dir, [hasty]), "arrival_time", cuts, landing, start, [checkpoints])
    stored_ = read_revisions(utc(spark), table)
    batches = stored_.select("run_id", "batch_id").distinct()
    # One row per batch.
    steps = batches.withColumn("step", F.dense_rank().over(Window.partitionBy("run_id").orderBy("batch_id")))
    found = stored_.join(steps, ["run_id", "batch_id"])
    return _local(found.select("step", "window_start", "value_sum", "value_count"))


# --- Timers and sessions on a stream -------------------------------------------


def _closed(sent: DataFrame, names: Sequence[str] = ("clock",), behind_s: int | None = None) -> DataFrame:
    """Arrivals with one more reading of each of ``names``, which moves the watermark to
    ``AS_OF`` at the end, or, with ``behind_s``, to so many seconds behind that and all readings."""
    at = F.expr(f"timestamp '{AS_OF}' + interval {DELAY_S} seconds")
    last = sent.sparkSession.createDataFrame([(n,) for n in names], "device_id string")
    if behind_s is not None:
        latest = F.greatest(F.expr(f"timestamp '{AS_OF}'"), F.max("event_time"))
        last = last.crossJoin(sent.agg(latest.alias("latest")))
        at = F.col("latest") + F.expr(f"interval {behind_s + DELAY_S} seconds")
    last = last.select("device_id", at.alias("event_time"), at.alias("arrival_time"))
    return sent.unionByName(last, allowMissingColumns=True)


def _appended(
    spark: SparkSession, sent: DataFrame, purpose: str, shape: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """What ``shape`` of the replayed arrivals emits, from the file sink."""
    path, checkpoint, landing = _folders(spark, purpose, "checkpoint", "landing")

    def start(stream: DataFrame):
        return [
            shape(stream)
            .writeStream.format("parquet")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        ]

    replay(sent, "arrival_time", (*ONE_CUT, AS_OF), landing, start, [checkpoint])
    return utc(spark).read.parquet(path)


def _arriving(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = arrivals(stream_session(spark, STATE_PARTS), sf_dir)
    return _instants(rows.select("event_id", "device_id", "value", "event_time", "arrival_time"))


def stream_silence(spark, sf_dir):
    """Silences and recoveries that timers told of, as stretches."""
    events = _appended(
        spark,
        _closed(_arriving(spark, sf_dir)),
        "silence",
        lambda stream: silence_events(stream, SILENT_S, DELAY_S),
    )
    return _local(gaps_of(events.where("device_id <> 'clock'")))


def session_gaps(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([*SESSION_GAPS, ("clock", 60)], "device_id string, gap_s int")


SESSION = ("device_id", "session_start", "last_reading", "session_end", "value_sum", "readings")


def session_windows(spark, sf_dir):
    rows = telemetry(spark, sf_dir).join(session_gaps(utc(spark)), "device_id")
    return op.session_totals(rows, "gap_s", decimals=2).select(*SESSION)


def stream_sessions(spark, sf_dir):
    def shape(stream: DataFrame) -> DataFrame:
        clocked = stream.withWatermark("event_time", f"{DELAY_S} seconds")
        rows = clocked.join(session_gaps(stream.sparkSession), "device_id")
        return op.session_totals(rows, "gap_s", decimals=2)

    found = _appended(spark, _closed(_arriving(spark, sf_dir)), "sessions", shape)
    return _local(found.where("device_id <> 'clock'").select(*SESSION))


# --- Joins by time -------------------------------------------------------------

NEAR_S = 300


def _near(rows: DataFrame, grouped: bool = False) -> DataFrame:
    views = rows.where("device_id = 'view'").select("event_id", "event_time", "value")
    clicks = rows.where("device_id = 'click'").select(
        F.col("event_id").alias("click_id"),
        F.col("event_time").alias("click_time"),
        F.col("value").alias("click_value"),
    )
    if rows.isStreaming:
        views = views.withWatermark("event_time", f"{DELAY_S} seconds")
        clicks = clicks.withWatermark("click_time", f"{DELAY_S} seconds")
    return op.near_in_time(views, clicks, NEAR_S, NEAR_S, right_ts="click_time", grouped=grouped)


def near_readings(spark, sf_dir):
    return _near(telemetry(spark, sf_dir))


def stream_near_readings(spark, sf_dir):
    """The same as a stream found them: it keeps the readings of each bucket and which are near,
    in proportion to the readings, and the pairs, of which there are more, are made of these."""
    # The last buckets reach beyond the last readings.
    sent = _closed(_arriving(spark, sf_dir), ("view", "click"), behind_s=4 * NEAR_S)
    groups = _appended(spark, sent, "near", lambda stream: _near(stream, grouped=True))
    return _local(op.near_pairs(groups).where("event_id is not null"))


def asof_limits(spark, sf_dir):
    """Each reading with the limits that were valid at its time."""
    spark = utc(spark)
    history = spark.createDataFrame(
        LIMIT_HISTORY, "device_id string, valid_from string, lo double, hi double"
    ).withColumn("valid_from", F.col("valid_from").cast("timestamp_ntz"))
    rows = telemetry(spark, sf_dir).drop("site")
    found = op.as_of(rows, history, ["device_id"], ["lo", "hi"], chunk_s=86_400)
    outside = (F.col("value") < F.col("lo")) | (F.col("value") > F.col("hi"))
    return found.withColumn("outside", outside)


def asof_last_view(spark, sf_dir):
    """Each error with the last view at its site."""
    rows = telemetry(spark, sf_dir)
    views = rows.where("device_id = 'view'").select(
        "site",
        F.col("event_time").alias("seen_at"),
        F.col("value").alias("seen_value"),
        F.col("event_id").alias("seen_id"),
    )
    errors = rows.where("device_id = 'error'").select("site", "event_id", "event_time")
    return op.as_of(
        errors, views, ["site"], ["seen_at", "seen_value"], valid_from="seen_at", tie=["seen_id"]
    )


def readings_in_spans(spark, sf_dir):
    """Readings of a site while one of its signups is under way, for 1 to 48 hours."""
    rows = telemetry(spark, sf_dir)
    hours = F.make_dt_interval(hours=(1 + F.col("event_id") % 48).cast("int"))
    spans = rows.where("device_id = 'signup'").select(
        "site",
        F.col("event_id").alias("span_id"),
        F.col("event_time").alias("span_start"),
        (F.col("event_time") + hours).alias("span_end"),
    )
    points = rows.where("device_id <> 'signup'").select("site", "event_id", "event_time")
    return op.within_spans(points, spans, ["site"]).select("event_id", "span_id")


# --- Frames, ranks, groupings, differences -------------------------------------


def time_baseline(spark, sf_dir):
    """Sum and number of readings of a device in the six hours up to each one."""
    rows = telemetry(spark, sf_dir).drop("site")
    found = op.time_totals(rows, ["device_id"], 6 * HOUR, decimals=2).drop("frame_values")
    return found.withColumnsRenamed({"frame_sum": "sum_6h", "frame_rows": "readings_6h"})


def time_extremes(spark, sf_dir):
    """Lowest and highest reading of a device within an hour of each one."""
    rows = telemetry(spark, sf_dir).drop("site")
    ends = {"lowest": {"low": "value"}, "highest": {"high": "value"}}
    return op.time_frames(rows, ["device_id"], {}, HOUR, HOUR, **ends)


def global_rank(spark, sf_dir):
    rows = telemetry(spark, sf_dir).select("event_id", "value")
    return op.global_ranks(rows, ["value"], lambda df: stored(df, "ranks"))


def global_tiles(spark, sf_dir):
    rows = telemetry(spark, sf_dir).select("event_id", "value")
    found = op.global_ranks(
        rows, ["value", "event_id"], lambda df: stored(df, "ranks"), tiles=7, descending=True
    )
    return found.select("event_id", F.col("rank").alias("nth"), "ntile")


def grouped_days(spark, sf_dir):
    """Daily totals by stage and device, by stage, by site, and of all."""
    sets = [["stage", "device_id"], ["stage"], ["site"], []]
    roster = devices(spark).select("device_id", "stage")
    return op.grouped_totals(telemetry(spark, sf_dir), sets, 24 * HOUR, roster, decimals=2)


def replay_difference(spark, sf_dir):
    """A replay that sent errors twice and lost every seventh reading, against its source."""
    rows = telemetry(spark, sf_dir).select("device_id", F.round("value", 0).alias("value"), "event_id")
    replayed = rows.where("event_id % 7 <> 0").unionByName(rows.where("device_id = 'error'"))
    return op.multiset_difference(rows, replayed, ["device_id", "value"])


QUERIES: dict[str, Query] = {
    "sketch_windows": sketch_windows,
    "stream_sketches": stream_sketches,
    "late_rows": late_rows,
    "late_corrected": late_corrected,
    "stream_revision_steps": stream_revision_steps,
    "stream_silence": stream_silence,
    "session_windows": session_windows,
    "stream_sessions": stream_sessions,
    "near_readings": near_readings,
    "stream_near_readings": stream_near_readings,
    "asof_limits": asof_limits,
    "asof_last_view": asof_last_view,
    "readings_in_spans": readings_in_spans,
    "time_baseline": time_baseline,
    "time_extremes": time_extremes,
    "global_rank": global_rank,
    "global_tiles": global_tiles,
    "grouped_days": grouped_days,
    "replay_difference": replay_difference,
}
