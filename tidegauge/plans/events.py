"""The `events` table in the role of a sensor stream, and its named queries.

Event types stand for devices: view and click are the temperature pair, purchase
the counter, error the vibration sensor, signup any other sensor; `event_id` is
the order of arrival. Events are sparse, so each metric also exists with wide
windows and a threshold that fits their values.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge import functions as fn
from tidegauge import operators as op
from tidegauge.model import (
    BUFFER_ROWS,
    COMPLIANCE,
    PRODUCTION,
    TAIL_ROWS,
    TEMPERATURE,
    VIBRATION,
    MetricDef,
)
from tidegauge.operators.windows import common_pane
from tidegauge.plans.messages import encode, metric_topic
from tidegauge.plans.replay import replay
from tidegauge.session import remove, shared_folder, stream_session, utc
from tidegauge.sources import (
    arrived_after,
    decode,
    definition_table,
    device_table,
    read_revisions,
    read_with_compacted,
    reject_reason,
    rule_table,
    stream_revisions,
    to_telemetry,
)
from tidegauge.streaming import (
    await_all,
    combined_stream,
    compact_revisions,
    definition_stream,
    land_telemetry,
    latest_reading_query,
    publish,
    read_landed,
    retire_batches,
    retire_versions,
    start_combined,
    start_metrics,
)

Query = Callable[[SparkSession, str], DataFrame]

EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string"
)
PAIR = ("view", "click")
MINIMUM = 20.0
AS_OF = "2024-02-01 00:00:00"
MIDDLE = "2024-01-15 12:00:00"
HOUR = 3600

FINE_TEMPERATURE = TEMPERATURE.widened(devices=PAIR, decimals=2)
FINE_PRODUCTION = PRODUCTION.widened(devices=("purchase",), decimals=2)
FINE_COMPLIANCE = COMPLIANCE.widened(devices=PAIR, decimals=2)
FINE_VIBRATION = VIBRATION.widened(devices=("error",), decimals=2)
FINE = (FINE_TEMPERATURE, FINE_PRODUCTION, FINE_COMPLIANCE, FINE_VIBRATION)

WIDE_TEMPERATURE = FINE_TEMPERATURE.widened(
    name="temp_wide", size_s=HOUR, slide_s=HOUR // 2, delay_s=2 * HOUR
)
WIDE_PRODUCTION = FINE_PRODUCTION.widened(name="production_wide", delay_s=2 * HOUR)
WIDE_COMPLIANCE = FINE_COMPLIANCE.widened(
    name="compliance_wide", size_s=HOUR, slide_s=HOUR, delay_s=HOUR
)
WIDE_VIBRATION = FINE_VIBRATION.widened(
    name="vibration_wide", size_s=2 * HOUR, slide_s=HOUR // 2, delay_s=HOUR // 2
)
WIDE = (WIDE_TEMPERATURE, WIDE_PRODUCTION, WIDE_COMPLIANCE, WIDE_VIBRATION)

EVENT_RULES = (
    ("temp_wide", "minimum", 15.0, 5),
    ("compliance_wide", "minimum", MINIMUM, 2),
    ("vibration_wide", "trailing ratio", 1.5, 10),
)

# Limits by the 5 % and 95 % quantiles; `heartbeat` never reports.
EVENT_DEVICES = (
    ("view", "browse", "BROWSE", 1, "ct", 2.5, 150.0),
    ("click", "browse", "BROWSE", 1, "ct", 2.5, 150.0),
    ("signup", "join", "JOIN", 2, "ct", 2.5, 150.0),
    ("purchase", "sales", "SALES", 3, "ct", 2.5, 150.0),
    ("error", "fault", "FAULT", 4, "ct", 2.5, 150.0),
    ("heartbeat", "silent", "SILENT", 5, "ct", 2.5, 150.0),
)


# --- Inputs --------------------------------------------------------------------


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return utc(spark).read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    site = F.col("user_id").cast("string").alias("site")
    return to_telemetry(events(spark, sf_dir), "event_type", "value", "ts", "event_id", site)


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry with an arrival time.

    The counter holds what it reads from minute 45 on and flushes it at half past
    the next hour; the first of the pair runs 45 seconds behind in the second half
    of each hour. Everything else arrives when it happens.
    """
    ts = F.col("event_time")
    flush = F.window("event_time", "1 hour")["start"] + F.expr("interval 90 minutes")
    held = (F.col("device_id") == "purchase") & (F.minute(ts) >= 45)
    stale = (F.col("device_id") == "view") & (F.minute(ts) >= 30)
    return telemetry(spark, sf_dir).withColumn(
        "arrival_time",
        F.when(held, flush).when(stale, ts + F.expr("interval 45 seconds")).otherwise(ts),
    )


def devices(spark: SparkSession) -> DataFrame:
    return device_table(utc(spark), EVENT_DEVICES)


def moment(text: str):
    return F.lit(text).cast("timestamp_ntz")


def windows(spark: SparkSession, sf_dir: str, metric: MetricDef) -> DataFrame:
    return op.with_mean(op.metric_totals(telemetry(spark, sf_dir), metric))


def revisions(
    spark: SparkSession, sf_dir: str, metrics: Sequence[MetricDef] = WIDE, batch_s: int = 600
) -> DataFrame:
    """The revision table that ten-minute batches would have written."""
    log = op.revisions_by_definition(
        arrivals(spark, sf_dir),
        definition_table(utc(spark), metrics),
        common_pane(metrics),
        batch_s,
        decimals=2,
    )
    return log.select(
        "metric",
        F.lit(None).cast("string").alias("site"),
        "window_start",
        "window_end",
        "value_sum",
        "value_count",
        F.lit(1).cast("long").alias("run_id"),
        F.floor(fn.micros(F.col("batch_start")) / (batch_s * 1_000_000)).alias("batch_id"),
    )


# --- Windows -------------------------------------------------------------------


def sliding(devices_: Sequence[str], size_s: int, slide_s: int, mean: bool = False) -> Query:
    def run(spark, sf_dir):
        rows = telemetry(spark, sf_dir).filter(F.col("device_id").isin(*devices_))
        totals = op.window_totals(rows, size_s, slide_s, decimals=2)
        if not mean:
            return totals
        return op.with_mean(totals).select("window_start", "window_end", "mean")

    return run


def derived_tumbling(spark, sf_dir):
    totals = op.metric_totals(telemetry(spark, sf_dir), FINE_TEMPERATURE)
    return op.with_mean(op.tumbling_from_sliding(totals, FINE_TEMPERATURE.size_s)).select(
        "window_start", "window_end", "mean"
    )


def hourly_total(spark, sf_dir):
    return windows(spark, sf_dir, WIDE_PRODUCTION).select("window_start", "value_sum")


def by_site(spark, sf_dir):
    return op.window_totals(telemetry(spark, sf_dir), HOUR, HOUR // 2, ["site"], decimals=2)


def defined_metrics(spark, sf_dir):
    metrics = FINE + WIDE
    return op.metrics_by_definition(
        telemetry(spark, sf_dir),
        definition_table(utc(spark), metrics),
        common_pane(metrics),
        decimals=2,
    )


def final_windows(spark, sf_dir):
    marked = op.mark_final(
        windows(spark, sf_dir, WIDE_TEMPERATURE), moment(MIDDLE), WIDE_TEMPERATURE.delay_s
    )
    return marked.select("window_start", "window_end", "mean", "is_final")


def published(spark, sf_dir):
    """Messages written as JSON by the executors and read back from the sink."""
    totals = op.metric_totals(telemetry(spark, sf_dir), FINE_TEMPERATURE)
    (path,) = _folders(spark, "messages")
    publish(encode(totals, FINE_TEMPERATURE, moment(AS_OF)), "text", path, mode="overwrite")
    fields = (
        "metric string, window_start string, window_end string, temp_sum double, "
        "temp_count bigint, computed_at string"
    )
    sent = utc(spark).read.text(path)
    return sent.select(F.from_json("value", fields).alias("m")).select("m.*")


def messages(metric: MetricDef) -> Query:
    def run(spark, sf_dir):
        totals = op.metric_totals(telemetry(spark, sf_dir), metric)
        return encode(totals, metric, moment(AS_OF))

    return run


def all_messages(spark, sf_dir):
    return metric_topic(messages(m)(spark, sf_dir) for m in FINE)


# --- Sources and scalar functions ----------------------------------------------


def json_decode(spark, sf_dir):
    parsed = F.from_json("props", "k int")
    return events(spark, sf_dir).select("event_id", parsed["k"].alias("k"))


def _envelope(device, value, timestamp):
    fields = F.struct(
        device.alias("device_id"), value.alias("value"), timestamp.alias("timestamp")
    )
    return F.to_json(fields).cast("binary").alias("payload")


def envelope_roundtrip(spark, sf_dir):
    stamp = fn.iso(F.col("ts"), offset=True)
    sent = events(spark, sf_dir).select(
        "event_id", _envelope(F.col("event_type"), F.col("value"), stamp)
    )
    return decode(sent, "payload", keep=("event_id",)).select(
        "event_id", "device_id", "value", F.col("event_time").cast("timestamp_ntz")
    )


def faulty_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signups send a foreign payload, errors an unreadable time, dear clicks no
    device and cheap views no value."""
    kind, value = F.col("event_type"), F.col("value")
    payload = F.when(kind == "signup", F.col("props").cast("binary")).otherwise(
        _envelope(
            F.when(~((kind == "click") & (value > 100)), kind),
            F.when(~((kind == "view") & (value < 5)), value),
            F.when(kind == "error", "yesterday").otherwise(fn.iso(F.col("ts"))),
        )
    )
    return events(spark, sf_dir).select("event_id", "ts", payload.alias("payload"))


def reject_split(spark, sf_dir):
    sent = faulty_payloads(spark, sf_dir)
    return reject_reason(decode(sent, "payload", keep=("event_id",))).select(
        "event_id", F.coalesce("reject_reason", F.lit("usable")).alias("quality")
    )


def time_texts(spark, sf_dir):
    ts = F.col("ts")
    text = fn.iso(ts)
    return events(spark, sf_dir).select(
        "event_id",
        text.alias("iso"),
        fn.iso(ts, offset=True).alias("iso_offset"),
        fn.clock(ts).alias("clock"),
        fn.parse_iso(text).cast("timestamp_ntz").alias("parsed"),
        F.round(fn.seconds_between(ts, moment(AS_OF)), 6).alias("age_s"),
        fn.round_half_even(F.col("value"), 1).alias("value_1"),
        F.col("value").cast("long").alias("value_0"),
    )


# --- Latest, status, rules -----------------------------------------------------


def latest_readings(spark, sf_dir):
    return op.latest_per_device(telemetry(spark, sf_dir).drop("site"), "event_id")


def sensor_status(spark, sf_dir):
    return op.sensor_status(telemetry(spark, sf_dir), devices(spark)).select(
        "event_id", "device_id", "value", "status"
    )


def roster_status(spark, sf_dir):
    return op.roster_status(latest_readings(spark, sf_dir), devices(spark)).select(
        "device_id", "unit", "value", fn.severity_name(F.col("severity")).alias("status")
    )


def stage_status(spark, sf_dir):
    return op.stage_status(latest_readings(spark, sf_dir), devices(spark))


def violations(spark, sf_dir):
    rows = op.violations(windows(spark, sf_dir, WIDE_COMPLIANCE), MINIMUM)
    return rows.select("window_start", "window_end", "mean").orderBy(F.desc("window_start"))


def top_violations(spark, sf_dir):
    rows = op.violations(windows(spark, sf_dir, WIDE_COMPLIANCE), MINIMUM)
    top = rows.orderBy(F.desc("window_start")).limit(5)
    return top.select("window_start", fn.round_half_even(F.col("mean")).alias("mean"))


def compliance_daily(spark, sf_dir):
    return op.compliance_by_day(windows(spark, sf_dir, WIDE_COMPLIANCE), MINIMUM)


def compliance_overall(spark, sf_dir):
    return op.compliance_total(windows(spark, sf_dir, WIDE_COMPLIANCE), MINIMUM)


def _judged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Means of the metrics that have a minimum, and the rules; windows of other metrics
    are not built."""
    rules = rule_table(utc(spark), EVENT_RULES)
    ruled = rules.filter(F.col("rule") == "minimum").select("metric")
    wanted = definition_table(utc(spark), WIDE).join(ruled, "metric", "left_semi")
    metrics = op.metrics_by_definition(
        telemetry(spark, sf_dir), wanted, common_pane(WIDE), decimals=2
    )
    return op.with_mean(metrics), rules


def violations_by_rule(spark, sf_dir):
    return op.violations_by_rule(*_judged(spark, sf_dir)).select(
        "metric", "window_start", "mean", "threshold"
    )


def compliance_by_rule(spark, sf_dir):
    return op.compliance_by_rule(*_judged(spark, sf_dir))


def relative_alert(spark, sf_dir):
    return op.alert_history(windows(spark, sf_dir, WIDE_VIBRATION)).select(
        "window_start", "mean", F.round("baseline", 6).alias("baseline"), "status"
    )


def relative_alert_now(spark, sf_dir):
    return op.alert_now(windows(spark, sf_dir, WIDE_VIBRATION))


def temperature_alarm(spark, sf_dir):
    return op.below_minimum(windows(spark, sf_dir, WIDE_TEMPERATURE), MINIMUM)


def current_hour(spark, sf_dir):
    now = op.current_window(windows(spark, sf_dir, WIDE_PRODUCTION), "value_sum")
    return now.select("window_start", F.col("value_sum").cast("long").alias("total"))


def last_hours(spark, sf_dir):
    rows = op.last_windows(windows(spark, sf_dir, WIDE_PRODUCTION), 8)
    return rows.select(fn.clock(F.col("window_start")).alias("hour"), "value_sum")


def last_vibrations(spark, sf_dir):
    rows = op.last_windows(windows(spark, sf_dir, WIDE_VIBRATION), 20)
    return rows.select("window_end", "mean")


# --- Views ---------------------------------------------------------------------


def metric_series(metric: MetricDef) -> Query:
    def run(spark, sf_dir):
        rows = op.series(revisions(spark, sf_dir, [metric]), metric.name)
        return rows.select("window_start", "value_sum", "value_count", "mean")

    return run


def series_overlay(spark, sf_dir):
    raw = telemetry(spark, sf_dir).filter(F.col("device_id").isin(*PAIR))
    return op.overlay(raw, windows(spark, sf_dir, WIDE_COMPLIANCE), label="1-hour mean")


def recent_readings(spark, sf_dir):
    return op.recent(
        telemetry(spark, sf_dir).drop("site"), "event_time", moment(MIDDLE), 24 * HOUR, 2 * HOUR
    )


def telemetry_tail(spark, sf_dir):
    return op.tail(telemetry(spark, sf_dir).drop("site"), ["event_id"], "device_id", TAIL_ROWS, PAIR)


def metric_tail(spark, sf_dir):
    rows = op.tail(
        revisions(spark, sf_dir), ["batch_id", "metric", "window_start"], "metric", TAIL_ROWS
    )
    return rows.select("metric", "window_start", "batch_id", "value_sum", "value_count")


def rolling_buffer(spark, sf_dir):
    return op.newest(telemetry(spark, sf_dir).drop("site"), ["event_id"], BUFFER_ROWS)


def device_options(spark, sf_dir):
    return op.options(telemetry(spark, sf_dir), "device_id")


def data_lag(spark, sf_dir):
    return op.data_lag(telemetry(spark, sf_dir), "event_id", moment(AS_OF))


# --- Late data -----------------------------------------------------------------


def revision_log(spark, sf_dir):
    own = arrivals(spark, sf_dir).filter(F.col("device_id") == "purchase")
    return op.revision_log(own, HOUR, 600, decimals=2)


def latest_revision(spark, sf_dir):
    log = revision_log(spark, sf_dir)
    last = op.latest_revision(log, ("window_start", "window_end"), ("batch_start",))
    return last.select("window_start", "value_sum", "value_count")


def lateness(spark, sf_dir):
    profile = op.lateness_profile(arrivals(spark, sf_dir))
    quantiles = ("p50_s", "p95_s", "p99_s")
    return profile.withColumns({q: F.round(q, 6) for q in quantiles})


def silent_devices(spark, sf_dir):
    latest = latest_readings(spark, sf_dir)
    return op.silent_devices(latest, devices(spark), 2 * HOUR, moment("2024-01-31 00:00:00"))


def sensor_gaps(spark, sf_dir):
    gaps = op.sensor_gaps(telemetry(spark, sf_dir), 1200, moment(AS_OF))
    return gaps.withColumn("gap_s", F.round("gap_s", 6))


def stuck(spark, sf_dir):
    return op.stuck_readings(telemetry(spark, sf_dir), 2, tie=("event_id",)).select(
        "event_id", "device_id", "value"
    )


def outliers(spark, sf_dir):
    return op.out_of_limits(telemetry(spark, sf_dir), devices(spark), 0.5).select(
        "event_id", "device_id", "value"
    )


def deduplicated(spark, sf_dir):
    """Errors are sent twice and the second copy is suppressed."""
    once = telemetry(spark, sf_dir).drop("event_id", "site")
    sent = once.unionByName(once.filter(F.col("device_id") == "error"))
    return op.suppress_duplicates(sent)


# --- Streams -------------------------------------------------------------------

#: Parts of the streaming state of these queries: a few, as their windows are few.
STATE_PARTS = 4
ONE_CUT = ("2024-01-12 00:00:00",)
# Just before the counter flushes what it held since quarter to the hour.
BEFORE_FLUSH = ("2024-01-05 10:29:00", "2024-01-15 01:29:00", "2024-01-24 00:29:00")


def _folders(spark: SparkSession, *purposes: str) -> list[str]:
    return [shared_folder(spark, p) for p in purposes]


def _instants(df: DataFrame) -> DataFrame:
    """Watermarks need instants, not local times."""
    times = [c for c, t in df.dtypes if t == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in times})


def _local(df: DataFrame) -> DataFrame:
    times = [c for c, t in df.dtypes if t == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})


def _latest_view(spark: SparkSession, table: str) -> DataFrame:
    return _local(op.latest_revision(read_revisions(utc(spark), table)))


def _streamed(
    spark: SparkSession,
    sf_dir: str,
    metrics: Sequence[MetricDef],
    cuts: Sequence[str],
    keys: Sequence[str] = (),
) -> DataFrame:
    """Latest view of a revision table that streaming queries wrote."""
    return _latest_view(spark, _streamed_table(spark, sf_dir, metrics, cuts, keys))


def _wanted(spark: SparkSession, sf_dir: str, metrics: Sequence[MetricDef], *keys: str) -> DataFrame:
    """Arrivals of the metrics' devices, with the columns their streams read."""
    names = sorted({d for m in metrics for d in m.devices})
    rows = arrivals(stream_session(spark, STATE_PARTS), sf_dir)
    rows = rows.filter(F.col("device_id").isin(*names))
    return _instants(rows.select("device_id", "value", "event_time", "arrival_time", *keys))


def _streamed_table(
    spark: SparkSession,
    sf_dir: str,
    metrics: Sequence[MetricDef],
    cuts: Sequence[str],
    keys: Sequence[str] = (),
) -> str:
    table, checkpoints, landing = _folders(spark, "revisions", "checkpoints", "landing")

    def start(stream: DataFrame):
        return start_metrics(stream, table, checkpoints, metrics, keys=keys, available_now=True)

    stored = _wanted(spark, sf_dir, metrics, *keys)
    replay(stored, "arrival_time", cuts, landing, start, [checkpoints])
    return table


def stream_latest(metric: MetricDef) -> Query:
    def run(spark, sf_dir):
        return _streamed(spark, sf_dir, [metric], ONE_CUT).select(
            "window_start", "window_end", "value_sum", "value_count"
        )

    return run


def stream_metrics(spark, sf_dir):
    """All metrics side by side, each with a delay of its own."""
    return _streamed(spark, sf_dir, WIDE, ONE_CUT).select(
        "metric", "window_start", "value_sum", "value_count"
    )


def stream_violations(spark, sf_dir):
    view = op.with_mean(_streamed(spark, sf_dir, [WIDE_COMPLIANCE], ONE_CUT))
    return op.violations(view, MINIMUM).select("window_start", "mean")


def stream_convergence(spark, sf_dir):
    """Windows that lost late readings, as the delay is too short for the flushes."""
    hasty = WIDE_PRODUCTION.widened(name="production_hasty", delay_s=120)
    streamed = _streamed(spark, sf_dir, [hasty], BEFORE_FLUSH)
    whole = op.metric_totals(telemetry(spark, sf_dir), hasty)
    return op.convergence(streamed, whole, ("metric", "window_start", "window_end"))


def stream_by_site(spark, sf_dir):
    """The metric per site, with the user in the role of the site."""
    return _streamed(spark, sf_dir, [WIDE_COMPLIANCE], ONE_CUT, ["site"]).select(
        "site", "window_start", "value_sum", "value_count"
    )


def stream_definitions(spark, sf_dir):
    """The same metrics from rows of a definition table, in one query."""
    table, checkpoint, landing = _folders(spark, "revisions", "checkpoint", "landing")
    stored = _wanted(spark, sf_dir, WIDE)
    shapes = [(m.size_s, m.slide_s) for m in WIDE]

    def start(stream: DataFrame):
        definitions = definition_table(stream.sparkSession, WIDE)
        metrics = definition_stream(stream, definitions, shapes, 2 * HOUR, decimals=2)
        return [start_combined(metrics, table, checkpoint, available_now=True)]

    replay(stored, "arrival_time", ONE_CUT, landing, start, [checkpoint, f"{checkpoint}-run"])
    return _latest_view(spark, table).select(
        "metric", "window_start", "value_sum", "value_count"
    )


def stream_latest_readings(spark, sf_dir):
    path, checkpoint, landing = _folders(spark, "latest", "checkpoint", "landing")
    stored = _instants(arrivals(stream_session(spark, STATE_PARTS), sf_dir).drop("site"))

    def start(stream: DataFrame):
        rows = stream.select("device_id", "value", "event_time", "event_id")
        return [latest_reading_query(rows, "event_id", path, checkpoint, available_now=True)]

    replay(stored, "arrival_time", ONE_CUT, landing, start, [checkpoint])
    rows = op.latest_revision(utc(spark).read.parquet(path), ("device_id",), ("batch_id",))
    return _local(rows).select("device_id", "value", "event_time", "event_id")


def stream_deduplicated(spark, sf_dir):
    """Errors are sent twice; the copies are suppressed within the watermark."""
    path, checkpoint, landing = _folders(spark, "readings", "checkpoint", "landing")
    once = _instants(arrivals(stream_session(spark, STATE_PARTS), sf_dir).drop("site", "event_id"))
    sent = once.unionByName(once.filter(F.col("device_id") == "error"))

    def start(stream: DataFrame):
        rows = stream.select("device_id", "value", "event_time")
        single = op.suppress_duplicates(rows, delay_s=2 * HOUR)
        return [
            single.writeStream.format("parquet")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        ]

    replay(sent, "arrival_time", ONE_CUT, landing, start, [checkpoint])
    return _local(utc(spark).read.parquet(path))


def stream_landed(spark, sf_dir):
    """Payloads decoded once and landed; the usable ones."""
    path, checkpoint, landing = _folders(spark, "telemetry", "checkpoint", "landing")
    live = stream_session(spark, STATE_PARTS)
    sent = faulty_payloads(live, sf_dir).withColumn("arrival_time", F.col("ts").cast("timestamp"))

    def start(stream: DataFrame):
        decoded = decode(stream.select("payload"), "payload")
        return [land_telemetry(decoded, path, checkpoint, available_now=True)]

    replay(sent.drop("ts"), "arrival_time", ONE_CUT, landing, start, [checkpoint])
    landed = read_landed(utc(spark), path).select("device_id", "value", "event_time")
    return _local(landed)


def compacted_latest(spark, sf_dir):
    """A streamed table that was compacted in two steps and relieved of what that replaced."""
    live = utc(spark)
    table = _streamed_table(spark, sf_dir, [WIDE_TEMPERATURE], ONE_CUT)
    (compacted,) = _folders(spark, "compacted")
    name = WIDE_TEMPERATURE.name
    for batch in (0, 1):
        compact_revisions(live, table, compacted, name, 1, batch)
        retire_batches(live, table, name, 1, batch)
        retire_versions(live, compacted, name)
    view = _local(op.latest_revision(read_with_compacted(live, table, compacted)))
    return view.select("window_start", "window_end", "value_sum", "value_count")


def revision_stream(spark, sf_dir):
    """The revision table read incrementally by another stream, which keeps its latest view."""
    live = stream_session(spark, STATE_PARTS)
    table = _streamed_table(spark, sf_dir, [WIDE_PRODUCTION], ONE_CUT)
    path, checkpoint = _folders(spark, "revision-copy", "checkpoint")
    copy = (
        stream_revisions(live, table)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    await_all([copy])
    remove(live, checkpoint)
    view = _local(op.latest_revision(utc(spark).read.parquet(path).drop("window_date")))
    return view.select("window_start", "window_end", "value_sum", "value_count")


def combined_metrics(spark, sf_dir):
    """Two metrics in one query; the slower one's watermark rules."""
    table, checkpoint, landing = _folders(spark, "revisions", "checkpoint", "landing")
    metrics = (WIDE_TEMPERATURE, WIDE_PRODUCTION)

    def start(stream: DataFrame):
        return [start_combined(combined_stream(stream, metrics), table, checkpoint, available_now=True)]

    stored = _wanted(spark, sf_dir, metrics)
    replay(stored, "arrival_time", ONE_CUT, landing, start, [checkpoint, f"{checkpoint}-run"])
    return _latest_view(spark, table).select("metric", "window_start", "value_sum", "value_count")


def arrived_later(spark, sf_dir):
    """Readings that a reader which starts at the middle of the month would get."""
    rows = arrivals(spark, sf_dir).drop("site")
    return arrived_after(rows, "arrival_time", moment(MIDDLE)).select("event_id", "device_id", "value")


def metric_options(spark, sf_dir):
    return op.options(revisions(spark, sf_dir), "metric")


def _by_site(spark, sf_dir, metric: MetricDef):
    return op.with_mean(op.metric_totals(telemetry(spark, sf_dir), metric, ["site"]))


def alert_by_site(spark, sf_dir):
    return op.alert_now(_by_site(spark, sf_dir, WIDE_VIBRATION), keys=["site"])


def last_windows_by_site(spark, sf_dir):
    rows = op.last_windows(_by_site(spark, sf_dir, WIDE_PRODUCTION), 8, ["site"])
    return rows.select("site", "window_start", "value_sum")


def current_hour_by_site(spark, sf_dir):
    now = op.current_window(_by_site(spark, sf_dir, WIDE_PRODUCTION), "value_sum", ["site"])
    return now.select("site", "window_start", F.col("value_sum").cast("long").alias("total"))


def compliance_by_site(spark, sf_dir):
    return op.compliance_total(_by_site(spark, sf_dir, WIDE_COMPLIANCE), MINIMUM, keys=["site"])


QUERIES: dict[str, Query] = {
    "sliding_sum_count_1h_30m": sliding(PAIR, HOUR, HOUR // 2),
    "sliding_sum_count_1m_30s": sliding(PAIR, 60, 30),
    "sliding_mean_2m_30s": sliding(("error",), 120, 30, mean=True),
    "sliding_mean_2h_30m": sliding(("error",), 2 * HOUR, HOUR // 2, mean=True),
    "tumbling_mean_1m": sliding(PAIR, 60, 60, mean=True),
    "tumbling_mean_1h": sliding(PAIR, HOUR, HOUR, mean=True),
    "tumbling_mean_1m_derived": derived_tumbling,
    "hourly_total": hourly_total,
    "sliding_by_site_1h_30m": by_site,
    "metric_defs_multi": defined_metrics,
    "final_windows": final_windows,
    "message_temp_window": messages(FINE_TEMPERATURE),
    "message_production_hourly": messages(FINE_PRODUCTION),
    "message_compliance_window": messages(FINE_COMPLIANCE),
    "message_vibration_window": messages(FINE_VIBRATION),
    "metric_topic": all_messages,
    "published_messages": published,
    "json_decode": json_decode,
    "envelope_roundtrip": envelope_roundtrip,
    "reject_split": reject_split,
    "time_texts": time_texts,
    "latest_per_device": latest_readings,
    "sensor_status": sensor_status,
    "roster_status": roster_status,
    "stage_status": stage_status,
    "violations": violations,
    "top5_violations": top_violations,
    "compliance_daily": compliance_daily,
    "compliance_total": compliance_overall,
    "violations_by_rule": violations_by_rule,
    "compliance_by_rule": compliance_by_rule,
    "relative_alert": relative_alert,
    "relative_alert_now": relative_alert_now,
    "temperature_alarm": temperature_alarm,
    "current_hour": current_hour,
    "last_8_hours": last_hours,
    "last_20_windows": last_vibrations,
    "temperature_series": metric_series(WIDE_TEMPERATURE),
    "production_series": metric_series(WIDE_PRODUCTION),
    "vibration_series": metric_series(WIDE_VIBRATION),
    "series_overlay": series_overlay,
    "recent_readings": recent_readings,
    "tail_filtered": telemetry_tail,
    "metric_tail": metric_tail,
    "rolling_buffer": rolling_buffer,
    "option_list": device_options,
    "data_lag": data_lag,
    "revision_log": revision_log,
    "latest_revision": latest_revision,
    "lateness_profile": lateness,
    "sensor_gaps": sensor_gaps,
    "silent_devices": silent_devices,
    "stuck_readings": stuck,
    "out_of_limits": outliers,
    "dedup_events": deduplicated,
    "stream_sliding_latest": stream_latest(WIDE_TEMPERATURE),
    "stream_hourly_latest": stream_latest(WIDE_PRODUCTION),
    "stream_vibration_latest": stream_latest(WIDE_VIBRATION),
    "stream_metrics_latest": stream_metrics,
    "stream_by_site": stream_by_site,
    "stream_definitions": stream_definitions,
    "stream_violations": stream_violations,
    "stream_latest_per_device": stream_latest_readings,
    "stream_dedup": stream_deduplicated,
    "stream_landed": stream_landed,
    "convergence_diff": stream_convergence,
    "compacted_latest": compacted_latest,
    "stream_revisions": revision_stream,
    "stream_combined": combined_metrics,
    "arrived_after": arrived_later,
    "metric_options": metric_options,
    "alert_by_site": alert_by_site,
    "last_windows_by_site": last_windows_by_site,
    "current_hour_by_site": current_hour_by_site,
    "compliance_by_site": compliance_by_site,
}
