"""Physical plans: what is scanned, pruned, shuffled and broadcast."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from tidegauge import operators as op
from tidegauge.model import METRICS, TEMPERATURE
from tidegauge.operators.trailing import neighbour_frames
from tidegauge.operators.windows import common_pane
from tidegauge.plans import events
from tidegauge.sources import definition_table, device_table, read_revisions
from tidegauge.streaming import read_landed

SF_DIR = "/root/testdata/sf0.001"

# Queries of one scan that use more than a top-n.
ONE_SCAN = [
    n
    for n in events.QUERIES
    if not n.startswith(("stream", "convergence", "published", "compacted"))
    and n not in ("metric_topic", "series_overlay", "dedup_events")
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ONE_SCAN)
def test_each_query_reads_its_table_once(spark, name):
    text = plan(entry_points.queries()[name](spark, SF_DIR))
    assert len(re.findall(r"FileScan parquet", text)) == 1
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(entry_points.entry(spark))
    assert "PushedFilters: [IsNotNull(ts), In(event_type, [click,view])]" in text or re.search(
        r"PushedFilters: \[[^\]]*In\(event_type", text
    )
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in text


def test_recency_range_reaches_the_scan(spark):
    text = plan(events.recent_readings(spark, SF_DIR))
    assert "GreaterThanOrEqual(ts" in text and "LessThanOrEqual(ts" in text


def test_aggregation_is_partial_before_each_shuffle(spark):
    for name in ("sliding_sum_count_1h_30m", "sensor_gaps", "latest_per_device", "lateness_profile"):
        text = plan(entry_points.queries()[name](spark, SF_DIR))
        below = text.split("Exchange")[-1]
        assert "partial_" in below, name
        assert "SortAggregate" not in text, name


def test_sliding_windows_of_a_table_spread_panes_not_readings(spark):
    text = plan(entry_points.entry(spark))
    assert text.index("Expand") < text.rindex("Exchange")


def test_all_metrics_in_one_scan(spark):
    df = events.telemetry(spark, SF_DIR)
    text = plan(op.metrics_by_definition(df, definition_table(spark), common_pane(METRICS)))
    assert text.count("FileScan parquet") == 1


def test_dimension_is_broadcast_by_its_size_only(spark):
    readings = events.telemetry(spark, SF_DIR)
    small = plan(op.sensor_status(readings, events.devices(spark)))
    assert "BroadcastHashJoin" in small
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = plan(op.sensor_status(readings, events.devices(spark)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in large and "SortMergeJoin" in large


def test_tops_are_distributed(spark):
    for name in ("tail_filtered", "rolling_buffer", "top5_violations", "metric_tail"):
        assert "TakeOrderedAndProject" in plan(entry_points.queries()[name](spark, SF_DIR)), name


def test_metric_filter_prunes_directories(spark, tmp_path):
    spark.range(1).selectExpr(
        "'s' site", "now() window_start", "now() window_end", "1D value_sum", "1L value_count",
        "now() computed_at", "'temp_window' metric", "1L run_id", "0L batch_id",
        "date'2024-01-01' window_date",
    ).write.partitionBy("metric", "run_id", "batch_id", "window_date").parquet(f"{tmp_path}/t")
    text = plan(op.series(read_revisions(spark, f"{tmp_path}/t"), TEMPERATURE.name, "2024-01-01"))
    filters = text.split("PartitionFilters: [")[1].split("]")[0]
    assert "(metric" in filters and "(window_date" in filters


def test_latest_revision_is_aggregated_by_hash(spark):
    text = plan(op.latest_revision(events.revisions(spark, SF_DIR)))
    assert "SortAggregate" not in text
    assert "SortAggregate" not in plan(entry_points.queries()["temperature_series"](spark, SF_DIR))


def test_unlisted_devices_leave_before_the_first_shuffle(spark):
    listed = definition_table(spark, [events.WIDE_VIBRATION])
    metric = op.metrics_by_definition(events.telemetry(spark, SF_DIR), listed, 1800)
    text = plan(metric)
    below = text[text.rindex("Exchange hashpartitioning") :]
    assert "LeftSemi" in below and "partial_sum" in text[: text.rindex("LeftSemi")]


def test_quality_and_day_prune_directories(spark, tmp_path):
    spark.sql(
        "SELECT 'a' device_id, 1D value, now() event_time, '' payload, 'usable' quality, "
        "date'2024-01-01' event_date"
    ).write.partitionBy("quality", "event_date").parquet(f"{tmp_path}/t")
    text = plan(read_landed(spark, f"{tmp_path}/t", first_day="2024-01-01", last_day="2024-01-02"))
    filters = text.split("PartitionFilters: [")[1]
    assert "(quality" in filters and "(event_date" in filters


def test_devices_are_a_local_relation(spark):
    assert "LocalTableScan" in plan(device_table(spark))


def test_no_series_is_framed_by_its_key_alone(spark):
    windows = spark.range(100).select(
        (F.col("id") % 2).alias("metric"),
        F.timestamp_seconds("id").alias("window_start"),
        F.col("id").cast("double").alias("mean"),
    )
    text = plan(op.alert_history(windows, ["metric"]))
    assert len(re.findall(r"hashpartitioning\(metric#\d+L, (?:_level#\d+, )?_group", text)) == 2


def test_sparse_series_are_cut_at_every_level(spark):
    """At n = 10 and a reading every three minutes, no window group holds more of a series
    than twice nine rows for each shorter chunk in it."""
    df = spark.range(20_000).select(
        F.concat(F.lit("a"), F.col("id") % 1).alias("device_id"),
        F.timestamp_seconds(F.col("id") * 180).alias("event_time"),
        F.col("id").cast("double").alias("value"),
    )
    groups = neighbour_frames(
        df, ["device_id"], "event_time", 9, 0, {"rows": F.count(F.lit(1))},
        chunk_s=(60, 3600, 86_400, 30 * 86_400),
    )
    assert groups.filter("rows < 10").count() == 9  # only the first nine lack neighbours
    seen = [len(x) for x in _groups_seen(df, (60, 3600, 86_400, 30 * 86_400), 9)]
    assert seen == sorted(seen, reverse=True) and seen[-1] <= 2 * 9 * 2


def test_stuck_readings_shuffle_rows_once(spark):
    """All readings go by minute; what goes on to the key is few readings of each minute."""
    df = spark.range(30_000).select(
        F.lit("a").alias("device_id"),
        F.timestamp_millis(F.col("id") * 100).alias("event_time"),
        F.floor(F.col("id") / 40).cast("double").alias("value"),
    )
    found = op.stuck_readings(df, 41)
    keys = re.findall(r"hashpartitioning\((.*?), \d+\)", plan(found))
    assert len(keys) == 2 and "_group" in keys[0] and "_chunk" in keys[1]
    assert found.count() == 0
    # 50 minutes of 600 readings, in runs of 40: every minute begins and ends with a run.
    assert op.stuck_readings(df, 40).count() == 750


def _groups_seen(df, levels, reach):
    """The rows that reach each level, recomputed plainly."""
    times = [r[0] for r in df.select(F.unix_seconds("event_time")).orderBy("event_time").collect()]
    for size in levels:
        chunks = {}
        for t in times:
            chunks.setdefault(t // size, []).append(t)
        assert max(len(c) for c in chunks.values()) <= 2 * reach * 60
        times = [t for c in chunks.values() for k, t in enumerate(c) if k < reach or k >= len(c) - reach]
        yield times


