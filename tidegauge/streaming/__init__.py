from tidegauge.streaming.definitions import (
    combined_stream,
    definition_stream,
    start_combined,
)
from tidegauge.streaming.landing import land_telemetry, read_landed
from tidegauge.streaming.late import missing_numbers, read_routed, routed, start_routed
from tidegauge.streaming.runner import (
    await_all,
    latest_reading_query,
    metric_stream,
    run_until_any_ends,
    start_metric,
    start_metrics,
    ProgressLog,
    recent_progress,
    watermark_report,
)
from tidegauge.streaming.sinks import (
    compact_revisions,
    publish,
    retire_batches,
    retire_versions,
    revision_writer,
    run_identity,
)
from tidegauge.streaming.sketches import read_sketches, start_sketches
from tidegauge.streaming.timers import gaps_of, silence_events

__all__ = [
    "await_all",
    "combined_stream",
    "compact_revisions",
    "definition_stream",
    "gaps_of",
    "land_telemetry",
    "latest_reading_query",
    "metric_stream",
    "missing_numbers",
    "publish",
    "read_landed",
    "read_routed",
    "read_sketches",
    "revision_writer",
    "routed",
    "run_identity",
    "run_until_any_ends",
    "silence_events",
    "start_combined",
    "start_metric",
    "start_metrics",
    "start_routed",
    "start_sketches",
    "ProgressLog",
    "recent_progress",
    "retire_batches",
    "retire_versions",
    "watermark_report",
]
