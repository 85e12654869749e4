from tidegauge.sources.dimensions import definition_table, device_table, rule_table
from tidegauge.sources.revisions import (
    read_compacted,
    read_revisions,
    read_with_compacted,
    stream_revisions,
)
from tidegauge.sources.telemetry import (
    arrived_after,
    decode,
    read_stream,
    read_table,
    reject_reason,
    split_rejects,
    to_telemetry,
)

__all__ = [
    "arrived_after",
    "decode",
    "definition_table",
    "device_table",
    "read_revisions",
    "read_stream",
    "read_table",
    "read_compacted",
    "read_with_compacted",
    "reject_reason",
    "rule_table",
    "split_rejects",
    "stream_revisions",
    "to_telemetry",
]
