from tidegauge.operators.cubes import grouped_totals, multiset_difference, rollup_sets
from tidegauge.operators.latest import latest_per_device, latest_revision, newest
from tidegauge.operators.quality import (
    lateness_profile,
    out_of_limits,
    sensor_gaps,
    silent_devices,
    stuck_readings,
    suppress_duplicates,
)
from tidegauge.operators.ranges import time_frames, time_totals
from tidegauge.operators.ranks import global_ranks
from tidegauge.operators.revisions import (
    accumulate,
    arrival_batch,
    convergence,
    mark_final,
    revision_log,
    revisions_by_definition,
)
from tidegauge.operators.rules import (
    alert_history,
    alert_now,
    below_minimum,
    compliance_by_day,
    compliance_by_rule,
    compliance_total,
    current_window,
    roster_status,
    sensor_status,
    stage_status,
    violations,
    violations_by_rule,
)
from tidegauge.operators.sessions import session_totals
from tidegauge.operators.sketches import (
    distinct_error,
    merged_sketches,
    rank_error,
    sketch_panes,
    sketch_values,
)
from tidegauge.operators.temporal_joins import as_of, near_in_time, near_pairs, within_spans
from tidegauge.operators.trailing import neighbour_frames, trailing
from tidegauge.operators.views import (
    data_lag,
    last_windows,
    options,
    overlay,
    recent,
    series,
    tail,
)
from tidegauge.operators.windows import (
    metrics_by_definition,
    metric_totals,
    panes,
    tumbling_from_sliding,
    window_totals,
    with_mean,
)

__all__ = [
    "accumulate",
    "alert_history",
    "alert_now",
    "arrival_batch",
    "as_of",
    "below_minimum",
    "compliance_by_day",
    "compliance_by_rule",
    "compliance_total",
    "convergence",
    "current_window",
    "data_lag",
    "distinct_error",
    "global_ranks",
    "grouped_totals",
    "last_windows",
    "lateness_profile",
    "latest_per_device",
    "latest_revision",
    "mark_final",
    "merged_sketches",
    "metric_totals",
    "metrics_by_definition",
    "multiset_difference",
    "near_in_time",
    "near_pairs",
    "neighbour_frames",
    "newest",
    "options",
    "out_of_limits",
    "overlay",
    "panes",
    "rank_error",
    "recent",
    "revision_log",
    "revisions_by_definition",
    "rollup_sets",
    "roster_status",
    "sensor_gaps",
    "sensor_status",
    "series",
    "session_totals",
    "silent_devices",
    "sketch_panes",
    "sketch_values",
    "stage_status",
    "stuck_readings",
    "suppress_duplicates",
    "tail",
    "time_frames",
    "time_totals",
    "trailing",
    "tumbling_from_sliding",
    "violations",
    "violations_by_rule",
    "window_totals",
    "with_mean",
    "within_spans",
]
