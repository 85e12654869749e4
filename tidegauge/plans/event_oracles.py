"""SQL that states the result of each query in `events`, for an independent engine."""

from __future__ import annotations

PAIR = "event_type IN ('view', 'click')"
COUNTER = "event_type = 'purchase'"
VIBRATION = "event_type = 'error'"
AS_OF = "TIMESTAMP '2024-02-01 00:00:00'"
MIDDLE = "TIMESTAMP '2024-01-15 12:00:00'"

# Values have two decimals, so their sums are exact as decimals.
SUM = "CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE)"

DEVICES = """(VALUES
  ('view', 'BROWSE', 1, 'ct', CAST(2.5 AS DOUBLE), CAST(150 AS DOUBLE)),
  ('click', 'BROWSE', 1, 'ct', CAST(2.5 AS DOUBLE), CAST(150 AS DOUBLE)),
  ('signup', 'JOIN', 2, 'ct', CAST(2.5 AS DOUBLE), CAST(150 AS DOUBLE)),
  ('purchase', 'SALES', 3, 'ct', CAST(2.5 AS DOUBLE), CAST(150 AS DOUBLE)),
  ('error', 'FAULT', 4, 'ct', CAST(2.5 AS DOUBLE), CAST(150 AS DOUBLE)),
  ('heartbeat', 'SILENT', 5, 'ct', CAST(2.5 AS DOUBLE), CAST(150 AS DOUBLE))
) AS d(device_id, display_stage, display_order, unit, lo, hi)"""

SEVERITY = """CASE WHEN value IS NULL THEN 0
  WHEN value < lo OR value > hi THEN 3
  WHEN value < lo + (hi - lo) * CAST(0.1 AS DOUBLE)
    OR value > hi - (hi - lo) * CAST(0.1 AS DOUBLE) THEN 2
  ELSE 1 END"""
STATUS = "['idle', 'ok', 'warning', 'alarm']"

ARRIVED = """(SELECT event_id, event_type, ts, value,
  CASE WHEN event_type = 'purchase' AND minute(ts) >= 45
       THEN date_trunc('hour', ts) + INTERVAL 90 MINUTE
       WHEN event_type = 'view' AND minute(ts) >= 30 THEN ts + INTERVAL 45 SECOND
       ELSE ts END AS arrival_time
FROM events)"""


def windows(where: str, size_s: int, slide_s: int, key: str = "") -> str:
    """Windows with sum, count and mean; each event is put into its windows one by one."""
    k = size_s // slide_s
    keys = f"{key}, " if key else ""
    return f"""(SELECT {keys}window_start,
  window_start + INTERVAL {size_s} SECOND AS window_end,
  {SUM} AS value_sum, count(value) AS value_count, {SUM} / count(value) AS mean
FROM (SELECT {keys}value,
        unnest([time_bucket(INTERVAL {slide_s} SECOND, ts) - i * INTERVAL {slide_s} SECOND
                FOR i IN range({k})]) AS window_start
      FROM events WHERE {where})
GROUP BY {keys}window_start)"""


TEMP_1M = windows(PAIR, 60, 30)
TEMP_1H = windows(PAIR, 3600, 1800)
TUMBLING_1M = windows(PAIR, 60, 60)
TUMBLING_1H = windows(PAIR, 3600, 3600)
HOURLY = windows(COUNTER, 3600, 3600)
VIB_2M = windows(VIBRATION, 120, 30)
VIB_2H = windows(VIBRATION, 7200, 1800)



def by_site(where: str, size_s: int, slide_s: int) -> str:
    rows = windows(where, size_s, slide_s, "user_id")
    return f"(SELECT * EXCLUDE user_id, CAST(user_id AS VARCHAR) AS site FROM {rows})"


BY_SITE_VIBRATION = by_site(VIBRATION, 7200, 1800)
BY_SITE_HOURLY = by_site(COUNTER, 3600, 3600)
BY_SITE_COMPLIANCE = by_site(PAIR, 3600, 3600)

TOTALS = "window_start, window_end, value_sum, value_count"
MEANS = "window_start, window_end, mean"


def revisions(metric: str, where: str, size_s: int, slide_s: int, batch_s: int = 600) -> str:
    """What was known of each window after each arrival batch."""
    k = size_s // slide_s
    return f"""(SELECT '{metric}' AS metric, window_start,
  window_start + INTERVAL {size_s} SECOND AS window_end, batch_start,
  CAST(epoch_us(batch_start) // {batch_s * 1_000_000} AS BIGINT) AS batch_id,
  CAST(row_number() OVER w AS INTEGER) AS revision,
  CAST(sum(part_sum) OVER w AS DOUBLE) AS value_sum,
  CAST(sum(part_count) OVER w AS BIGINT) AS value_count
FROM (SELECT window_start, batch_start, sum(CAST(value AS DECIMAL(18, 2))) AS part_sum,
        count(value) AS part_count
      FROM (SELECT value, time_bucket(INTERVAL {batch_s} SECOND, arrival_time) AS batch_start,
              unnest([time_bucket(INTERVAL {slide_s} SECOND, ts) - i * INTERVAL {slide_s} SECOND
                      FOR i IN range({k})]) AS window_start
            FROM {ARRIVED} WHERE {where})
      GROUP BY window_start, batch_start)
WINDOW w AS (PARTITION BY window_start ORDER BY batch_start))"""


ALL_REVISIONS = " UNION ALL ".join(
    f"SELECT * FROM {r}"
    for r in (
        revisions("temp_wide", PAIR, 3600, 1800),
        revisions("production_wide", COUNTER, 3600, 3600),
        revisions("compliance_wide", PAIR, 3600, 3600),
        revisions("vibration_wide", VIBRATION, 7200, 1800),
    )
)

BY_METRIC = {
    "temp_window": TEMP_1M,
    "production_hourly": HOURLY,
    "compliance_window": TUMBLING_1M,
    "vibration_window": VIB_2M,
    "temp_wide": TEMP_1H,
    "production_wide": HOURLY,
    "compliance_wide": TUMBLING_1H,
    "vibration_wide": VIB_2H,
}


def metrics(names: tuple[str, ...], columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS metric, {columns} FROM {BY_METRIC[n]}" for n in names
    )


def text(ts: str) -> str:
    return (
        f"strftime({ts}, '%Y-%m-%dT%H:%M:%S') || "
        f"CASE WHEN epoch_us({ts}) % 1000000 = 0 THEN '' ELSE strftime({ts}, '.%f') END"
    )


def message(metric: str, *fields: str) -> str:
    return (
        f"SELECT '{metric}' AS metric, {', '.join(fields)}, "
        f"'2024-02-01T00:00:00+00:00' AS computed_at FROM {BY_METRIC[metric]}"
    )


START = f"{text('window_start')} AS window_start"
END = f"{text('window_end')} AS window_end"

LATEST_READINGS = """(SELECT event_type AS device_id, value, ts AS event_time, event_id
FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) = 1)"""


def level(n: str) -> str:
    return f"CASE WHEN {n} = 0 THEN 'OK' WHEN {n} < 2 THEN 'WARNING' ELSE 'CRITICAL' END"


# Half-way cases go to the even neighbour; the mean is exact in decimals here or
# nowhere near half-way.
HALF_EVEN = "round_even({0}, 1)"

MESSAGES = {
    "message_temp_window": message(
        "temp_window", START, END, "value_sum AS temp_sum", "value_count AS temp_count"
    ),
    "message_production_hourly": message(
        "production_hourly", f"{text('window_start')} AS hour", "value_sum AS total_sausages"
    ),
    "message_compliance_window": message(
        "compliance_window", START, END, "mean AS mean_temp"
    ),
    "message_vibration_window": message(
        "vibration_window", START, END, "mean AS mean_vibration"
    ),
}

# A reading is dropped when its window ended before the watermark that earlier slices set.
CONVERGENCE = f"""
WITH a AS (
  SELECT ts, value, date_trunc('hour', ts) AS window_start,
    CAST(arrival_time >= TIMESTAMP '2024-01-05 10:29:00' AS INTEGER)
    + CAST(arrival_time >= TIMESTAMP '2024-01-15 01:29:00' AS INTEGER)
    + CAST(arrival_time >= TIMESTAMP '2024-01-24 00:29:00' AS INTEGER) AS slice
  FROM {ARRIVED} WHERE {COUNTER}),
clock AS (
  SELECT s.slice, max(a.ts) - INTERVAL 120 SECOND AS watermark
  FROM (SELECT DISTINCT slice FROM a) s LEFT JOIN a ON a.slice < s.slice GROUP BY s.slice),
kept AS (
  SELECT window_start, {SUM} AS value_sum, count(value) AS value_count
  FROM a JOIN clock USING (slice)
  WHERE watermark IS NULL OR window_start + INTERVAL 1 HOUR > watermark
  GROUP BY window_start),
whole AS (
  SELECT window_start, {SUM} AS value_sum, count(value) AS value_count
  FROM a GROUP BY window_start)
SELECT 'production_hasty' AS metric, window_start, window_start + INTERVAL 1 HOUR AS window_end,
  kept.value_sum AS stream_sum, kept.value_count AS stream_count,
  whole.value_sum AS batch_sum, whole.value_count AS batch_count
FROM whole FULL OUTER JOIN kept USING (window_start)
WHERE kept.value_count IS DISTINCT FROM whole.value_count
   OR kept.value_sum IS DISTINCT FROM whole.value_sum"""

ORACLES: dict[str, str] = {
    "sliding_sum_count_1h_30m": f"SELECT {TOTALS} FROM {TEMP_1H}",
    "sliding_sum_count_1m_30s": f"SELECT {TOTALS} FROM {TEMP_1M}",
    "sliding_mean_2m_30s": f"SELECT {MEANS} FROM {VIB_2M}",
    "sliding_mean_2h_30m": f"SELECT {MEANS} FROM {VIB_2H}",
    "tumbling_mean_1m": f"SELECT {MEANS} FROM {TUMBLING_1M}",
    "tumbling_mean_1h": f"SELECT {MEANS} FROM {TUMBLING_1H}",
    "tumbling_mean_1m_derived": f"SELECT {MEANS} FROM {TUMBLING_1M}",
    "hourly_total": f"""SELECT date_trunc('hour', ts) AS window_start, {SUM} AS value_sum
FROM events WHERE {COUNTER} GROUP BY 1""",
    "sliding_by_site_1h_30m": f"""SELECT CAST(user_id AS VARCHAR) AS site, {TOTALS}
FROM {windows('true', 3600, 1800, 'user_id')}""",
    "metric_defs_multi": metrics(tuple(BY_METRIC), TOTALS),
    "final_windows": f"""SELECT {MEANS},
  window_end + INTERVAL 7200 SECOND <= {MIDDLE} AS is_final FROM {TEMP_1H}""",
    **MESSAGES,
    "metric_topic": " UNION ALL BY NAME ".join(MESSAGES.values()),
    "published_messages": MESSAGES["message_temp_window"],
    "json_decode": "SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS k FROM events",
    "envelope_roundtrip": """SELECT event_id, event_type AS device_id, value, ts AS event_time
FROM events""",
    "reject_split": """SELECT event_id, CASE WHEN event_type = 'signup' THEN 'malformed'
  WHEN event_type = 'click' AND value > 100 THEN 'no device'
  WHEN event_type = 'error' THEN 'no event time'
  WHEN event_type = 'view' AND value < 5 THEN 'no value' ELSE 'usable' END AS quality
FROM events""",
    "time_texts": f"""SELECT event_id, {text('ts')} AS iso, {text('ts')} || '+00:00' AS iso_offset,
  strftime(ts, '%H:%M:%S') AS clock, ts AS parsed,
  round((epoch_us({AS_OF}) - epoch_us(ts)) / 1000000, 6) AS age_s,
  CAST(round_even(CAST(value AS DECIMAL(18, 2)), 1) AS DOUBLE) AS value_1,
  CAST(trunc(value) AS BIGINT) AS value_0
FROM events""",
    "latest_per_device": f"SELECT * FROM {LATEST_READINGS}",
    "sensor_status": f"""SELECT event_id, event_type AS device_id, value,
  coalesce({STATUS}[1 + CASE WHEN lo IS NULL THEN NULL ELSE {SEVERITY} END], 'unknown') AS status
FROM events LEFT JOIN {DEVICES} ON event_type = d.device_id""",
    "roster_status": f"""SELECT device_id, unit, value, {STATUS}[1 + {SEVERITY}] AS status
FROM {DEVICES} LEFT JOIN {LATEST_READINGS} USING (device_id)""",
    "stage_status": f"""SELECT display_stage, display_order,
  {STATUS}[1 + max({SEVERITY})] AS status, count(value) AS sensors_reporting
FROM {DEVICES} LEFT JOIN {LATEST_READINGS} USING (device_id) GROUP BY ALL""",
    "violations": f"SELECT {MEANS} FROM {TUMBLING_1H} WHERE mean < 20 ORDER BY window_start DESC",
    "top5_violations": f"""SELECT window_start, {HALF_EVEN.format('mean')} AS mean
FROM {TUMBLING_1H} WHERE mean < 20 ORDER BY window_start DESC LIMIT 5""",
    "compliance_daily": f"""SELECT date_trunc('day', window_start)::TIMESTAMP AS day,
  count(*) FILTER (mean < 20) AS violations,
  {level('count(*) FILTER (mean < 20)')} AS status
FROM {TUMBLING_1H} GROUP BY 1""",
    "compliance_total": f"""SELECT count(*) FILTER (mean < 20) AS violations,
  {level('count(*) FILTER (mean < 20)')} AS status FROM {TUMBLING_1H}""",
    "violations_by_rule": f"""
SELECT 'temp_wide' AS metric, window_start, mean, CAST(15 AS DOUBLE) AS threshold
FROM {TEMP_1H} WHERE mean < 15
UNION ALL SELECT 'compliance_wide', window_start, mean, CAST(20 AS DOUBLE)
FROM {TUMBLING_1H} WHERE mean < 20""",
    "compliance_by_rule": f"""
SELECT 'temp_wide' AS metric, date_trunc('day', window_start)::TIMESTAMP AS day,
  count(*) FILTER (mean < 15) AS violations,
  CASE WHEN count(*) FILTER (mean < 15) = 0 THEN 'OK'
       WHEN count(*) FILTER (mean < 15) < 5 THEN 'WARNING' ELSE 'CRITICAL' END AS status
FROM {TEMP_1H} GROUP BY 2
UNION ALL SELECT 'compliance_wide', date_trunc('day', window_start)::TIMESTAMP AS day,
  count(*) FILTER (mean < 20), {level('count(*) FILTER (mean < 20)')}
FROM {TUMBLING_1H} GROUP BY 2""",
    "relative_alert": f"""SELECT window_start, mean, round(baseline, 6) AS baseline,
  CASE WHEN n >= 10 AND mean > 1.5 * baseline THEN 'ALERT' ELSE 'OK' END AS status
FROM (SELECT window_start, mean, avg(mean) OVER w AS baseline, count(*) OVER w AS n
      FROM {VIB_2H}
      WINDOW w AS (ORDER BY window_start ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))""",
    "relative_alert_now": f"""SELECT CASE WHEN count(*) = 0 THEN 'NO DATA'
  WHEN count(*) >= 10 AND max_by(mean, window_start) > 1.5 * avg(mean) THEN 'ALERT'
  ELSE 'OK' END AS status, max_by(mean, window_start) AS value
FROM (SELECT window_start, mean FROM {VIB_2H} ORDER BY window_start DESC LIMIT 10)""",
    "temperature_alarm": f"""SELECT window_start, mean, mean < 20 AS below_minimum
FROM {TEMP_1H} ORDER BY window_start DESC LIMIT 1""",
    "current_hour": f"""SELECT window_start, CAST(trunc(value_sum) AS BIGINT) AS total
FROM {HOURLY} ORDER BY window_start DESC LIMIT 1""",
    "last_8_hours": f"""SELECT strftime(window_start, '%H:%M:%S') AS hour, value_sum
FROM {HOURLY} ORDER BY window_start DESC LIMIT 8""",
    "last_20_windows": f"""SELECT window_end, mean
FROM {VIB_2H} ORDER BY window_start DESC LIMIT 20""",
    "temperature_series": f"SELECT window_start, value_sum, value_count, mean FROM {TEMP_1H}",
    "production_series": f"SELECT window_start, value_sum, value_count, mean FROM {HOURLY}",
    "vibration_series": f"SELECT window_start, value_sum, value_count, mean FROM {VIB_2H}",
    "series_overlay": f"""SELECT ts, value, 'raw' AS trace FROM events WHERE {PAIR}
UNION ALL SELECT window_end, mean, '1-hour mean' FROM {TUMBLING_1H}""",
    "recent_readings": f"""SELECT event_type AS device_id, value, ts AS event_time, event_id
FROM events WHERE ts BETWEEN {MIDDLE} - INTERVAL 1 DAY AND {MIDDLE} + INTERVAL 2 HOUR""",
    "tail_filtered": f"""SELECT event_type AS device_id, value, ts AS event_time, event_id
FROM events WHERE {PAIR} ORDER BY event_id DESC LIMIT 200""",
    "metric_tail": f"""SELECT metric, window_start, batch_id, value_sum, value_count
FROM ({ALL_REVISIONS}) ORDER BY batch_id DESC, metric DESC, window_start DESC LIMIT 200""",
    "rolling_buffer": """SELECT event_type AS device_id, value, ts AS event_time, event_id
FROM events ORDER BY event_id DESC LIMIT 3000""",
    "option_list": "SELECT DISTINCT event_type AS device_id FROM events ORDER BY 1",
    "data_lag": f"""SELECT (epoch_us({AS_OF}) - epoch_us(max_by(ts, event_id))) / 1000000 AS lag_s
FROM events""",
    "revision_log": f"""SELECT window_start, window_end, batch_start, revision, value_sum,
  value_count FROM {revisions('production_wide', COUNTER, 3600, 3600)}""",
    "latest_revision": f"SELECT window_start, value_sum, value_count FROM {HOURLY}",
    "lateness_profile": f"""SELECT event_type AS device_id, count(*) AS readings,
  max(late_s) AS max_s, round(quantile_cont(late_s, 0.5), 6) AS p50_s,
  round(quantile_cont(late_s, 0.95), 6) AS p95_s, round(quantile_cont(late_s, 0.99), 6) AS p99_s
FROM (SELECT event_type, (epoch_us(arrival_time) - epoch_us(ts)) // 1000000 AS late_s
      FROM {ARRIVED}) GROUP BY 1""",
    "sensor_gaps": f"""SELECT event_type AS device_id, ts AS gap_start, gap_end,
  round((epoch_us(gap_end) - epoch_us(ts)) / 1000000, 6) AS gap_s
FROM (SELECT event_type, ts, coalesce(lead(ts) OVER (PARTITION BY event_type ORDER BY ts),
        {AS_OF}) AS gap_end FROM events)
WHERE epoch_us(gap_end) - epoch_us(ts) > 1200000000""",
    "silent_devices": f"""SELECT device_id, event_time,
  (epoch_us(TIMESTAMP '2024-01-31') - epoch_us(event_time)) / 1000000 AS silent_for_s
FROM {DEVICES} LEFT JOIN {LATEST_READINGS} USING (device_id)
WHERE event_time IS NULL OR event_time < TIMESTAMP '2024-01-31' - INTERVAL 2 HOUR""",
    "stuck_readings": """SELECT event_id, event_type AS device_id, value FROM events
QUALIFY value = lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id)""",
    "out_of_limits": f"""SELECT event_id, event_type AS device_id, value
FROM events JOIN {DEVICES} ON event_type = d.device_id
WHERE value < lo - (hi - lo) * 0.5 OR value > hi + (hi - lo) * 0.5""",
    "dedup_events": """SELECT DISTINCT event_type AS device_id, value, ts AS event_time
FROM events""",
    "stream_sliding_latest": f"SELECT {TOTALS} FROM {TEMP_1H}",
    "stream_hourly_latest": f"SELECT {TOTALS} FROM {HOURLY}",
    "stream_vibration_latest": f"SELECT {TOTALS} FROM {VIB_2H}",
    "stream_metrics_latest": metrics(
        ("temp_wide", "production_wide", "compliance_wide", "vibration_wide"),
        "window_start, value_sum, value_count",
    ),
    "stream_by_site": f"""SELECT CAST(user_id AS VARCHAR) AS site, window_start, value_sum,
  value_count FROM {windows(PAIR, 3600, 3600, 'user_id')}""",
    "stream_definitions": metrics(
        ("temp_wide", "production_wide", "compliance_wide", "vibration_wide"),
        "window_start, value_sum, value_count",
    ),
    "stream_violations": f"SELECT window_start, mean FROM {TUMBLING_1H} WHERE mean < 20",
    "stream_latest_per_device": f"SELECT * FROM {LATEST_READINGS}",
    "stream_dedup": """SELECT DISTINCT event_type AS device_id, value, ts AS event_time
FROM events""",
    "stream_landed": """SELECT event_type AS device_id, value, ts AS event_time FROM events
WHERE event_type NOT IN ('signup', 'error')
  AND NOT (event_type = 'click' AND value > 100) AND NOT (event_type = 'view' AND value < 5)""",
    "convergence_diff": CONVERGENCE,
    "compacted_latest": f"SELECT {TOTALS} FROM {TEMP_1H}",
    "stream_revisions": f"SELECT {TOTALS} FROM {HOURLY}",
    "stream_combined": metrics(
        ("temp_wide", "production_wide"), "window_start, value_sum, value_count"
    ),
    "arrived_after": f"""SELECT event_id, event_type AS device_id, value
FROM {ARRIVED} WHERE arrival_time > {MIDDLE}""",
    "metric_options": f"SELECT DISTINCT metric FROM ({ALL_REVISIONS})",
    "alert_by_site": f"""SELECT site,
  CASE WHEN count(*) >= 10 AND max_by(mean, window_start) > avg(mean) * 1.5
       THEN 'ALERT' ELSE 'OK' END AS status, max_by(mean, window_start) AS value
FROM (SELECT * FROM {BY_SITE_VIBRATION}
      QUALIFY row_number() OVER (PARTITION BY site ORDER BY window_start DESC) <= 10)
GROUP BY site""",
    "last_windows_by_site": f"""SELECT site, window_start, value_sum FROM {BY_SITE_HOURLY}
QUALIFY row_number() OVER (PARTITION BY site ORDER BY window_start DESC) <= 8""",
    "current_hour_by_site": f"""SELECT site, max(window_start) AS window_start,
  CAST(trunc(max_by(value_sum, window_start)) AS BIGINT) AS total
FROM {BY_SITE_HOURLY} GROUP BY site""",
    "compliance_by_site": f"""SELECT site, count(*) FILTER (mean < 20) AS violations,
  {level('count(*) FILTER (mean < 20)')} AS status
FROM {BY_SITE_COMPLIANCE} GROUP BY site""",
}
