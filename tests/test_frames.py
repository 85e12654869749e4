"""Operators that split work, against brute force on one process."""

import random
from datetime import datetime, timedelta
from math import floor

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidegauge import operators as op
from tidegauge.model import METRICS, MetricDef
from tidegauge.operators.windows import common_pane
from tidegauge.sources import definition_table

START = datetime(2024, 1, 1)
READINGS = "device_id string, event_time timestamp, value double, n long"


def make(spark, rows):
    return spark.createDataFrame(
        [(d, START + timedelta(seconds=s), v, i) for i, (d, s, v) in enumerate(rows)], READINGS
    )


def skewed(seed, n=400, span_s=5 * 86_400):
    """One device has most rows; others are sparse, with days between readings."""
    rng = random.Random(seed)
    rows = [("hot", rng.randrange(span_s), float(rng.randrange(4))) for _ in range(n)]
    rows += [("cold", rng.randrange(40 * span_s), float(rng.randrange(3))) for _ in range(25)]
    return rows + [("single", 5, 1.0)]


@pytest.mark.parametrize(("before", "after"), [(9, 0), (1, 0), (0, 1), (2, 3), (0, 0)])
def test_neighbour_frames_equal_plain_frames(spark, before, after):
    rows = skewed(before * 10 + after)
    df = make(spark, rows)
    found = op.neighbour_frames(
        df,
        ["device_id"],
        "event_time",
        before,
        after,
        {"total": F.sum("value"), "size": F.count(F.lit(1)), "ids": F.collect_list("n")},
        chunk_s=6 * 3600,
        tie=["n"],
    )
    expected = {}
    for device in {d for d, _, _ in rows}:
        own = sorted((s, i, v) for i, (d, s, v) in enumerate(rows) if d == device)
        for p, (_, i, _) in enumerate(own):
            frame = own[max(0, p - before) : p + after + 1]
            expected[i] = (sum(f[2] for f in frame), len(frame), [f[1] for f in frame])
    assert {r.n: (r.total, r["size"], r.ids) for r in found.collect()} == expected


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    seconds=st.lists(st.integers(0, 3000), min_size=1, max_size=40, unique=True),
    n=st.integers(2, 12),
    chunk=st.sampled_from([7, 60, 900, 100_000]),
)
def test_trailing_mean_of_any_series(spark, seconds, n, chunk):
    df = make(spark, [("a", s, float(s)) for s in seconds])
    found = op.trailing(
        df, ["device_id"], "event_time", n, {"mean": F.avg("value")}, chunk_s=chunk
    )
    ordered = sorted(seconds)
    expected = {
        float(s): sum(ordered[max(0, p + 1 - n) : p + 1]) / min(p + 1, n)
        for p, s in enumerate(ordered)
    }
    got = {r.value: r["mean"] for r in found.collect()}
    assert got.keys() == expected.keys()
    assert all(got[k] == pytest.approx(expected[k]) for k in got)


@pytest.mark.parametrize("n", [2, 3])
def test_stuck_readings(spark, n):
    rows = skewed(n, n=200)
    found = op.stuck_readings(make(spark, rows), n, tie=["n"], chunk_s=3600)
    expected = set()
    for device in {d for d, _, _ in rows}:
        own = sorted((s, i, v) for i, (d, s, v) in enumerate(rows) if d == device)
        for p in range(n - 1, len(own)):
            if len({v for _, _, v in own[p + 1 - n : p + 1]}) == 1:
                expected.add(own[p][1])
    assert expected and {r.n for r in found.collect()} == expected


@pytest.mark.parametrize("silent_s", [60, 1800, 7200])
def test_sensor_gaps(spark, silent_s):
    rows = skewed(silent_s, n=300)
    as_of = START + timedelta(days=200)
    found = op.sensor_gaps(make(spark, rows), silent_s, F.lit(as_of), chunk_s=5 * 3600)
    expected = set()
    for device in {d for d, _, _ in rows}:
        times = sorted(START + timedelta(seconds=s) for d, s, _ in rows if d == device)
        for a, b in zip(times, [*times[1:], as_of], strict=True):
            if (b - a).total_seconds() > silent_s:
                expected.add((device, a, b, (b - a).total_seconds()))
    assert {tuple(r) for r in found.collect()} == expected
    without_tail = op.sensor_gaps(make(spark, rows), silent_s)
    assert {tuple(r) for r in without_tail.collect()} == {e for e in expected if e[2] != as_of}


@pytest.mark.parametrize(("size_s", "slide_s"), [(60, 30), (120, 30), (90, 60), (60, 60), (30, 60)])
def test_windows_of_any_shape(spark, size_s, slide_s):
    rng = random.Random(size_s + slide_s)
    rows = [("a", rng.randrange(600), float(rng.randrange(100))) for _ in range(80)]
    df = make(spark, rows)
    expected = {}
    for _, s, v in rows:
        for i in range(-10, 30):
            start = i * slide_s
            if start <= s < start + size_s:
                total, count = expected.get(start, (0.0, 0))
                expected[start] = (total + v, count + 1)

    def as_dict(result):
        return {
            (r.window_start - START).total_seconds(): (r.value_sum, r.value_count)
            for r in result.collect()
        }

    if slide_s <= size_s:
        assert as_dict(op.window_totals(df, size_s, slide_s)) == expected
    metric = MetricDef("m", ("a",), size_s, slide_s)
    definitions = definition_table(spark, [metric])
    by_table = op.metrics_by_definition(df, definitions, common_pane([metric]))
    assert as_dict(by_table) == expected


def test_pane_must_divide_every_window(spark):
    definitions = definition_table(spark, [MetricDef("m", ("a",), 90, 90)])
    with pytest.raises(Exception, match="not a multiple of 60"):
        op.metrics_by_definition(make(spark, [("a", 1, 1.0)]), definitions, 60).collect()


def test_tumbling_windows_come_out_of_sliding_ones(spark):
    df = make(spark, [("a", s, float(s % 13)) for s in range(0, 1000, 7)])
    derived = op.tumbling_from_sliding(op.window_totals(df, 60, 30), 60)
    own = op.window_totals(df, 60)
    assert derived.exceptAll(own).count() == 0 and own.exceptAll(derived).count() == 0


def test_tumbling_sums_add_up_and_sliding_ones_repeat(spark):
    df = make(spark, skewed(3))
    whole = df.agg(F.sum("value"), F.count("value")).first()
    tumbling = op.window_totals(df, 3600).agg(F.sum("value_sum"), F.sum("value_count")).first()
    sliding = op.window_totals(df, 120, 30).agg(F.sum("value_count")).first()
    assert tuple(tumbling) == tuple(whole)
    assert sliding[0] == 4 * whole[1]


def test_lateness_profile(spark):
    rng = random.Random(5)
    late = [rng.expovariate(1 / 30) for _ in range(500)]
    rows = [
        ("a", START + timedelta(seconds=i), START + timedelta(seconds=i + round(x, 6)))
        for i, x in enumerate(late)
    ]
    df = spark.createDataFrame(
        rows, "device_id string, event_time timestamp, arrival_time timestamp"
    )
    row = op.lateness_profile(df).first()
    whole = sorted(floor(round(x, 6)) for x in late)

    def quantile(q):
        at = q * (len(whole) - 1)
        lo = floor(at)
        hi = min(lo + 1, len(whole) - 1)
        return whole[lo] + (whole[hi] - whole[lo]) * (at - lo)

    assert (row.readings, row.max_s) == (500, whole[-1])
    expected = [quantile(q) for q in (0.5, 0.95, 0.99)]
    assert [row.p50_s, row.p95_s, row.p99_s] == pytest.approx(expected)


def test_revision_log_ends_in_the_window_totals(spark):
    held = F.make_dt_interval(secs=(F.col("n") * 37 % 5000).cast("decimal(18,6)"))
    df = make(spark, skewed(8)).withColumn("arrival_time", F.col("event_time") + held)
    log = op.revision_log(df, 3600, 600, ["device_id"], slide_s=1800)
    last = op.latest_revision(log, ("device_id", "window_start", "window_end"), ("batch_start",))
    last = last.drop("batch_start", "revision")
    whole = op.window_totals(df, 3600, 1800, ["device_id"]).select(*last.columns)
    assert last.exceptAll(whole).count() == 0 and whole.exceptAll(last).count() == 0


def test_convergence_reports_missing_and_different_windows(spark):
    fields = (
        "metric string, site string, window_start timestamp, window_end timestamp, "
        "value_sum double, value_count long"
    )

    def rows(*totals):
        return spark.createDataFrame(
            [
                ("m", None, START + timedelta(minutes=i), START + timedelta(minutes=i + 1), s, c)
                for i, (s, c) in enumerate(totals)
                if c is not None
            ],
            fields,
        )

    streamed = rows((1.0, 1), (2.0, 2), (0, None), (0.1 + 0.2, 3), (None, 0))
    batch = rows((1.0, 1), (2.0, 3), (5.0, 1), (0.3, 3), (None, 0))
    found = op.convergence(streamed, batch).orderBy("window_start").collect()
    assert [(r.window_start.minute, r.stream_count, r.batch_count) for r in found] == [
        (1, 2, 3),
        (2, None, 1),
    ]


def test_all_line_metrics_by_definition(spark):
    devices = [d for m in METRICS for d in m.devices] + ["belt_speed"]
    df = make(spark, [(devices[s % len(devices)], s, float(s % 17)) for s in range(900)])
    found = op.metrics_by_definition(df, definition_table(spark), common_pane(METRICS))
    for metric in METRICS:
        own = op.metric_totals(df, metric).select(*found.columns)
        part = found.filter(F.col("metric") == metric.name)
        assert own.exceptAll(part).count() == 0 and part.exceptAll(own).count() == 0
