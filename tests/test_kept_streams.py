"""Late readings kept, timers, sketches, sessions and joins on streams, across restarts."""

import os
import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidegauge import operators as op
from tidegauge.plans import series
from tidegauge.session import stream_session
from tidegauge.streaming import (
    gaps_of,
    missing_numbers,
    read_routed,
    read_sketches,
    recent_progress,
    routed,
    silence_events,
    start_routed,
    start_sketches,
)

START = datetime(2024, 1, 1)
SCHEMA = "device_id string, event_time timestamp, value double, n long, raw binary"


def at(seconds):
    return START + timedelta(seconds=seconds)


@pytest.fixture
def live(spark):
    return stream_session(spark, 3)


@pytest.fixture
def land(live, tmp_path):
    """Lands rows in several files; ``land.stream()`` reads all landed so far."""
    folder = str(tmp_path / "landing")

    def write(rows, schema=SCHEMA):
        live.createDataFrame(rows, schema).repartition(2).write.mode("append").parquet(folder)

    write.stream = lambda schema=SCHEMA: live.readStream.schema(schema).parquet(folder)
    return write


def wide(device, second, value=1.0, n=None, raw=None):
    return (device, None if second is None else at(second), value, n, raw)


def caught_up(query):
    query.awaitTermination()
    return query


# --- Late readings -------------------------------------------------------------


def test_kept_and_late_are_all_that_was_sent(live, land, tmp_path):
    """Each slice is a restart; slices of other hours come late in part."""
    rng = random.Random(3)
    table, checkpoint = str(tmp_path / "table"), str(tmp_path / "checkpoint")
    big = (1 << 60) + 7
    sent, expected, newest = [], Counter(), None
    for hours in ((0, 2), (1, 6), (0, 9), (20, 21), (0, 21)):
        rows = [
            wide(
                rng.choice(["a", "b", None]),
                rng.randrange(hours[0] * 3600, hours[1] * 3600),
                rng.choice([None, float("nan"), 0.1, -7.0]),
                rng.choice([None, big]),
                rng.choice([None, b"\xff\x00", b""]),
            )
            for _ in range(60)
        ] + [wide("a", None)]
        watermark = None if newest is None else newest - timedelta(seconds=600)
        for r in rows:
            end = r[1] and r[1].replace(minute=0, second=0) + timedelta(hours=1)
            late = bool(end and watermark and end <= watermark)
            expected[(str(r[:3]), r[3], r[4], late)] += 1
        newest = max([r[1] for r in rows if r[1]] + ([newest] if newest else []))
        sent += rows
        land(rows)
        caught_up(start_routed(land.stream(), table, checkpoint, 3600, 600, available_now=True))
    found = read_routed(live, table, land.stream().schema)
    got = Counter(
        (str((r["device_id"], r["event_time"], r["value"])), r["n"], None if r["raw"] is None else bytes(r["raw"]), r["late"])
        for r in found.collect()
    )
    assert got == expected and sum(got.values()) == len(sent)
    assert sum(n for k, n in got.items() if k[3]) > 20
    assert missing_numbers(found).count() == 0
    # One side's files are read alone.
    text = found.where("late")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(late" in text


def test_a_lost_row_is_missed(live, land, tmp_path):
    table, checkpoint = str(tmp_path / "table"), str(tmp_path / "checkpoint")
    land([wide("a", i) for i in range(50)])
    caught_up(start_routed(land.stream(), table, checkpoint, 60, 0, available_now=True))
    found = read_routed(live, table, land.stream().schema)
    assert missing_numbers(found).count() == 0
    assert missing_numbers(found.where("nth > 1")).count() > 0
    doubled = found.unionByName(found.where("value = 1.0"))
    assert missing_numbers(doubled).count() > 0


def test_sliding_windows_are_late_with_their_last_one(live, land, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        query = routed(land.stream(), 120, 0, slide_s=30).writeStream.format("parquet")
        caught_up(query.option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())

    land([wide("a", 1000)])
    run()
    # The newest window of second 900 ends at 1020, that of 869 at 960.
    land([wide("a", 900), wide("a", 869)])
    run()
    assert {(r["event_time"], r["late"]) for r in live.read.parquet(out).collect()} == {
        (at(1000), False), (at(900), False), (at(869), True),
    }


# --- Timers --------------------------------------------------------------------


def told(live, land, tmp_path, slices, silent_s=100, delay_s=50):
    """Events after each slice, from a query that restarts for each."""
    out, checkpoint = str(tmp_path / "events"), str(tmp_path / "timers")
    seen, steps = Counter(), []
    for rows in slices:
        land(rows)
        events = silence_events(land.stream(), silent_s, delay_s)
        query = events.writeStream.format("parquet").option("path", out)
        caught_up(query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        now = Counter(map(tuple, live.read.parquet(out).collect()))
        steps.append(now - seen)
        seen = now
    return steps, live.read.parquet(out)


def test_silence_is_told_without_a_reading_of_the_device(live, land, tmp_path):
    steps, _ = told(
        live,
        land,
        tmp_path,
        [
            [wide("quiet", 0), wide("clock", 0)],
            [wide("clock", 90)],
            [wide("clock", 155)],  # watermark 105: the timer at 100 fires
            [wide("clock", 180), wide("clock", 230)],
            [wide("quiet", 200), wide("clock", 400)],
            [wide(None, 500), wide("quiet", None)],
        ],
    )
    silent = ("quiet", "silent", at(100), at(0), None)
    assert steps[:3] == [Counter(), Counter(), Counter([silent])]
    assert steps[3] == Counter()
    quiet = Counter({k: v for s in steps[4:] for k, v in s.items() if k[0] == "quiet"})
    assert quiet == Counter([("quiet", "recovered", at(200), at(0), at(200)), ("quiet", "silent", at(300), at(200), None)])


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_timers_equal_the_gaps_of_the_same_readings(live, land, tmp_path, seed):
    rng = random.Random(seed)
    rows = [(d, rng.randrange(20_000)) for d in ("a", "b", "c") for _ in range(60)]
    rows += [("hot", s) for s in range(0, 20_000, 40) if not 5000 < s < 5500]
    # Arrival is up to 50 seconds behind the reading, so nothing is behind the watermark.
    rows.sort(key=lambda r: r[1] + rng.randrange(50))
    cuts = sorted(rng.sample(range(len(rows)), 3))
    slices = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True)]
    end = 30_000
    _, events = told(
        live, land, tmp_path, [[wide(d, s) for d, s in part] for part in slices] + [[wide("clock", end + 50)]]
    )
    found = gaps_of(events.where("device_id <> 'clock'"))
    readings = live.createDataFrame([(d, at(s)) for d, s in rows], "device_id string, event_time timestamp")
    gaps = op.sensor_gaps(readings, 100, F.lit(at(end)))
    got = {(r["device_id"], r["gap_start"], r["gap_end"] or at(end)) for r in found.collect()}
    assert got == {tuple(r) for r in gaps.select("device_id", "gap_start", "gap_end").collect()}
    assert all(r["silent_at"] == r["gap_start"] + timedelta(seconds=100) for r in found.collect())
    # Told once each.
    assert events.count() == events.distinct().count()


# --- Sketches, sessions, joins --------------------------------------------------


def test_a_late_reading_revises_its_pane(live, land, tmp_path):
    table, checkpoint = str(tmp_path / "sketches"), str(tmp_path / "checkpoint")

    def run():
        caught_up(start_sketches(land.stream(), table, checkpoint, 60, 300, distinct=["n"], available_now=True))
        panes = op.merged_sketches(read_sketches(live, table), 60, distinct=["n"])
        found = op.sketch_values(panes, {"p50": 0.5}, ["n"])
        return {r["window_start"]: (r["value_count"], r["p50"], r["n_count"]) for r in found.collect()}

    land([wide("a", 0, 1.0, 1), wide("b", 10, 5.0, 2), wide("a", 86_400, 9.0, 3)])
    assert run() == {at(0): (2, 1.0, 2), at(86_400): (1, 9.0, 1)}
    land([wide("a", 86_390, 7.0, 4), wide("a", 86_400, 9.5, 3), wide("a", 20, 0.0, 9)])
    # The last one is days behind the watermark.
    assert run() == {at(0): (2, 1.0, 2), at(86_340): (1, 7.0, 1), at(86_400): (2, 9.0, 1)}
    assert read_sketches(live, table, first_day="2024-01-02").count() == 1


def test_streamed_sessions_merge_late_readings_and_leave_state(live, land, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        clocked = land.stream().withWatermark("event_time", "300 seconds")
        query = op.session_totals(clocked, 60).writeStream.format("parquet").option("path", out)
        return caught_up(query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start())

    land([wide("a", 0), wide("a", 110), wide("a", 200)])
    run()
    land([wide("a", 55), wide("b", 5000)])
    last = recent_progress(run())[-1]
    found = {tuple(r)[:4] + (r["readings"],) for r in live.read.parquet(out).collect()}
    assert found == {("a", at(0), at(110), at(170), 3), ("a", at(200), at(200), at(260), 1)}
    assert last["state_rows"] == 1  # b's open session


def test_joined_streams_forget_what_no_partner_can_reach(live, land, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        rows = land.stream()
        views = rows.where("device_id = 'v'").withWatermark("event_time", "60 seconds").select("event_time", "value")
        others = rows.where("device_id = 'w'").select(F.col("event_time").alias("right_time"), F.col("value").alias("other"))
        joined = op.near_in_time(views, others.withWatermark("right_time", "60 seconds"), 10, 10)
        query = joined.writeStream.format("parquet").option("path", out)
        return caught_up(query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start())

    land([wide("v", s, float(s)) for s in range(0, 600, 100)] + [wide("w", s + 7, float(s)) for s in range(0, 600, 200)])
    first = recent_progress(run())
    land([wide("v", 595, 595.0), wide("w", 9000, 0.0), wide("v", 9000, 0.0)])
    second = recent_progress(run())
    land([wide("w", 20_000, 0.0), wide("v", 20_000, 1.0)])
    run()
    found = {(r["event_time"], r["other"]) for r in live.read.parquet(out).where("event_time < timestamp '2024-01-01 02:00:00'").collect()}
    assert found == {(at(s), float(s) if s % 200 == 0 else None) for s in range(0, 600, 100)} | {(at(595), None)}
    assert max(p["state_rows"] for p in first + second) > second[-1]["state_rows"]


def test_registered_streams_leave_no_landing_or_checkpoint(spark, monkeypatch):
    made = {}

    def folders(session, *purposes):
        found = [series.shared_folder(session, p) for p in purposes]
        made.update(zip(purposes, found, strict=True))
        return found

    monkeypatch.setattr(series, "_folders", folders)
    series.late_rows(spark, "/root/testdata/sf0.001").count()
    assert not os.path.exists(made["landing"]) and not os.path.exists(made["checkpoint"])
    assert os.path.exists(made["routed"])
