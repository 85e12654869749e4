"""Silence seen by a timer, without a reading that tells of it (EXT-1 on a stream)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidegauge.functions import micros

US = 1_000_000
EVENTS = "device_id string, kind string, at_us long, gap_start_us long, gap_end_us long"
STATE = "settled long, told boolean, firsts array<bigint>, lasts array<bigint>"


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First and last reading per device and bucket of each batch of rows."""
    for batch in batches:
        found = (
            pa.Table.from_batches([batch])
            .group_by(["device_id", "bucket"])
            .aggregate([("us", "min"), ("us", "max")])
            .select(["device_id", "bucket", "us_min", "us_max"])
            .rename_columns(["device_id", "bucket", "first_us", "last_us"])
        )
        yield from found.combine_chunks().to_batches()


def silence_events(telemetry: DataFrame, silent_s: int, delay_s: int) -> DataFrame:
    """``silent`` and ``recovered`` events of each device: ``device_id``, ``kind``, ``at``,
    ``gap_start`` (its last reading) and for a recovery ``gap_end`` (its next one).

    A device is silent when no reading of it has come for more than ``silent_s`` seconds of
    event time. A timer says so at ``gap_start + silent_s`` as soon as the watermark passes
    this moment, moved by the readings of other devices; its next reading, in whatever
    order it arrives within ``delay_s``, is the recovery. Both are told once. Readings
    behind the watermark do not count, nor do rows without device or time.

    Readings closer than ``silent_s`` can share a bucket of that length without hiding a
    gap: each task combines its readings to the first and last of a bucket before the shuffle,
    and a device's state is its last settled reading and the buckets that the watermark has
    not passed, at most ``delay_s / silent_s + 2`` of them.
    """
    silent = silent_s * US
    us = micros(F.col("event_time"))
    rows = telemetry.where("device_id is not null and event_time is not null").select(
        F.col("device_id").cast("string"), us.alias("us"), F.floor(us / silent).alias("bucket")
    )
    buckets = rows.mapInArrow(_combine, "device_id string, bucket long, first_us long, last_us long")
    clocked = buckets.withColumn("clock", F.timestamp_micros("last_us")).withWatermark(
        "clock", f"{delay_s} seconds"
    )

    def follow(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        settled, told, firsts, lasts = state.get if state.exists else (None, False, [], [])
        settled = None if settled is None or pd.isna(settled) else int(settled)
        pending = {int(a) // silent: (int(a), int(b)) for a, b in zip(firsts, lasts, strict=True)}
        if not state.hasTimedOut:
            for frame in frames:
                for bucket, first, last in zip(
                    frame["bucket"].tolist(), frame["first_us"].tolist(), frame["last_us"].tolist(), strict=True
                ):
                    held = pending.get(bucket, (first, last))
                    pending[bucket] = (min(held[0], first), max(held[1], last))
        watermark = state.getCurrentWatermarkMs() * 1000
        events = []
        for bucket in sorted(pending):
            if (bucket + 1) * silent > watermark:
                break
            first, last = pending.pop(bucket)
            if settled is not None and first - settled > silent:
                if not told:
                    events.append((key[0], "silent", settled + silent, settled, None))
                events.append((key[0], "recovered", first, settled, first))
            told = told and settled is not None and last <= settled
            settled = last if settled is None else max(settled, last)
        following = min((a for a, _ in pending.values()), default=None)
        if settled is not None and not told and watermark > settled + silent:
            if following is None or following > settled + silent:
                events.append((key[0], "silent", settled + silent, settled, None))
                told = True
        ordered = [pending[b] for b in sorted(pending)]
        state.update((settled, told, [a for a, _ in ordered], [b for _, b in ordered]))
        moments = [(b + 1) * silent for b in pending]
        if settled is not None and not told:
            moments.append(settled + silent)
        if moments:
            # The first millisecond behind the earliest moment that can change anything.
            wake = max(min(moments) // 1000 + 1, watermark // 1000 + 1)
            state.setTimeoutTimestamp(wake)
        if events:
            yield pd.DataFrame(events, columns=["device_id", "kind", "at_us", "gap_start_us", "gap_end_us"]).astype(
                {"gap_end_us": "Int64"}
            )

    found = clocked.groupBy("device_id").applyInPandasWithState(
        follow, EVENTS, STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
    return found.select(
        "device_id",
        "kind",
        *[F.timestamp_micros(f"{c}_us").alias(c) for c in ("at", "gap_start", "gap_end")],
    )


def gaps_of(events: DataFrame) -> DataFrame:
    """The stretches that :func:`silence_events` told of; an open one has no end."""
    return events.groupBy("device_id", "gap_start").agg(
        F.min(F.when(F.col("kind") == "silent", F.col("at"))).alias("silent_at"),
        F.max("gap_end").alias("gap_end"),
    )
