"""Data quality on telemetry (EXT-1, EXT-2, EXT-4, EXT-6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions import micros, seconds_between
from tidegauge.operators.trailing import neighbour_frames


def sensor_gaps(
    df: DataFrame,
    silent_s: int,
    as_of: Column | None = None,
    key: str = "device_id",
    ts: str = "event_time",
    chunk_s: int = 7 * 86_400,
) -> DataFrame:
    """Stretches of more than ``silent_s`` seconds without a reading (EXT-1).

    Readings closer than that can share a bucket of ``silent_s`` seconds without
    hiding a gap, so only the first and last reading of each bucket are compared
    with the next bucket; what is sorted grows with time, not with readings.
    ``as_of`` adds the gap from the last reading until then.
    """
    bucket = F.window(ts, f"{silent_s} seconds")
    buckets = df.groupBy(key, bucket.alias("b")).agg(
        F.min(ts).alias("first"), F.max(ts).alias("gap_start")
    )
    following = neighbour_frames(
        buckets.drop("b"),
        [key],
        "first",
        0,
        1,
        {"next": F.last("first"), "rows": F.count(F.lit(1))},
        chunk_s,
    )
    until = F.when(F.col("rows") == 2, F.col("next"))
    if as_of is not None:
        until = until.otherwise(as_of)
    silence = micros(F.col("gap_end")) - micros(F.col("gap_start"))
    return (
        following.withColumn("gap_end", until)
        .filter(silence > silent_s * 1_000_000)
        .select(
            key,
            "gap_start",
            "gap_end",
            seconds_between(F.col("gap_start"), F.col("gap_end")).alias("gap_s"),
        )
    )


def silent_devices(
    latest: DataFrame, devices: DataFrame, silent_s: int, as_of: Column
) -> DataFrame:
    """Devices of the roster without a reading for ``silent_s`` seconds, or ever (EXT-1).

    ``latest`` is the latest reading per device, as a table or kept by a stream.
    """
    age = seconds_between(F.col("event_time"), as_of)
    return (
        devices.select("device_id")
        .join(latest.select("device_id", "event_time"), "device_id", "left")
        .withColumn("silent_for_s", age)
        .filter(F.col("silent_for_s").isNull() | (F.col("silent_for_s") > silent_s))
    )


def lateness_profile(
    df: DataFrame,
    quantiles: Sequence[float] = (0.5, 0.95, 0.99),
    resolution_s: int = 1,
    key: str = "device_id",
    ts: str = "event_time",
    arrival: str = "arrival_time",
) -> DataFrame:
    """How late readings arrive, per device (EXT-4); pick watermarks by it.

    Exact on lateness rounded to ``resolution_s``: readings collapse to a histogram
    first, so memory is bounded by the spread of lateness and not by readings.
    """
    step = F.lit(resolution_s * 1_000_000)
    late = micros(F.col(arrival)) - micros(F.col(ts))
    histogram = (
        df.select(key, (F.floor(late / step) * resolution_s).alias("late_s"))
        .filter(F.col("late_s").isNotNull())
        .groupBy(key, "late_s")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    found = histogram.groupBy(key).agg(
        F.sum("n").alias("readings"),
        F.max("late_s").alias("max_s"),
        F.percentile("late_s", list(quantiles), F.col("n")).alias("at"),
    )
    names = [f"p{round(q * 100)}_s" for q in quantiles]
    return found.select(
        key, "readings", "max_s", *[F.col("at")[i].alias(n) for i, n in enumerate(names)]
    )


def out_of_limits(df: DataFrame, devices: DataFrame, slack: float = 0.0) -> DataFrame:
    """Readings beyond their device's limits by more than ``slack`` of the range (EXT-2)."""
    room = (F.col("hi") - F.col("lo")) * F.lit(slack)
    outside = (F.col("value") < F.col("lo") - room) | (F.col("value") > F.col("hi") + room)
    limits = devices.select("device_id", "lo", "hi")
    return df.join(limits, "device_id").filter(outside)


def stuck_readings(
    df: DataFrame,
    n: int,
    key: str = "device_id",
    ts: str = "event_time",
    tie: Sequence[str] = (),
    chunk_s: int = 60,
) -> DataFrame:
    """Readings that repeat the value of the ``n - 1`` readings before them (EXT-2).

    One task sorts the readings of a device in a minute (``chunk_s``) and counts how long the
    run of equal values is that each reading ends. A run that begins its chunk may go on from
    the chunk before: of such runs the readings that are not stuck yet go on to a second
    window, over the key, with the last reading of each chunk, at most ``n`` rows for a
    chunk of any density. There each chunk's last run is added up with those before it. All
    other readings leave, or are passed through in their own chunk, before that.
    """
    order = [F.col(ts), *[F.col(t) for t in tie]]
    ahead = (Window.unboundedPreceding, -1)
    # Nulls repeat nothing.
    same = F.coalesce(F.col("value") == F.col("_before"), F.lit(False))

    chunk = Window.partitionBy(key, "_chunk").orderBy(*order)
    runs = (
        df.filter(F.col(ts).isNotNull())
        .withColumn("_chunk", F.floor(micros(F.col(ts)) / F.lit(chunk_s * 1_000_000)))
        .withColumns(
            {
                "_nth": F.row_number().over(chunk),
                "_before": F.lag("value").over(chunk),
                "_last": F.lead(F.lit(False), 1, True).over(chunk),
            }
        )
        .withColumn("_begun", F.max(F.when(~same, F.col("_nth"))).over(chunk))
        .withColumn("_run", F.col("_nth") - F.col("_begun") + 1)
        .drop("_before")
    )
    first, stuck = F.col("_begun") == 1, F.col("_run") >= n
    some = F.col("value").isNotNull()
    open_ = (first & ~stuck & some) | F.col("_last")
    kept = runs.filter(open_ | (stuck & some)).withColumn("_group", F.when(~open_, F.col("_chunk")))

    group = Window.partitionBy(key, "_group").orderBy(*order)
    last, run = F.col("_last"), F.col("_run")
    ended = kept.withColumns(
        {
            "_before": F.last(F.when(last, F.struct("value")), ignorenulls=True).over(group.rowsBetween(*ahead))["value"],
            "_sum": F.sum(F.when(last, run)).over(group.rowsBetween(Window.unboundedPreceding, 0)),
        }
    )
    # What lies ahead of the run that a chunk's last reading ends, unless it goes on.
    base = F.when(last & ~(first & same), F.col("_sum") - run)
    joined = ended.withColumns(
        {
            "_base": F.max(base).over(group.rowsBetween(*ahead)),
            "_so_far": F.sum(F.when(last, run)).over(group.rowsBetween(*ahead)),
        }
    )
    carried = F.when(first & same & F.col("_group").isNull(), F.col("_so_far") - F.col("_base"))
    long = run + F.coalesce(carried, F.lit(0)) >= n
    return joined.filter(long & some).select(*df.columns)


def suppress_duplicates(
    df: DataFrame,
    keys: Sequence[str] = ("device_id", "event_time", "value"),
    ts: str = "event_time",
    delay_s: int | None = None,
) -> DataFrame:
    """One copy of each reading (EXT-6).

    A table drops copies in each task before the shuffle. On a stream, copies are
    recognised while they are at most ``delay_s`` apart, so that state stays bounded;
    the copies of one reading in a batch meet in one task, where they are dropped as
    they pass.
    """
    if not df.isStreaming:
        return df.dropDuplicates(list(keys))
    if delay_s is None:
        raise ValueError("a stream needs delay_s to forget old readings")
    return df.withWatermark(ts, f"{delay_s} seconds").dropDuplicatesWithinWatermark(list(keys))
