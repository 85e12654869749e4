"""Joins by time: the last known value, spans that hold a reading, readings close together.

None of them compares all with all, and none puts a series into one task: time is cut
into chunks or buckets that are part of the key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions import micros

US = 1_000_000


def _chunk(at: Column | str, size_s: int) -> Column:
    return F.floor((F.col(at) if isinstance(at, str) else at) / F.lit(size_s * US))


def as_of(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    ts: str = "event_time",
    valid_from: str = "valid_from",
    tie: Sequence[str] = (),
    chunk_s: int = 3600,
) -> DataFrame:
    """Adds to each row of ``left`` the ``values`` of the last row of ``right`` with the same
    keys that began at or before its time; null where there is none.

    Of several right rows of one time the one that is last by ``tie`` counts. Left rows
    without time, and rows with a null key, find nothing; right rows without time are never
    found. A right row carries its values whole: a null among them is the last known value.

    One union of both sides is sorted within chunks of ``chunk_s`` seconds. What is valid when
    a chunk begins is carried into it as one more row: the last right row of each earlier
    chunk, found by partial aggregation and a window over one row per chunk. A task so sees of a
    key one chunk, or one row per chunk, whatever the number of readings.
    """
    state = F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate(values)])
    place = F.struct(micros(F.col(valid_from)).alias("at"), *[F.col(c).alias(f"t{i}") for i, c in enumerate(tie)])
    known = right.select(
        *keys, place.alias("_place"), F.struct(F.lit(True).alias("known"), state.alias("v")).alias("_state")
    ).where("_place.at is not null")
    known = known.withColumn("_chunk", _chunk("_place.at", chunk_s))
    whole = F.struct(*[F.col(c) for c in left.columns])
    asking = left.select(*keys, whole.alias("_row"), micros(F.col(ts)).alias("_at"))
    # Rows that can find nothing need not meet in one task: they are dealt by a hash.
    asking = asking.withColumn(
        "_chunk", F.coalesce(_chunk("_at", chunk_s), -1 - F.pmod(F.xxhash64("_row"), F.lit(1024)))
    )

    nothing = {
        "_row": F.lit(None).cast(asking.schema["_row"].dataType),
        "_at": F.lit(None).cast("long"),
        "_place": F.lit(None).cast(known.schema["_place"].dataType),
        "_state": F.lit(None).cast(known.schema["_state"].dataType),
    }
    # Chunks with a reading, and the last right row of each chunk that has one.
    last_known = known.groupBy(*keys, "_chunk").agg(
        F.max("_place").alias("_place"), F.max_by("_state", "_place").alias("_state")
    )
    steps = (
        asking.select(*keys, "_chunk")
        .distinct()
        .withColumns({c: nothing[c] for c in ("_place", "_state")})
        .unionByName(last_known)
    )
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rangeBetween(Window.unboundedPreceding, -1)
    carried = (
        steps.withColumn("_carried", F.last("_state", ignorenulls=True).over(earlier))
        .where("_place is null and _carried is not null")
        .select(*keys, "_chunk", F.col("_carried").alias("_state"))
    )

    fields = [*keys, "_chunk", "_at", "_place", "_state", "_row"]

    def side(rows: DataFrame, **more: Column) -> DataFrame:
        missing = {c: v for c, v in nothing.items() if c not in rows.columns}
        return rows.withColumns({**missing, **more}).select(*fields)

    together = (
        side(known, _at=F.col("_place.at"))
        .unionByName(side(carried, _at=F.col("_chunk") * chunk_s * US - 1))
        .unionByName(side(asking))
    )
    # At one time right rows come first, in the order of their ties.
    order = Window.partitionBy(*keys, "_chunk").orderBy(
        F.col("_at"), F.col("_row").isNotNull(), F.col("_place")
    )
    last = F.last("_state", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    usable = F.col("_at").isNotNull()
    for k in keys:
        usable = usable & F.col(k).isNotNull()
    found = together.withColumn("_state", F.when(usable, last)).where("_row is not null")
    return found.select("_row.*", *[F.col("_state.v")[f"v{i}"].alias(c) for i, c in enumerate(values)])


#: A wide bucket is as long as this many narrow ones, and dealt over so many parts.
WIDE, PARTS = 64, 8


def within_spans(
    points: DataFrame,
    spans: DataFrame,
    keys: Sequence[str],
    ts: str = "event_time",
    start: str = "span_start",
    end: str = "span_end",
    bucket_s: int = 900,
) -> DataFrame:
    """Every pair of a row of ``points`` and a span of the same keys that holds its time,
    start included, end excluded; columns of both, keys once.

    Spans are indexed by buckets of time: the wide ones (``WIDE`` times ``bucket_s``) that
    they fill, and narrow ones of ``bucket_s`` seconds from either end to those. A reading
    looks up its narrow and its wide bucket, so a pair meets once; only in the buckets of
    the two ends is there anything left to compare, and a span of any length is few rows. A
    wide bucket is dealt over ``PARTS`` parts by the time of its readings and its spans
    repeated for each, so a task sees of a key ``WIDE / PARTS`` narrow buckets at most;
    adaptive execution splits what is denser still. Spans without a start or an end, or that
    do not end behind their start, hold nothing; neither do null keys or times.
    """
    own = [c for c in spans.columns if c not in keys]
    narrow = bucket_s * US

    def places(first: Column, last: Column, level: int, part: Column) -> Column:
        """Buckets from ``first`` to ``last``, none if it is smaller."""
        found = F.transform(
            F.sequence(first, last),
            lambda b: F.struct(F.lit(level).alias("level"), b.cast("long").alias("bucket"), part.alias("part")),
        )
        return F.when(first <= last, found).otherwise(F.array())

    cut = spans.withColumns({"_begin": micros(F.col(start)), "_stop": micros(F.col(end))})
    cut = cut.where("_begin < _stop").withColumns(
        {
            "_low": F.floor(F.col("_begin") / narrow),
            "_high": F.floor((F.col("_stop") - 1) / narrow),
            # Wide buckets that lie between the narrow ones of both ends.
            "_from": F.floor(F.col("_begin") / (narrow * WIDE)) + 1,
            "_to": F.floor((F.col("_stop") - 1) / (narrow * WIDE)) - 1,
        }
    )
    low, high, from_, to = (F.col(c) for c in ("_low", "_high", "_from", "_to"))
    whole = from_ <= to
    no_part = F.lit(0)
    before = F.when(whole, from_ * WIDE - 1).otherwise(high)
    pieces = F.concat(
        places(low, before, 0, no_part),
        F.when(whole, places((to + 1) * WIDE, high, 0, no_part)).otherwise(F.array()),
        *[places(from_, to, 1, F.lit(k)) for k in range(PARTS)],
    )
    place = [*keys, "_level", "_bucket", "_part"]
    index = cut.withColumn("_piece", F.explode(pieces)).select(
        *keys, *own, "_begin", "_stop", *_placed("_piece")
    )
    at = F.col("_at")
    asked = points.withColumn("_at", micros(F.col(ts))).where("_at is not null")
    nearest = F.floor(at / narrow)
    asks = F.array(
        F.struct(F.lit(0).alias("level"), nearest.alias("bucket"), no_part.alias("part")),
        F.struct(
            F.lit(1).alias("level"),
            F.floor(nearest / WIDE).alias("bucket"),
            F.pmod(nearest, F.lit(PARTS)).cast("int").alias("part"),
        ),
    )
    asked = asked.withColumn("_ask", F.explode(asks)).select(*points.columns, "_at", *_placed("_ask"))
    inside = (at >= F.col("_begin")) & (at < F.col("_stop"))
    return asked.join(index, place).where(inside).select(*points.columns, *own)


def _placed(name: str) -> list[Column]:
    return [F.col(f"{name}.{c}").alias(f"_{c}") for c in ("level", "bucket", "part")]


def near_in_time(
    left: DataFrame,
    right: DataFrame,
    before_s: int,
    after_s: int,
    keys: Sequence[str] = (),
    ts: str = "event_time",
    right_ts: str = "right_time",
    how: str = "left_outer",
    grouped: bool = False,
) -> DataFrame:
    """Pairs of rows whose times lie close: ``right_ts`` from ``before_s`` seconds before the
    left time to ``after_s`` after it, both included; columns of both, keys once.

    ``how`` is ``inner`` or ``left_outer``. Times are cut into buckets of the whole width,
    a part of the join key: a left row lies in one, a right row is sent to the two at most
    that it can reach. So a series without other keys is spread over its buckets, and a pair
    meets once. On two streams, each behind its watermark, a row is kept in state only
    until the watermarks rule out a partner, and a left row without one is emitted then.

    Pairs grow with the square of the readings in a bucket. With ``grouped`` the result is a row
    per bucket instead, as large as the readings: its left rows, each with where its partners
    begin and how many they are among the right rows. :func:`near_pairs` makes the pairs of
    these, by ``how``; left rows without time are left out. On streams a bucket is emitted when
    the watermarks have passed it.
    """
    if grouped:
        return _near_groups(left, right, before_s, after_s, keys, ts, right_ts)
    width = max(1, before_s + after_s) * US
    at, near = micros(F.col(ts)), micros(F.col(right_ts))
    bucket = F.floor(at / width)
    reach = F.sequence(F.floor((near - after_s * US) / width), F.floor((near + before_s * US) / width))
    one = left.withColumn("_bucket", bucket)
    two = right.withColumns({f"_{k}": F.col(k) for k in keys}).drop(*keys).withColumn(
        "_right_bucket", F.explode(reach)
    )
    together = (F.col("_bucket") == F.col("_right_bucket")) & (
        F.col(right_ts) >= F.col(ts) - F.expr(f"interval {before_s} seconds")
    ) & (F.col(right_ts) <= F.col(ts) + F.expr(f"interval {after_s} seconds"))
    for k in keys:
        together = together & (F.col(k) == F.col(f"_{k}"))
    own = [c for c in right.columns if c not in keys]
    return one.join(two, together, how).select(*left.columns, *own)


def near_pairs(groups: DataFrame, how: str = "left_outer") -> DataFrame:
    """The pairs that groups of :func:`near_in_time` stand for, which are dealt out first: few
    files of groups may stand for very many pairs."""
    parts = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = groups.repartition(parts).select(F.explode("_lefts").alias("_one"), "_rights")
    partners = F.slice("_rights", F.col("_one.first") + 1, F.col("_one.n"))
    explode = F.explode_outer if how == "left_outer" else F.explode
    return rows.select("_one.row", explode(partners).alias("_other")).select("row.*", "_other.*")


def _near_groups(
    left: DataFrame, right: DataFrame, before_s: int, after_s: int, keys: Sequence[str], ts: str, right_ts: str
) -> DataFrame:
    """``_lefts`` (``row``, ``first``, ``n``) and ``_rights``, in the order of time, of each bucket.

    A bucket is the window of all right rows that its left rows can reach: two of them hold a
    right row, one a left row, that in the middle of the window.
    """
    width = max(1, before_s + after_s)
    own = [c for c in right.columns if c not in keys]
    found = right
    for k in keys:
        found = found.where(F.col(k).isNotNull())
    one = left.select(*keys, F.col(ts).alias("_time"), F.struct(*left.columns).alias("_left"))
    two = found.select(*keys, F.col(right_ts).alias("_time"), F.struct(*own).alias("_right"))
    kinds = {**dict(one.dtypes), **dict(two.dtypes)}
    span = F.window("_time", f"{2 * width} seconds", f"{width} seconds", f"{-before_s % width} seconds")
    rows = one.withColumn("_right", F.lit(None).cast(kinds["_right"])).unionByName(
        two.withColumn("_left", F.lit(None).cast(kinds["_left"]))
    )
    middle = F.col("_span.start") + F.expr(f"interval {before_s} seconds")
    in_middle = (F.col("_time") >= middle) & (F.col("_time") < middle + F.expr(f"interval {width} seconds"))
    buckets = (
        rows.withColumn("_span", span)
        .where(F.col("_left").isNull() | in_middle)
        .groupBy(*keys, "_span")
        .agg(F.collect_list("_left").alias("_lefts"), F.collect_list("_right").alias("_rights"))
        .where(F.size("_lefts") > 0)
        .select("_lefts", "_rights")
    )

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, GROUPS):
                part = batch.slice(at, GROUPS)
                yield _matched(part.column(0), part.column(1), ts, right_ts, before_s * US, after_s * US)

    lefts = f"array<struct<row: {kinds['_left']}, first: int, n: int>>"
    return buckets.mapInArrow(matched, f"_lefts {lefts}, _rights array<{kinds['_right']}>")


#: Buckets that leave a Python worker at a time.
GROUPS = 16


def _matched(
    lefts: pa.ListArray, rights: pa.ListArray, ts: str, right_ts: str, before: int, after: int
) -> pa.RecordBatch:
    """Right rows in the order of time, and the place of those near each left row."""

    def bounds(lists: pa.ListArray) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]).astype(np.int32)

    def times(rows: pa.StructArray, name: str) -> np.ndarray:
        return rows.field(name).cast(pa.int64()).to_numpy(zero_copy_only=False)

    left, right = lefts.flatten(), rights.flatten()
    begin, right_begin = bounds(lefts), bounds(rights)
    at, near = times(left, ts), times(right, right_ts)
    group = np.repeat(np.arange(len(rights)), np.diff(right_begin))
    order = np.lexsort((near, group))
    near = near[order]
    first, end = np.zeros(len(at), np.int32), np.zeros(len(at), np.int32)
    for k in range(len(lefts)):
        mine, other = slice(begin[k], begin[k + 1]), near[right_begin[k] : right_begin[k + 1]]
        first[mine] = np.searchsorted(other, at[mine] - before, "left")
        end[mine] = np.searchsorted(other, at[mine] + after, "right")
    placed = pa.StructArray.from_arrays([left, pa.array(first), pa.array(end - first)], ["row", "first", "n"])
    return pa.RecordBatch.from_arrays(
        [
            pa.ListArray.from_arrays(pa.array(begin), placed),
            pa.ListArray.from_arrays(pa.array(right_begin), right.take(pa.array(order))),
        ],
        ["_lefts", "_rights"],
    )
