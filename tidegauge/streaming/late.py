"""Readings behind the watermark kept aside instead of lost (STR-10, EXT-4)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidegauge.functions import micros
from tidegauge.model import TRIGGER_S
from tidegauge.streaming.runner import _trigger
from tidegauge.streaming.sinks import run_identity

#: Parts a stream is routed in; each counts what it has seen.
PARTS = 32
FOREVER = 1 << 62


def _packed(field: T.StructField) -> F.Column:
    """A column as text, which keeps nulls and whole numbers as they are on the way."""
    name = F.col(f"`{field.name}`")
    return F.base64(name) if isinstance(field.dataType, T.BinaryType) else name.cast("string")


def _unpacked(field: T.StructField) -> F.Column:
    name = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.BinaryType):
        return F.unbase64(name)
    return name.cast(field.dataType)


def routed(
    telemetry: DataFrame,
    size_s: int,
    delay_s: int,
    slide_s: int | None = None,
    ts: str = "event_time",
    parts: int = PARTS,
) -> DataFrame:
    """Every reading of a stream with ``late``: whether its newest window had ended when
    the watermark of the batch before passed, so that a windowed aggregation would have
    dropped it; and ``part``, ``nth``: its running number among the kept or the late
    readings of its part, counted in state across restarts.

    The last window of a reading decides, as in Spark's own rule. Readings without event
    time are in no window and never late. Columns must be of plain types. Readings are dealt
    to parts by a hash of the whole row, so no device fills a task, and only counts are
    state. Feed it readings filtered to the devices of one metric: they move its clock.
    """
    slide = (slide_s or size_s) * 1_000_000
    end = F.floor(micros(F.col(ts)) / slide) * slide + size_s * 1_000_000
    fields = telemetry.schema.fields
    prepared = telemetry.withWatermark(ts, f"{delay_s} seconds").select(
        F.pmod(F.xxhash64(*[F.col(f"`{f.name}`") for f in fields]), F.lit(parts)).cast("int").alias("_part"),
        F.col(ts).alias("_clock"),
        F.coalesce(end, F.lit(FOREVER)).alias("_end"),
        *[_packed(f).alias(f.name) for f in fields],
    )
    names = [f.name for f in fields]

    def route(
        key: tuple, frames: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        kept, late = state.get if state.exists else (0, 0)
        watermark = state.getCurrentWatermarkMs() * 1000
        for frame in frames:
            behind = frame["_end"] <= watermark
            nth = behind.cumsum().where(behind, (~behind).cumsum())
            out = frame[names].copy()
            out["part"], out["late"] = key[0], behind
            out["nth"] = nth + behind.map({True: late, False: kept})
            late, kept = late + int(behind.sum()), kept + int((~behind).sum())
            yield out
        state.update((kept, late))

    text = ", ".join(f"`{n}` string" for n in names)
    found = prepared.groupBy("_part").applyInPandasWithState(
        route,
        f"{text}, part int, late boolean, nth long",
        "kept long, late long",
        "append",
        GroupStateTimeout.NoTimeout,
    )
    return found.select(*[_unpacked(f).alias(f.name) for f in fields], "part", "late", "nth")


def start_routed(
    telemetry: DataFrame,
    table: str,
    checkpoint: str,
    size_s: int,
    delay_s: int,
    slide_s: int | None = None,
    available_now: bool = False,
    trigger_s: int = TRIGGER_S,
) -> StreamingQuery:
    """Starts the routing into a table laid out by ``late``: the kept readings are the input
    of the metric, the late ones its side table. A batch owns its directory and overwrites
    it, so a repeated batch changes nothing. Its state is two counts for each part: start
    it from ``stream_session(spark, small_state=True)``."""
    run = run_identity(telemetry.sparkSession, checkpoint, table)

    def write(batch: DataFrame, batch_id: int) -> None:
        place = f"{table}/run_id={run}/batch_id={batch_id}"
        batch.write.mode("overwrite").partitionBy("late").parquet(place)

    return (
        routed(telemetry, size_s, delay_s, slide_s)
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(available_now, trigger_s))
        .foreachBatch(write)
        .start()
    )


def read_routed(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """What was routed: the readings with ``late``, ``part``, ``nth``, ``run_id`` and
    ``batch_id``. A filter on ``late`` reads one side's files only."""
    fields = T.StructType(
        [
            *schema.fields,
            T.StructField("part", T.IntegerType()),
            T.StructField("nth", T.LongType()),
            T.StructField("run_id", T.LongType()),
            T.StructField("batch_id", T.LongType()),
            T.StructField("late", T.BooleanType()),
        ]
    )
    return spark.read.schema(fields).parquet(table)


def missing_numbers(rows: DataFrame) -> DataFrame:
    """Parts of a routed table that lack a number or have one twice: none, if no reading
    was lost or written twice."""
    return (
        rows.groupBy("run_id", "part", "late")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.max("nth").alias("last"),
            F.countDistinct("nth").alias("numbers"),
        )
        .where("rows <> last or numbers <> last")
    )
