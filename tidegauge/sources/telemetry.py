"""Telemetry sources: scan, decode, event time, rejects (SRC-1 … SRC-4, SRC-6)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions import parse_iso
from tidegauge.model import ENVELOPE_SCHEMA


def read_stream(
    spark: SparkSession,
    fmt: str,
    path: str | None = None,
    schema: T.StructType | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Unbounded scan of any source Spark knows by name (SRC-1, SRC-6).

    A message bus is its connector's format name plus options (service address,
    topic, starting position — SRC-4); files are ``text``, ``json`` or ``parquet``.
    """
    reader = spark.readStream.format(fmt).options(**dict(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def read_table(
    spark: SparkSession,
    fmt: str,
    path: str | None = None,
    schema: T.StructType | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """The batch twin of :func:`read_stream`, for backfill."""
    reader = spark.read.format(fmt).options(**dict(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def arrived_after(df: DataFrame, arrival: str, position) -> DataFrame:
    """Only what arrived after a position: a reader that starts at *latest* (SRC-4)."""
    return df.filter(F.col(arrival) > position)


def decode(df: DataFrame, payload: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Payload bytes to typed columns (SRC-2, PRJ-1, PRJ-2, FN-1 … FN-3).

    Never fails on a row: what cannot be decoded is null. The payload text stays
    in ``payload`` for :func:`reject_reason`; an unused column costs nothing, as
    Catalyst prunes it.
    """
    text = F.col(payload).cast("string")
    return df.select(
        *keep,
        text.alias("payload"),
        F.from_json(text, ENVELOPE_SCHEMA).alias("data"),
    ).select(
        *keep,
        "payload",
        "data.device_id",
        "data.value",
        parse_iso(F.col("data.timestamp")).alias("event_time"),
    )


def reject_reason(df: DataFrame) -> DataFrame:
    """Adds ``reject_reason`` to decoded rows; null means usable (EXT-2)."""
    no_field = (
        F.col("device_id").isNull() & F.col("value").isNull() & F.col("event_time").isNull()
    )
    return df.withColumn(
        "reject_reason",
        F.when(no_field, "malformed")
        .when(F.col("device_id").isNull() | (F.col("device_id") == ""), "no device")
        .when(F.col("event_time").isNull(), "no event time")
        .when(F.col("value").isNull(), "no value")
        .when(F.isnan("value"), "not a number"),
    )


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable telemetry, rejects with their payload and reason) (EXT-2)."""
    judged = reject_reason(df)
    good = judged.filter(F.col("reject_reason").isNull()).drop("reject_reason", "payload")
    return good, judged.filter(F.col("reject_reason").isNotNull())


def to_telemetry(
    df: DataFrame,
    device: str | Column,
    value: str | Column,
    event_time: str | Column,
    *extra: str | Column,
) -> DataFrame:
    """Any stored table in telemetry shape (PRJ-3)."""

    def column(c: str | Column) -> Column:
        return F.col(c) if isinstance(c, str) else c

    return df.select(
        column(device).alias("device_id"),
        column(value).alias("value"),
        column(event_time).alias("event_time"),
        *extra,
    )
