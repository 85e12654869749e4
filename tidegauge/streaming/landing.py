"""Landing telemetry as Parquet, decoded once for every metric and backfill."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidegauge.model import TRIGGER_S
from tidegauge.sources.telemetry import reject_reason
from tidegauge.streaming.runner import _trigger

USABLE = "usable"
LANDED_SCHEMA = T.StructType(
    [
        T.StructField("device_id", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("payload", T.StringType()),
        T.StructField("quality", T.StringType()),
        T.StructField("event_date", T.DateType()),
    ]
)


def land_telemetry(
    decoded: DataFrame,
    path: str,
    checkpoint: str,
    available_now: bool = False,
    trigger_s: int = TRIGGER_S,
) -> StreamingQuery:
    """Appends decoded telemetry to a table laid out by quality and day (EXT-2).

    Usable rows drop their payload; rejects keep it, under the reason for which
    they were rejected. One pass serves both, and the file sink's log makes each
    batch visible exactly once.
    """
    judged = reject_reason(decoded)
    usable = F.col("reject_reason").isNull()
    rows = judged.select(
        "device_id",
        "value",
        "event_time",
        F.when(~usable, F.col("payload")).alias("payload"),
        F.when(usable, F.lit(USABLE)).otherwise(F.col("reject_reason")).alias("quality"),
        F.to_date("event_time").alias("event_date"),
    )
    return (
        rows.writeStream.format("parquet")
        .partitionBy("quality", "event_date")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**_trigger(available_now, trigger_s))
        .start()
    )


def read_landed(
    spark: SparkSession,
    path: str,
    quality: str = USABLE,
    first_day: str | None = None,
    last_day: str | None = None,
) -> DataFrame:
    """Landed rows of one quality, of some days or all; the filters prune directories."""
    rows = spark.read.schema(LANDED_SCHEMA).parquet(path).filter(F.col("quality") == quality)
    if first_day is not None:
        rows = rows.filter(F.col("event_date") >= F.lit(first_day).cast("date"))
    if last_day is not None:
        rows = rows.filter(F.col("event_date") <= F.lit(last_day).cast("date"))
    return rows
