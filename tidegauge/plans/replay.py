"""Stored readings played to the streaming queries in arrival order."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegauge.session import remove
from tidegauge.sources import read_stream
from tidegauge.streaming import await_all


def replay(
    stored: DataFrame,
    arrival: str,
    cuts: Sequence[str],
    landing: str,
    start: Callable[[DataFrame], Iterable[StreamingQuery]],
    scratch: Sequence[str] = (),
) -> None:
    """Lands ``stored`` once, in slices, and lets the queries catch up after each.

    ``cuts`` are arrival times between the slices. ``start`` gets the stream over the
    slices so far and starts queries that end when they have caught up; from the second
    slice on they restart from their checkpoints, as a scheduled job would. Executors write
    all slices in one scan of what ``stored`` keeps. The landing folder and the folders of
    ``scratch`` (checkpoints) are removed at the end, whether or not it went well.
    """
    spark = stored.sparkSession
    passed = [(F.col(arrival) >= F.lit(c).cast("timestamp")).cast("int") for c in cuts]
    numbered = stored.withColumn("_slice", sum(passed, F.lit(0)))
    try:
        numbered.write.partitionBy("_slice").parquet(landing)
        for n in range(len(cuts) + 1):
            # Folders without rows were not written; a stream needs each named one.
            spark.createDataFrame([], stored.schema).write.mode("append").parquet(
                f"{landing}/_slice={n}"
            )
            names = ",".join(f"_slice={k}" for k in range(n + 1))
            stream = read_stream(spark, "parquet", f"{landing}/{{{names}}}", stored.schema)
            await_all(start(stream))
    finally:
        for folder in (landing, *scratch):
            remove(spark, folder)
