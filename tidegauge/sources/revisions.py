"""Reading the metric revision table (SRC-3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidegauge.model import COMPACTED_SCHEMA, REVISION_SCHEMA


def read_revisions(spark: SparkSession, path: str, metrics: Sequence[str] = ()) -> DataFrame:
    """Every revision written so far, of some metrics or of all.

    Naming ``metrics`` spares even the listing of the other metrics' directories; a
    filter on ``metric`` prunes them when files are read.
    """
    reader = spark.read.schema(REVISION_SCHEMA).option("basePath", path)
    return reader.parquet(*[f"{path}/metric={m}" for m in metrics] or [path])


def read_compacted(spark: SparkSession, path: str, metrics: Sequence[str] = ()) -> DataFrame:
    """The compacted past, of some metrics or of all; a day may be there in two versions
    until the older is retired, which views do not see as they take the last revision."""
    reader = spark.read.schema(COMPACTED_SCHEMA).option("basePath", path)
    rows = reader.parquet(*[f"{path}/metric={m}" for m in metrics] or [path])
    return rows.select(*REVISION_SCHEMA.fieldNames())


def read_with_compacted(spark: SparkSession, path: str, compacted: str) -> DataFrame:
    """Revisions of the streaming table and of its compacted past.

    They may overlap, since views take the last revision of each window. So batches
    that were compacted can be retired from the streaming table at any later time.
    """
    return read_compacted(spark, compacted).unionByName(read_revisions(spark, path))


def stream_revisions(spark: SparkSession, path: str) -> DataFrame:
    """The same table read incrementally.

    Each reader keeps its position in its own checkpoint, so reading neither
    consumes anything nor disturbs the writer. A batch that the writer repeated is new
    files and comes again, with the same run and batch: the latest view is the same.
    """
    return spark.readStream.schema(REVISION_SCHEMA).parquet(path)
