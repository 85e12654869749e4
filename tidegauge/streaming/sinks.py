"""Replay-safe sinks: revision table and message topics (SNK-1, SNK-2, SNK-7, SNK-8)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.model import REVISION_FIELDS, MetricDef
from tidegauge.operators.latest import latest_revision
from tidegauge.session import folders_in, remove
from tidegauge.sources.revisions import read_compacted, read_revisions


#: Files that a batch writes for each UTC day of its windows, at most.
FILES_PER_DAY = 2


def run_identity(spark: SparkSession, checkpoint: str, table: str) -> int:
    """The run a checkpoint belongs to, made at its first use and kept beside it.

    A new checkpoint counts its batches from 0 again, so revisions are ordered by
    run first. A new run is one more than the largest that the table knows of; no clock
    has a part in it. A restart finds the same run and so overwrites the batch it
    repeats. The number is claimed beside the table before it is kept beside the
    checkpoint, so a driver lost in between only leaves a number unused.
    """
    home, claims = f"{checkpoint.rstrip('/')}-run", f"{table.rstrip('/')}-runs"

    def largest(path: str) -> int | None:
        try:
            return spark.read.schema("value long").csv(path).agg(F.max("value")).first()[0]
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    kept = largest(home)
    if kept is not None:
        return kept
    made = (largest(claims) or 0) + 1
    number = spark.range(made, made + 1, numPartitions=1)
    number.write.mode("append").csv(claims)
    number.write.mode("overwrite").csv(home)
    return made


def publish(
    records: DataFrame,
    fmt: str,
    path: str | None = None,
    options: Mapping[str, str] | None = None,
    mode: str = "append",
) -> None:
    """Each row as one JSON message, written by the executors (SNK-2, FN-2).

    ``fmt`` is any Spark sink with a ``value`` column: a bus connector or ``text``. A
    bus only appends, so a repeated batch is sent again; its readers keep the last
    message per window. Files can be written per batch with ``mode="overwrite"``.
    """
    names = [F.col(c) for c in records.columns]
    messages = records.select(F.to_json(F.struct(*names)).alias("value"))
    writer = messages.write.format(fmt).options(**dict(options or {})).mode(mode)
    writer.save(path) if path else writer.save()


def dealt_by_day(dated: DataFrame, files: int, keys: Sequence[str]) -> DataFrame:
    """Rows dealt so that a write makes ``files`` files per ``window_date`` at most, and has
    as many tasks as there are days times files, up to the session's shuffle partitions.

    A day's rows go to ``files`` places by a hash of ``keys``; places of different days are
    different keys of the shuffle, so a catch-up over many days is written by many tasks.
    Adaptive execution is off inside a stream's batch and does not merge or split them.
    """
    place = F.pmod(F.xxhash64(*keys), F.lit(files))
    return dated.repartition("window_date", place)


def _laid_out(rows: DataFrame, files: int) -> DataFrame:
    dated = rows.withColumn("window_date", F.to_date("window_start"))
    return dealt_by_day(dated, files, ["site", "window_start"])


def revision_writer(
    table: str,
    metric: MetricDef,
    run_id: int,
    after: Callable[[DataFrame, int], None] | None = None,
    files: int = FILES_PER_DAY,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that stores the changed windows of a batch (SNK-1).

    The batch owns one directory, laid out by day, and overwrites it, so a repeated
    batch changes nothing and one that failed half-way is replaced. Executors write, at
    most ``files`` files for each day. An empty batch leaves an empty directory (SNK-7); errors
    end the query (SNK-8).

    ``after(stored, batch_id)`` gets the rows read back from the table, for instance
    to publish them; reading back spares a second run of the stateful plan.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        place = f"{table}/metric={metric.name}/run_id={run_id}/batch_id={batch_id}"
        site = F.col("site") if "site" in batch.columns else F.lit(None).cast("string")
        rows = batch.withColumns({"site": site, "computed_at": F.current_timestamp()})
        stored = _laid_out(rows.select(*REVISION_FIELDS.fieldNames()), files)
        stored.write.mode("overwrite").partitionBy("window_date").parquet(place)
        if after is not None:
            again = batch.sparkSession.read.schema(REVISION_FIELDS).parquet(place)
            after(again.withColumn("metric", F.lit(metric.name)), batch_id)

    return write


def compact_revisions(
    spark: SparkSession,
    table: str,
    compacted: str,
    metric: str,
    run_id: int,
    up_to_batch: int,
    files: int = FILES_PER_DAY,
) -> int:
    """Folds the batches of a metric up to one (earlier runs whole) into its compacted
    days, and returns the version written.

    Only days that these batches touch are read and written again: the last revision of
    each of their windows, from the batches and from the compacted past. Run and batch
    stay with each row. The result is a new version beside the old one, so a compaction
    that fails leaves nothing that readers would take, and one may run while streams write
    later batches. Afterwards :func:`retire_batches` and :func:`retire_versions` can remove
    what it replaced.
    """
    old = (F.col("run_id") < run_id) | (
        (F.col("run_id") == run_id) & (F.col("batch_id") <= up_to_batch)
    )
    live = read_revisions(spark, table, [metric]).filter(old)
    # Days between two compactions, from directory names alone.
    days = [r[0] for r in live.select("window_date").distinct().collect()]
    versions = [int(v.partition("=")[2]) for v in folders_in(spark, f"{compacted}/metric={metric}")]
    rows = live
    if versions:
        past = read_compacted(spark, compacted, [metric])
        rows = rows.unionByName(past.filter(F.col("window_date").isin(*days)))
    version = max(versions, default=0) + 1
    fields = [*REVISION_FIELDS.fieldNames(), "run_id", "batch_id"]
    last = latest_revision(rows.drop("window_date"))
    _laid_out(last.select(*fields), files).write.partitionBy("window_date").parquet(
        f"{compacted}/metric={metric}/version={version}"
    )
    return version


def retire_batches(
    spark: SparkSession, table: str, metric: str, run_id: int, up_to_batch: int
) -> int:
    """Removes the directories of batches that were compacted; returns how many.

    What a streaming table holds, and what a reader has to list, then grows with the
    time since the last compaction only.
    """
    gone = 0
    for run in folders_in(spark, f"{table}/metric={metric}"):
        number = int(run.partition("=")[2])
        for batch in folders_in(spark, f"{table}/metric={metric}/{run}"):
            if number < run_id or (number == run_id and int(batch.partition("=")[2]) <= up_to_batch):
                remove(spark, f"{table}/metric={metric}/{run}/{batch}")
                gone += 1
    return gone


def retire_versions(spark: SparkSession, compacted: str, metric: str) -> int:
    """Removes the days of older versions that a newer one has too; returns how many."""
    home = f"{compacted}/metric={metric}"
    seen: set[str] = set()
    gone = 0
    versions = sorted(folders_in(spark, home), key=lambda v: int(v.partition("=")[2]))
    for version in reversed(versions):
        days = [d for d in folders_in(spark, f"{home}/{version}") if d.startswith("window_date=")]
        for day in seen.intersection(days):
            remove(spark, f"{home}/{version}/{day}")
            gone += 1
        if seen.issuperset(days) and days:
            remove(spark, f"{home}/{version}")
        seen.update(days)
    return gone
