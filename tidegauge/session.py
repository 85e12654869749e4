"""Sessions and the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# State in executors' memory: for a few numbers per partition, for which stores on disk,
# some megabytes each, would be out of proportion.
SMALL_STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    ),
}
# State off the heap, of which a batch uploads only the changes.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def engine_session(app: str = "tidegauge", **conf: str) -> SparkSession:
    """A session with the settings the engine relies on; ``conf`` overrides them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.scheduler.mode": "FAIR",
        "spark.ui.enabled": "false",
        **STATE_SETTINGS,
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _sibling(spark: SparkSession, **changes: str) -> SparkSession:
    """A session beside ``spark`` with its runtime settings, but for ``changes``."""
    sibling = spark.newSession()
    for key, value in {**spark.conf.getAll, **changes}.items():
        if sibling.conf.isModifiable(key):
            sibling.conf.set(key, value)
    return sibling


def utc(spark: SparkSession) -> SparkSession:
    """``spark`` itself if it runs on UTC, else a sibling session that does.

    Readings without an offset are taken as UTC and windows are aligned to the
    UTC epoch, so no engine query may run under another zone.
    """
    if spark.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC", "Z"):
        return spark
    return _sibling(spark, **{"spark.sql.session.timeZone": "UTC"})


def stream_session(
    spark: SparkSession, partitions: int | None = None, small_state: bool = False
) -> SparkSession:
    """A UTC sibling session whose streaming state lives in RocksDB, or in memory if it is
    a ``small_state`` (of :func:`tidegauge.streaming.start_routed`: two counts a part).

    The state has ``partitions`` parts, or as many as the session's
    ``spark.sql.shuffle.partitions`` says: each is a store of its own that every batch
    opens, so a stream does best with fewer than batch shuffles. A checkpoint keeps the
    number it began with, so it is never taken from the cores of the moment. The
    caller's own settings stay as they are.
    """
    partitions = partitions or spark.conf.get("spark.sql.shuffle.partitions")
    return _sibling(
        spark,
        **{
            "spark.sql.session.timeZone": "UTC",
            "spark.sql.shuffle.partitions": str(partitions),
            **(SMALL_STATE_SETTINGS if small_state else STATE_SETTINGS),
        },
    )


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the cluster's ``spark.checkpoint.dir``, or below the warehouse
    where that is not set: both are shared by the driver and all executors."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.sql.warehouse.dir"
    )
    return f"{base.rstrip('/')}/tidegauge/{purpose}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Removes a folder of any store that Spark reads; one that is not there is no error."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def folders_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly in ``path``; none if it is not there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(place):
        return []
    return sorted(s.getPath().getName() for s in store.listStatus(place) if s.isDirectory())
