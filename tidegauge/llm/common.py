"""What several operators share: white space, scratch tables, connected components."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.session import remove, shared_folder

#: The six ASCII white-space characters that part words: \x20 and \x09-\x0D.
WHITE = " \t\n\x0b\x0c\r"
WHITE_RUN = "[ \\t\\n\\x0B\\f\\r]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """The words of a text as an array; null and blank texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, WHITE_RUN)
    )


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def written(df: DataFrame, purpose: str, compression: str = "snappy") -> DataFrame:
    """``df`` as a table in the shared folder: later jobs read it, lost executors
    cost no recomputation beyond it."""
    return _written_at(df, purpose, compression)[0]


def _written_at(df: DataFrame, purpose: str, compression: str = "snappy") -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def settle(spark: SparkSession) -> None:
    """Has the driver give up what finished jobs have left in it: plans, task metrics, broadcast
    tables, and with these the shuffle files on executors. For operators of many small jobs, which
    else let its heap grow to the limit, whatever the size of their data."""
    gc.collect()
    spark._jvm.System.gc()


def connected_components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """Smallest reachable node for every node of ``edges`` (``a``, ``b``: long).

    Alternating large-star and small-star steps: every step is one grouping with a
    partial minimum and one join on nodes, so a hub with very many links is summed
    before the shuffle and its join is one that can be split. Ends when a round
    changes no link, after about log2 of the longest chain rounds. Each round is a
    written table that takes the place of the one before. Self links, repeated links and either direction are fine; an empty
    input gives an empty result. Returns ``node``, ``component``; every node of an edge
    occurs once.
    """
    given = written(
        edges.where("a is not null and b is not null")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        purpose,
    )
    links, folder, number = given, None, None
    while True:
        both = links.where("a <> b")
        # Large star: each node sends its larger neighbours to its smallest one.
        around = both.union(both.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = around.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m")
        )
        large = (
            around.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        large = large.where("a <> b").distinct()
        # Small star: each node joins its smaller neighbours and itself to the smallest.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b")
            .union(low.select("a", F.col("m").alias("b")))
            .distinct()
        )
        after, its_folder = _written_at(small, purpose)
        its_number = after.count()
        # No link repeats in a round: as many as before and none of them new is the same set.
        done = its_number == number and after.join(links, ["a", "b"], "left_anti").isEmpty()
        if folder is not None:
            remove(edges.sparkSession, folder)
        settle(edges.sparkSession)
        links, folder, number = after, its_folder, its_number
        if done:
            break
    every = given.select(F.col("a").alias("node")).union(given.select("b")).distinct()
    roots = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    return every.join(roots, "node", "left").select(
        "node", F.coalesce("component", "node").alias("component")
    )


def runs(batches: Iterator[pa.RecordBatch], key: str = "bucket") -> Iterator[pa.Table]:
    """The rows of each key that has two rows or more, from batches sorted by ``key``.

    Keys of one row, the great majority in candidate tables, are passed over without a
    loop. One run is held at a time.
    """
    held: list[pa.RecordBatch] = []  # the last run so far, of one key
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        begin = np.concatenate([[0], cuts])
        end = np.concatenate([cuts, [len(keys)]])
        if held and held[0].column(key)[0].as_py() != keys[0]:
            yield from _run(held)
            held = []
        if held:
            held.append(batch.slice(0, end[0]))
            if len(begin) == 1:
                continue
            yield from _run(held)
            begin, end = begin[1:], end[1:]
        several = np.flatnonzero((end - begin)[:-1] > 1)
        for a, b in zip(begin[several].tolist(), end[several].tolist(), strict=True):
            yield pa.Table.from_batches([batch.slice(a, b - a)])
        held = [batch.slice(begin[-1], end[-1] - begin[-1])]
    yield from _run(held)


def _run(held: list[pa.RecordBatch]) -> Iterator[pa.Table]:
    whole = pa.Table.from_batches(held) if held else None
    if whole is not None and whole.num_rows > 1:
        yield whole


def grouped(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest index that each of ``n`` points reaches over the links a-b."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while True:
            far = new[new]
            if (far == new).all():
                break
            new = far
        if (new == root).all():
            return root
        root = new


def with_row_ids(docs: DataFrame, purpose: str) -> DataFrame:
    """``docs`` as a written table with ``_row``, a number of its own for each row, which
    stands for the row whether or not its other columns are null or repeated."""
    return written(docs.withColumn("_row", F.monotonically_increasing_id()), purpose)
