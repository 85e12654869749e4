"""Conflict-constrained best-fit packing of documents into sequences.

Open bins are kept in the order of their residual space and carry a bitmap of the
sources and duplicate clusters that they hold. A piece goes to the tightest bin that it
fits and shares no bit with: the search starts at the first bin with space enough and
moves on to roomier ones until one is compatible, else a new bin is opened.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import with_row_ids, words_of

CAPACITY = 2048
#: Pieces that are packed together, about. Shards are dealt by a hash of the row, so they
#: are alike in size and mix whatever the sources and clusters are.
SHARD_PIECES = 2048


def best_fit(sizes: list[int], marks: list[int], capacity: int) -> list[tuple[int, int]]:
    """For each piece, in the given order, its bin and where in the bin it begins.

    ``marks`` are bitmaps; two pieces with a common bit are never in one bin."""
    open_bins: list[tuple[int, int]] = []  # (residual, bin), ascending
    held: list[int] = []
    out = []
    for size, mark in zip(sizes, marks, strict=True):
        at = bisect_left(open_bins, (size, -1))
        while at < len(open_bins) and held[open_bins[at][1]] & mark:
            at += 1
        if at < len(open_bins):
            residual, bin_ = open_bins.pop(at)
        else:
            residual, bin_ = capacity, len(held)
            held.append(0)
        out.append((bin_, capacity - residual))
        held[bin_] |= mark
        if residual > size:
            insort(open_bins, (residual - size, bin_))
    return out


def _bits(values: list, first: int) -> tuple[list[int], int]:
    """A bit from ``first`` on for every value that occurs twice or more; null has none."""
    count: dict = {}
    for v in values:
        count[v] = count.get(v, 0) + 1
    place = {v: first + k for k, v in enumerate(v for v, n in count.items() if v is not None and n > 1)}
    return [1 << place[v] if v in place else 0 for v in values], first + len(place)


def pack(
    items: DataFrame,
    id: str = "doc_id",
    length: str = "n_tokens",
    source: str = "source",
    cluster: str = "cluster",
    capacity: int = CAPACITY,
) -> DataFrame:
    """A row per piece: ``id``, ``piece``, ``start`` and ``n_tokens`` (its span of the
    document), ``bin_id`` and ``bin_start``.

    A document longer than ``capacity`` is cut into full pieces, each a bin of its own,
    and a rest. Rests and shorter documents are packed by best fit in descending size
    (ties by row); no bin holds two pieces of one source or of one duplicate cluster. A null source or
    cluster conflicts with nothing. A document without tokens is one piece of length 0 without a bin (null
    ``bin_id`` and ``bin_start``); a null length counts as 0. Repeated rows are packed each; an empty table
    gives an empty result.
    """
    rows = with_row_ids(
        items.select(
            F.col(id).alias("id"),
            F.greatest(F.coalesce(F.col(length).cast("long"), F.lit(0)), F.lit(0)).alias("size"),
            F.col(source).alias("source"),
            F.col(cluster).alias("cluster"),
        ),
        "packing-rows",
    )
    kind = dict(rows.dtypes)["id"]
    rest = F.pmod(F.col("size"), F.lit(capacity))
    whole = ((F.col("size") - rest) / capacity).cast("long")
    full = rows.where(whole > 0).select(
        "id",
        F.explode(F.sequence(F.lit(0).cast("long"), whole - 1)).alias("piece"),
        F.lit(capacity).cast("long").alias("n_tokens"),
        "_row",
    )
    full = full.select(
        "id",
        "piece",
        (F.col("piece") * capacity).alias("start"),
        "n_tokens",
        F.concat(F.lit("d"), "_row", F.lit("-"), "piece").alias("bin_id"),
        F.lit(0).cast("long").alias("bin_start"),
    )
    empty = rows.where("size = 0").select(
        "id",
        F.lit(0).cast("long").alias("piece"),
        F.lit(0).cast("long").alias("start"),
        F.lit(0).cast("long").alias("n_tokens"),
        F.lit(None).cast("string").alias("bin_id"),
        F.lit(None).cast("long").alias("bin_start"),
    )
    shards = max(1, -(-rows.count() // SHARD_PIECES))
    short = rows.where(rest > 0).select(
        "id",
        whole.alias("piece"),
        (whole * capacity).alias("start"),
        rest.alias("n_tokens"),
        "source",
        "cluster",
        "_row",
        F.pmod(F.xxhash64("_row"), F.lit(shards)).alias("shard"),
    )

    def fill(shard: pa.Table) -> pa.Table:
        sizes = shard.column("n_tokens").to_numpy()
        order = np.lexsort((shard.column("_row").to_numpy(), -sizes))
        shard = shard.take(pa.array(order))
        sources, used = _bits(shard.column("source").to_pylist(), 0)
        clusters, _ = _bits(shard.column("cluster").to_pylist(), used)
        marks = [a | b for a, b in zip(sources, clusters, strict=True)]
        places = best_fit(sizes[order].tolist(), marks, capacity)
        number = shard.column("shard")[0].as_py()
        return pa.table(
            {
                "id": shard.column("id"),
                "piece": shard.column("piece"),
                "start": shard.column("start"),
                "n_tokens": shard.column("n_tokens"),
                "bin_id": pa.array([f"s{number}-{b}" for b, _ in places]),
                "bin_start": pa.array([p for _, p in places], pa.int64()),
            }
        )

    packed = short.groupBy("shard").applyInArrow(
        fill, f"id {kind}, piece long, start long, n_tokens long, bin_id string, bin_start long"
    )
    return full.union(packed).union(empty).withColumnRenamed("id", id)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pack`` for a table of documents: a token is a word, and a duplicate cluster is all
    documents whose words are the same but for upper and lower case."""
    words = words_of(F.col("text"))
    measured = docs.select("doc_id", "source", words.alias("words")).select(
        "doc_id",
        "source",
        F.size("words").alias("n_tokens"),
        F.xxhash64(F.lower(F.array_join("words", " "))).alias("cluster"),
    )
    return pack(measured, capacity=capacity)
