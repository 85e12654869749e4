"""Ranks over a whole table, without putting it into one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RANKS = ("rank", "dense_rank", "percent_rank", "cume_dist")


def global_ranks(
    df: DataFrame,
    order: Sequence[str],
    store: Callable[[DataFrame], DataFrame],
    tiles: int | None = None,
    descending: bool = False,
) -> DataFrame:
    """Adds ``rank``, ``dense_rank``, ``percent_rank``, ``cume_dist`` and, with ``tiles``,
    ``ntile`` of each row by ``order`` over the whole table; nulls come first (last when
    ``descending``). Equal rows share their ranks, and their tile: that of the first of them.

    Two passes. Rows first shrink to their distinct order values with counts, in each task
    before the shuffle, so a value that a third of all rows share is one row. These are dealt
    by ranges, which ``store`` writes as a table and reads again: a lost executor must not
    deal them anew. A window sorts within each range, the counts of the ranges before it are
    added, one number per range, and the ranks go back to the rows by the order values.
    """
    values = df.groupBy(*order).agg(F.count(F.lit(1)).alias("_n"))
    by = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    dealt = store(values.repartitionByRange(*by).withColumn("_range", F.spark_partition_id()))
    sizes = dealt.groupBy("_range").agg(F.sum("_n").alias("_rows"), F.count(F.lit(1)).alias("_values"))
    # Two numbers for each range, of which there are as many as shuffle partitions.
    begun, rows, values_ = [], 0, 0
    for size in sorted(sizes.collect(), key=lambda r: r["_range"]):
        begun.append((size["_range"], rows, values_))
        rows, values_ = rows + size["_rows"], values_ + size["_values"]
    starts = df.sparkSession.createDataFrame(
        begun, "_range int, _rows_before long, _values_before long"
    ).withColumn("_all", F.lit(rows).cast("long"))
    inside = Window.partitionBy("_range").orderBy(*by)
    ahead = F.coalesce(F.sum("_n").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = dealt.withColumns({"_ahead": ahead, "_nth": F.row_number().over(inside)}).join(starts, "_range")
    rank = F.col("_rows_before") + F.col("_ahead") + 1
    found = placed.select(
        *order,
        rank.alias("rank"),
        (F.col("_values_before") + F.col("_nth")).alias("dense_rank"),
        F.when(F.col("_all") > 1, (rank - 1) / (F.col("_all") - 1)).otherwise(F.lit(0.0)).alias("percent_rank"),
        ((rank - 1 + F.col("_n")) / F.col("_all")).alias("cume_dist"),
        *([] if tiles is None else [_tile(rank, F.col("_all"), tiles).alias("ntile")]),
    )
    names = {c: f"_by_{i}" for i, c in enumerate(order)}
    found = found.withColumnsRenamed(names)
    same = F.lit(True)
    for c, other in names.items():
        same = same & F.col(c).eqNullSafe(F.col(other))
    return df.join(found, same).drop(*names.values())


def _tile(row, rows, tiles: int):
    """The bucket of a row number: the first ``rows % tiles`` buckets have one row more."""
    size, more = F.floor(rows / tiles), rows % tiles
    large = more * (size + 1)
    # With fewer rows than tiles each row is a tile of its own.
    behind = more + F.ceil((row - large) / F.greatest(size, F.lit(1)))
    return F.when(row <= large, F.ceil(row / (size + 1))).otherwise(behind).cast("int")
