"""Global positions 1..n and stable surrogate keys without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamiz.runtime import checkpoint

OFFSET_BITS = 33


def number_rows(
    df: DataFrame, order: Sequence[Column | str], out: str = "position", start: int | Column = 1
) -> DataFrame:
    """Consecutive numbers in `order` (which should decide every tie).

    Rows are range-partitioned, sorted, marked with partition and offset, and staged;
    the sizes of the earlier partitions then shift each offset. One shuffle in all.
    """
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(slices, *order).sortWithinPartitions(*order)
    # The id holds the partition in its upper and the offset in its lower 33 bits.
    staged = checkpoint(ranged.withColumn("_id", F.monotonically_increasing_id()))
    located = staged.withColumn("_slice", F.shiftright("_id", OFFSET_BITS))
    sizes = located.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition, so this window is as small as the shuffle is wide.
    before = F.sum("_n").over(Window.orderBy("_slice")) - F.col("_n")
    shifts = sizes.select("_slice", before.alias("_shift"))
    offset = F.col("_id") - F.shiftleft("_slice", OFFSET_BITS)
    base = F.lit(start) if isinstance(start, int) else start
    return (
        located.join(F.broadcast(shifts), "_slice")
        .withColumn(out, (offset + F.col("_shift") + base).cast("long"))
        .drop("_slice", "_shift", "_id")
    )


def rank_positions(df: DataFrame, score: str, *ties: str, out: str = "position") -> DataFrame:
    """Ranking 1..n by score, highest first."""
    return number_rows(df, [F.col(score).desc_nulls_last(), *[F.col(t) for t in ties]], out)
