"""Exact medians and linearly interpolated quantiles, also for very large groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamiz.runtime import checkpoint, join_side, null_safe_join, small_side

# Up to this many rows per group the built-in `percentile` is used. It buffers the distinct
# values of a group, and a task may hold over a hundred groups at a time.
BUFFERED_ROWS = 100_000
BINS = 1024
MAX_PASSES = 8


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    out: str = "quantiles",
    buffered_rows: int = BUFFERED_ROWS,
    bins: int = BINS,
) -> DataFrame:
    """One row per group with an array of exact quantiles, plus `n` non-null values.

    Larger groups are answered by narrowing down: each pass counts values in bins (only
    counts are shuffled) and keeps the bin that holds the wanted rank, until that bin
    is small enough to sort. No group is ever gathered in one task.
    """
    keys = list(keys)
    number = F.col(value).cast("double")
    data = df.select(*keys, number.alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    shape = data.groupBy(*keys).agg(
        F.count("_v").alias("n"), F.min("_v").alias("_low"), F.max("_v").alias("_high")
    )

    def buffered(rows: DataFrame) -> DataFrame:
        quantiles = F.percentile("_v", list(probabilities))
        return rows.groupBy(*keys).agg(quantiles.alias(out), F.count("_v").alias("n"))

    largest = shape.agg(F.max("n")).first()[0]
    if largest is None or largest <= buffered_rows:
        return buffered(data)
    large = checkpoint(shape.filter(F.col("n") > buffered_rows))
    narrowed = _narrowed(data, keys, large, probabilities, out, buffered_rows, bins)
    if not keys:
        return narrowed
    others = null_safe_join(data, small_side(large.select(*keys)), keys, "left_anti")
    return buffered(others).unionByName(narrowed)


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows in the largest group: one map-side combined count."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.max("n")).first()[0] or 0


def exact_median(df: DataFrame, keys: Sequence[str], value: str, out: str, **options) -> DataFrame:
    found = exact_quantiles(df, keys, value, [0.5], "_q", **options)
    return found.select(*keys, F.col("_q")[0].alias(out), "n")


def _narrowed(data, keys, shape, probabilities, out, buffered_rows, bins) -> DataFrame:
    positions = F.array(*[F.lit(float(p)) * (F.col("n") - 1) for p in probabilities])
    shape = shape.withColumn("_positions", positions)
    ranks = F.array_distinct(
        F.concat(
            F.transform("_positions", lambda p: F.floor(p)),
            F.transform("_positions", lambda p: F.ceil(p)),
        )
    )
    # One target per group and rank: the value lies in [_low, _high], `_below` values precede.
    targets = shape.select(
        *keys, F.explode(ranks).alias("_rank"), "_low", "_high", F.lit(0).cast("long").alias("_below")
    )
    interval = [*keys, "_low", "_high"]
    solved = None
    for _ in range(MAX_PASSES):
        hits = _inside(data, keys, targets, interval)
        width = F.col("_high") - F.col("_low")
        slot = F.least(
            F.floor(F.try_divide(F.col("_v") - F.col("_low"), width) * bins), F.lit(bins - 1)
        )
        counted = hits.groupBy(*interval, F.coalesce(slot, F.lit(0)).alias("_slot")).agg(
            F.count("_v").alias("_n"), F.min("_v").alias("_first"), F.max("_v").alias("_last")
        )
        upto = F.sum("_n").over(Window.partitionBy(*interval).orderBy("_slot")) - F.col("_n")
        counted = counted.withColumn("_before", upto)
        located = null_safe_join(targets, counted, interval).filter(
            (F.col("_rank") >= F.col("_below") + F.col("_before"))
            & (F.col("_rank") < F.col("_below") + F.col("_before") + F.col("_n"))
        )
        located = checkpoint(
            located.select(
                *keys,
                "_rank",
                F.col("_first").alias("_low"),
                F.col("_last").alias("_high"),
                (F.col("_below") + F.col("_before")).alias("_below"),
                "_n",
            )
        )
        done = located.filter("_low = _high").select(*keys, "_rank", F.col("_low").alias("_v"))
        solved = done if solved is None else solved.unionByName(done)
        targets = located.filter("_low < _high")
        largest = targets.agg(F.max("_n")).first()[0]
        targets = targets.drop("_n")
        if largest is None or largest <= buffered_rows:
            break
    if largest is not None:
        solved = solved.unionByName(_sorted_lookup(data, keys, targets, interval))
    return _interpolated(shape, keys, checkpoint(solved), out)


def _inside(data, keys, targets, interval) -> DataFrame:
    """Values that fall into one of their group's open intervals."""
    intervals = targets.select(*interval).distinct()
    if keys:
        near = null_safe_join(data, join_side(intervals), keys)
        return near.filter(F.col("_v").between(F.col("_low"), F.col("_high")))
    # Without keys there are at most two intervals per probability.
    listed = F.array(
        *[
            F.struct(F.lit(row["_low"]).alias("_low"), F.lit(row["_high"]).alias("_high"))
            for row in intervals.collect()
        ]
    )
    holding = F.filter(listed, lambda i: F.col("_v").between(i["_low"], i["_high"]))
    return data.select("_v", F.inline(holding))


def _sorted_lookup(data, keys, targets, interval) -> DataFrame:
    """Rank values inside the final intervals; equal values are combined before sorting."""
    counted = _inside(data, keys, targets, interval).groupBy(*interval, "_v").agg(
        F.count(F.lit(1)).alias("_n")
    )
    upto = F.sum("_n").over(Window.partitionBy(*interval).orderBy("_v"))
    counted = counted.withColumn("_upto", upto)
    return (
        null_safe_join(targets, counted, interval)
        .filter(
            (F.col("_rank") >= F.col("_below") + F.col("_upto") - F.col("_n"))
            & (F.col("_rank") < F.col("_below") + F.col("_upto"))
        )
        .select(*keys, "_rank", "_v")
    )


def _interpolated(shape, keys, solved, out) -> DataFrame:
    # At most two entries per probability and group.
    found = solved.groupBy(*keys).agg(
        F.map_from_entries(F.collect_set(F.struct("_rank", "_v"))).alias("_values")
    )

    def between(position: Column) -> Column:
        low = F.try_element_at("_values", F.floor(position))
        high = F.try_element_at("_values", F.ceil(position))
        return low + (high - low) * (position - F.floor(position))

    joined = (
        null_safe_join(shape, found, keys)
        if keys
        else shape.withColumn("_values", found.select("_values").scalar())
    )
    return joined.select(*keys, F.transform("_positions", between).alias(out), "n")
