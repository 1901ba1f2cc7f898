"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key in `order` (pass descending columns and a tie-break).

    The rank filter is pushed below the shuffle as a group limit, so each task sends
    one row per key however hot the key is.
    """
    ranked = df.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def newest_first(*names: str) -> list[Column]:
    return [F.col(name).desc_nulls_last() for name in names]
