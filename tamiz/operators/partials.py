"""Mergeable summaries of groups: kept per group, recomputed where rows changed, merged into larger groups.

A summary of a value is its count, mean, sum of squared deviations (m2), minimum, maximum and sum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.runtime import null_safe_join

ROWS = "filas"
PARTS = ("n", "mean", "m2", "min", "max", "sum")


def part(value: str, name: str) -> str:
    return f"{value}_{name}"


def partials(df: DataFrame, by: Sequence[str], values: Sequence[str], further: Sequence[Column] = ()) -> DataFrame:
    """One row per group with the summaries of the values; NULL values do not count."""
    summaries = [F.count(F.lit(1)).alias(ROWS)]
    for v in values:
        count = F.count(v)
        wanted = (count, F.avg(v), F.var_pop(v) * count, F.min(v), F.max(v), F.sum(v))
        summaries += [w.alias(part(v, name)) for w, name in zip(wanted, PARTS)]
    return df.groupBy(*by).agg(*summaries, *further)


def merged(parts: DataFrame, by: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The summaries of larger groups, from those of their parts alone.

    Squared deviations are added around the mean of the whole group, which comes first, so nothing
    cancels out as in sums of squares.
    """
    whole = [F.sum(ROWS).alias(ROWS)]
    for v in values:
        count = F.col(part(v, "n"))
        whole += [
            F.sum(count).alias(part(v, "n")),
            (F.sum(count * F.col(part(v, "mean"))) / F.nullif(F.sum(count), F.lit(0))).alias(part(v, "mean")),
            F.min(part(v, "min")).alias(part(v, "min")),
            F.max(part(v, "max")).alias(part(v, "max")),
            F.sum(part(v, "sum")).alias(part(v, "sum")),
        ]
    totals = parts.groupBy(*by).agg(*whole)
    means = totals.select(*by, *[F.col(part(v, "mean")).alias(f"_whole_{v}") for v in values])
    spread = []
    for v in values:
        off = F.col(part(v, "mean")) - F.col(f"_whole_{v}")
        spread.append(F.sum(F.col(part(v, "m2")) + F.col(part(v, "n")) * off * off).alias(part(v, "m2")))
    around = null_safe_join(parts, means, by).groupBy(*by).agg(*spread)
    order = [ROWS, *[part(v, name) for v in values for name in PARTS]]
    return null_safe_join(totals, around, by).select(*by, *order)


def moments(summaries: DataFrame, by: Sequence[str], value: str, mean: str, std: str) -> DataFrame:
    """Mean and population deviation of a summarised value."""
    variance = F.col(part(value, "m2")) / F.nullif(F.col(part(value, "n")), F.lit(0))
    return summaries.select(*by, F.col(part(value, "mean")).alias(mean), F.sqrt(variance).alias(std))
