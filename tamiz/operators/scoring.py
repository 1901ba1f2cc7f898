"""Min-max normalisation, opportunity scores and quantile colour classes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.fixed_values import RAMP_COLOURS
from tamiz.operators.quantiles import exact_quantiles

RAMP_POINTS = (0.0, 0.25, 0.5, 0.75, 1.0)
# Colour maps commonly turn a 0..1 channel into 0..255 by truncating at this factor.
CHANNEL_SCALE = 255.9999


def min_max(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Scale each column to 0..1 over the whole set; a constant column gives 0.

    The extremes of all columns come from one aggregate, read as a scalar subquery.
    """
    ends = [
        f(source).alias(f"{source}_{name}")
        for source in columns
        for name, f in (("low", F.min), ("high", F.max))
    ]
    extremes = df.agg(F.struct(*ends).alias("ends")).scalar()
    scaled = {}
    for source, target in columns.items():
        low, high = F.col(f"_ends.{source}_low"), F.col(f"_ends.{source}_high")
        scaled[target] = F.when(high == low, F.col(source) * 0.0).otherwise(
            (F.col(source) - low) / F.nullif(high - low, F.lit(0.0))
        )
    return df.withColumn("_ends", extremes).withColumns(scaled).drop("_ends")


def opportunity_index(income_scaled: Column, density_scaled: Column) -> Column:
    return income_scaled * (1 - density_scaled) * 100


def column_profile(df: DataFrame, column: str) -> DataFrame:
    """Minimum, maximum, sum and mean of a column."""
    return df.agg(
        F.min(column).alias("min"),
        F.max(column).alias("max"),
        F.sum(column).alias("sum"),
        F.avg(column).alias("mean"),
    )


def class_breaks(df: DataFrame, column: str, step: float = 1e-6, **options) -> DataFrame:
    """One row with quantile breaks, forced strictly increasing by `step`."""
    quantiles = exact_quantiles(df, [], column, RAMP_POINTS, "q", **options)

    def bump(done: Column, value: Column) -> Column:
        last = F.element_at(done, -1)
        return F.concat(done, F.array(F.when(value <= last, last + F.lit(step)).otherwise(value)))

    rest = F.slice("q", 2, len(RAMP_POINTS) - 1)
    return quantiles.select(F.aggregate(rest, F.slice("q", 1, 1), bump).alias("breaks"), "n")


def ramp_colour(value: Column, breaks: Column, colours: Sequence[str] = RAMP_COLOURS) -> Column:
    """Colour '#rrggbb' interpolated linearly between the breaks, clamped at both ends."""
    channels = [[int(c[i : i + 2], 16) for i in (1, 3, 5)] for c in colours]

    def channel(i: int) -> Column:
        steps = [F.when(value <= breaks[0], F.lit(float(channels[0][i])))]
        for k in range(1, len(colours)):
            low, high = breaks[k - 1], breaks[k]
            a, b = float(channels[k - 1][i]), float(channels[k][i])
            share = F.try_divide(value - low, high - low)
            steps.append(F.when(value <= high, (1 - share) * a + share * b))
        level = F.coalesce(*steps, F.lit(float(channels[-1][i])))
        return F.lower(F.lpad(F.hex(F.floor(level / 255 * CHANNEL_SCALE)), 2, "0"))

    colour = F.concat(F.lit("#"), channel(0), channel(1), channel(2))
    return F.when(value.isNotNull(), colour)


def break_class(value: Column, breaks: Column, classes: int = 4) -> Column:
    """Class 1..classes of a value between the breaks (the first class is closed below)."""
    above = [F.when(value > breaks[k], 1).otherwise(0) for k in range(1, classes)]
    return F.when(value.isNotNull(), sum(above, F.lit(1)))
