"""Daily summaries, row-based moving averages and z-scores over keyed series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamiz.runtime import checkpoint, join_side, null_safe_join, small_side

# A key with more rows than this is cut into stretches of time before windowing.
SERIES_ROWS_PER_TASK = 2_000_000


def daily_summary(
    df: DataFrame, key: str, time: str, level: str, total: str, mean: str, day: str = "fecha"
) -> DataFrame:
    """Per key and day: mean, minimum and maximum of `level`, sum of `total`, mean of `mean`."""
    return df.groupBy(key, F.to_date(time).alias(day)).agg(
        F.avg(level).alias("level_mean"),
        F.min(level).alias("level_min"),
        F.max(level).alias("level_max"),
        F.sum(total).alias("total_sum"),
        F.avg(mean).alias("mean_mean"),
    )


def moving_average(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    value: str,
    rows: int,
    out: str = "moving_average",
    max_rows: int = SERIES_ROWS_PER_TASK,
) -> DataFrame:
    """Mean of the current and the `rows - 1` preceding rows of the same key.

    The frame counts rows, not hours: gaps are not filled and early frames are short.
    `order` starts with a timestamp column and should end with a tie-break. Keys with
    more than `max_rows` rows are set apart and cut into stretches of time.
    """
    frame = Window.partitionBy(key).orderBy(*order).rowsBetween(1 - rows, 0)
    micros = _micros(df, order[0])
    sizes = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("_rows"), (F.max(micros) - F.min(micros)).alias("_span")
    )
    hot = checkpoint(sizes.filter(F.col("_rows") > max_rows))
    if hot.isEmpty():
        return df.withColumn(out, F.avg(value).over(frame))
    side = small_side(hot.select(key))
    long_series = null_safe_join(df, side, [key], "left_semi")
    others = null_safe_join(df, side, [key], "left_anti").withColumn(out, F.avg(value).over(frame))
    width = _stretch_seconds(long_series, hot, key, micros, max_rows)
    cut = _moving_average_cut(long_series, key, order, value, rows, out, width)
    return others.unionByName(cut)


def _micros(df: DataFrame, time: str) -> Column:
    """Microseconds that keep the order of the column whatever the session time zone."""
    value = F.col(time)
    if dict(df.dtypes)[time] == "timestamp_ntz":
        # Read as if in UTC: a zone with clock changes could reorder local times.
        parts = [F.extract(F.lit(p), value) for p in ("year", "month", "day", "hour", "minute")]
        value = F.make_timestamp_ltz(*parts, F.extract(F.lit("second"), value), F.lit("UTC"))
    return F.unix_micros(value.cast("timestamp"))


def _stretch(micros: Column, seconds: float) -> Column:
    return F.floor(micros / F.lit(max(int(seconds * 1_000_000), 1)))


def _stretch_seconds(
    long_series: DataFrame, hot: DataFrame, key: str, micros: Column, max_rows: int
) -> float:
    """A width at which no stretch of any of the series has more than `max_rows` rows.

    Rows of one key and one microsecond stay together; only there a stretch can be larger.
    """
    hottest = hot.agg(F.max(F.struct("_rows", "_span")).alias("m")).first()["m"]
    largest, width = hottest["_rows"], max(hottest["_span"], 1) / 1_000_000
    while largest > max_rows and width > 1e-6:
        width = max(width * max_rows / largest / 2, 1e-6)
        counts = long_series.groupBy(key, _stretch(micros, width).alias("s")).agg(
            F.count(F.lit(1)).alias("n")
        )
        largest = counts.agg(F.max("n")).first()[0]
    return width


def _moving_average_cut(
    df: DataFrame, key: str, order: Sequence[str], value: str, rows: int, out: str, width: float
) -> DataFrame:
    """Exact moving average with the work partitioned by (key, stretch of time).

    Inside a stretch every row from the `rows`-th on has its whole frame at hand. The
    frames of the first `rows - 1` rows reach back only into rows that are themselves
    among the first or last `rows - 1` of a stretch, so those boundary rows alone are
    windowed again per key.
    """
    stretch = Window.partitionBy(key, "_stretch")
    marked = (
        df.withColumn("_stretch", _stretch(_micros(df, order[0]), width))
        .withColumn("_ahead", F.row_number().over(stretch.orderBy(*order)))
        .withColumn("_size", F.count(F.lit(1)).over(stretch))
        .withColumn(out, F.avg(value).over(stretch.orderBy(*order).rowsBetween(1 - rows, 0)))
    )
    inner = marked.filter(F.col("_ahead") >= rows)
    boundary = marked.filter(
        (F.col("_ahead") < rows) | (F.col("_size") - F.col("_ahead") < rows - 1)
    )
    per_key = Window.partitionBy(key).orderBy(*order).rowsBetween(1 - rows, 0)
    heads = boundary.withColumn(out, F.avg(value).over(per_key)).filter(F.col("_ahead") < rows)
    return inner.unionByName(heads).drop("_stretch", "_ahead", "_size")


def zscore(df: DataFrame, key: str, value: str) -> DataFrame:
    """Deviation from the key's whole history in population standard deviations.

    Adds history_mean, history_std and z_score; a zero or missing deviation gives 0.
    The history is one aggregate per key, joined back (broadcast when counted small),
    so the rows themselves are not shuffled.
    """
    history = df.groupBy(key).agg(
        F.avg(value).alias("history_mean"), F.stddev_pop(value).alias("history_std")
    )
    return zscore_against(df, history, key, value)


def zscore_against(df: DataFrame, history: DataFrame, key: str, value: str) -> DataFrame:
    """The same against a history that is at hand: key, history_mean, history_std."""
    flat = F.col("history_std").isNull() | (F.col("history_std") == 0)
    score = (F.col(value) - F.col("history_mean")) / F.col("history_std")
    return df.join(join_side(history), key).withColumn("z_score", F.when(flat, 0.0).otherwise(score))


def zscore_selfcheck(scored: DataFrame, key: str, tolerance: float = 1e-6) -> DataFrame:
    """Per key: mean and deviation of the scores, and whether they are 0 and 1."""
    check = scored.groupBy(key).agg(
        F.avg("z_score").alias("z_mean"), F.stddev_pop("z_score").alias("z_std")
    )
    passed = (F.abs("z_mean") < tolerance) & (
        (F.abs(F.col("z_std") - 1) < tolerance) | (F.col("z_std") == 0)
    )
    return check.withColumn("passed", passed)
