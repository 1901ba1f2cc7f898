"""One robust figure per entity from noisy duplicate reports, and its indicators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions.text import title_case
from tamiz.functions.units import per_capita, population_density
from tamiz.operators.quantiles import BUFFERED_ROWS, exact_median, largest_group
from tamiz.runtime import checkpoint, null_safe_join


def consolidate(df: DataFrame, key: str, first: str, second: str, **options) -> DataFrame:
    """Exact medians of two measures and the number of reports of the second, per key.

    NaN counts as missing. Every key is kept, also NULL and one without any number. One
    aggregate while every key's reports fit a task; else they are staged once, see `exact_quantiles`.
    """
    limit = options.get("buffered_rows", BUFFERED_ROWS)
    kinds = dict(df.dtypes)
    numbers = {c: F.when(~F.isnan(c), F.col(c)) for c in (first, second) if kinds[c] in ("double", "float")}
    df = df.withColumns(numbers) if numbers else df
    if largest_group(df, [key]) <= limit:
        return df.groupBy(key).agg(
            F.median(first).alias(first),
            F.median(second).alias(second),
            F.count(second).alias("n_reportes"),
        )
    # The medians take several passes over the reports.
    df = checkpoint(df.select(key, first, second))
    counts = df.groupBy(key).agg(F.count(second).alias("n_reportes"))
    for measure in (first, second):
        medians = exact_median(df, [key], measure, measure, **options).select(key, measure)
        counts = null_safe_join(counts, medians, [key], "left")
    return counts.select(key, first, second, "n_reportes")


def indicators(
    consolidated: DataFrame, population: DataFrame, key: str, area: str, total: str, origin: Column
) -> tuple[DataFrame, DataFrame]:
    """(indicators, entities without population). Density, per-capita value, display name."""
    known = consolidated.join(population, key)
    missing = consolidated.join(population, key, "left_anti").select(key)
    result = known.withColumns(
        {
            "poblacion_total": F.col("poblacion_total").cast("long"),
            "densidad_poblacional": population_density(F.col("poblacion_total"), F.col(area)),
            "pib_per_capita_eur": per_capita(F.col(total), F.col("poblacion_total")),
            "fuente_poblacion": origin,
            key: title_case(F.col(key)),
        }
    )
    return result, missing


def translate_codes(
    df: DataFrame, raw: str, codes: DataFrame, code: str, canon: str, out: str
) -> DataFrame:
    """Replace known variants by their canonical form, keep the rest as it is.

    Of a variant listed twice the smallest form counts, so rows are never multiplied.
    """
    pairs = codes.groupBy(F.col(code).alias("_code")).agg(F.min(canon).alias("_canon"))
    joined = df.join(pairs, F.col(raw) == F.col("_code"), "left")
    return joined.withColumn(out, F.coalesce("_canon", raw)).drop("_code", "_canon")
