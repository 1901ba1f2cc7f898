"""Dimensions with stable surrogate keys, and facts keyed by them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.operators.numbering import number_rows
from tamiz.runtime import null_safe_join


def insert_new_members(
    dimension: DataFrame | None, staged: DataFrame, business_key: Sequence[str], id: str
) -> DataFrame:
    """Rows to append: distinct staged members not yet present, with new surrogate keys.

    New keys continue after the largest existing one, in business-key order, so a
    rerun on the same input adds nothing and never renumbers.
    """
    keys = list(business_key)
    members = staged.select(*keys).distinct()
    start: int | Column = 1
    if dimension is not None:
        members = null_safe_join(members, dimension.select(*keys), keys, "left_anti")
        start = dimension.agg(F.coalesce(F.max(id), F.lit(0)) + 1).scalar()
    return number_rows(members, keys, out=id, start=start).select(id, *keys)


def lookup_key(df: DataFrame, dimension: DataFrame, business_key: Sequence[str], id: str) -> DataFrame:
    """Replace a business key by its surrogate key (inner join, NULL parts match NULL)."""
    keys = list(business_key)
    return null_safe_join(df, dimension.select(id, *keys), keys).drop(*keys)


def fact_rows(
    staged: DataFrame,
    dimensions: Sequence[tuple[DataFrame, Sequence[str], str]],
    measures: Sequence[str],
) -> DataFrame:
    """One row per combination of surrogate keys with the maximum of each measure.

    Measures are combined per business keys before the lookups, which shrinks hot
    combinations ahead of every join.
    """
    business = [k for _, keys, _ in dimensions for k in keys]
    rows = staged.groupBy(*business).agg(*[F.max(m).alias(m) for m in measures])
    for dimension, keys, id in dimensions:
        rows = lookup_key(rows, dimension, keys, id)
    ids = [id for _, _, id in dimensions]
    return rows.select(*ids, *measures)
