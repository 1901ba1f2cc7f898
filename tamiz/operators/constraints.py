"""Table constraints, key-set comparisons and expectations as DataFrames of findings."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _finding(df: DataFrame, name: str, violations: Column) -> DataFrame:
    return df.agg(F.coalesce(violations, F.lit(0)).cast("long").alias("violations")).select(
        F.lit(name).alias("constraint_name"), "violations"
    )


def row_checks(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """NOT NULL and CHECK constraints: all of them counted in one pass, unpivoted.

    As in SQL, a CHECK that evaluates to NULL is not a violation.
    """
    return _unpivoted(df, {name: F.count_if(~ok) for name, ok in checks.items()}, "constraint_name", "violations")


def _unpivoted(df: DataFrame, totals: dict[str, Column], name: str, value: str) -> DataFrame:
    """Several aggregates of one pass as rows (name, value)."""
    counts = df.agg(*[total.alias(f"t{i}") for i, total in enumerate(totals.values())])
    rows = [
        F.struct(F.lit(label).alias(name), F.col(f"t{i}").alias(value))
        for i, label in enumerate(totals)
    ]
    return counts.select(F.inline(F.array(*rows)))


def unique_check(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (map-side combined, so hot keys are no problem)."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return _finding(repeated, name, F.count(F.lit(1)))


def foreign_key_check(
    child: DataFrame, name: str, keys: Sequence[str], parent: DataFrame, parent_keys: Sequence[str]
) -> DataFrame:
    """Child rows without a parent. Keys are combined first, so each is looked up once."""
    uses = (
        child.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    )
    parents = parent.select(*[F.col(p).alias(c) for c, p in zip(keys, parent_keys)])
    return _finding(uses.join(parents, list(keys), "left_anti"), name, F.sum("n"))


def violations(*findings: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, findings)


def missing_keys(required: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Required keys that are absent."""
    return required.select(key).distinct().join(present.select(key), key, "left_anti")


def key_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Symmetric difference of two key sets, with the side that holds each key."""
    only_left = missing_keys(left, right, key).withColumn("side", F.lit("left"))
    return only_left.unionByName(missing_keys(right, left, key).withColumn("side", F.lit("right")))


def is_subset(inner: DataFrame, outer: DataFrame, key: str) -> DataFrame:
    """One row telling whether every inner key occurs in outer."""
    return missing_keys(inner, outer, key).agg((F.count(F.lit(1)) == 0).alias("is_subset"))


def expectations(df: DataFrame, expected: dict[str, tuple[Column, object]]) -> DataFrame:
    """Cardinality and checksum expectations: (name, expected, actual, passed)."""
    totals = {name: actual.cast("double") for name, (actual, _) in expected.items()}
    actuals = _unpivoted(df, totals, "expectation", "actual")
    wanted = F.create_map(
        *[F.lit(x) for name, (_, value) in expected.items() for x in (name, float(value))]
    )
    return actuals.select(
        "expectation",
        wanted[F.col("expectation")].alias("expected"),
        "actual",
        (F.col("actual") == wanted[F.col("expectation")]).alias("passed"),
    )


def same_content(left: DataFrame, right: DataFrame) -> DataFrame:
    """Idempotence check: rows on either side that the other lacks, both zero if equal."""
    names = left.columns
    sides = left.select(*names, F.lit(1).alias("_n")).unionByName(
        right.select(*names, F.lit(-1).alias("_n"))
    )
    balance = sides.groupBy(*names).agg(F.sum("_n").alias("_n"))
    return balance.agg(
        F.coalesce(F.sum(F.when(F.col("_n") > 0, F.col("_n"))), F.lit(0)).alias("only_left"),
        F.coalesce(F.sum(F.when(F.col("_n") < 0, -F.col("_n"))), F.lit(0)).alias("only_right"),
    )
