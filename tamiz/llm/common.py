"""What the operators share: staging, row selection, ordered totals and components."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tamiz.operators.numbering import OFFSET_BITS
from tamiz.runtime import work_dir

# White space as the contracts define it: U+0020 and U+0009 to U+000D.
SPACES = r"[\x20\x09-\x0D]+"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: lineage ends there, columns stay prunable."""
    path = work_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """Only doc_id, the text (null counts as empty) and the named columns, whatever else there is."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *more)


def bucket_of(id_column: str, count: int) -> Column:
    """crc32 of the id as text, modulo `count`. A missing id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % count


def running_sums(
    df: DataFrame, order: Sequence[Column | str], sums: dict[str, str], label: str
) -> DataFrame:
    """Add to each row, for every entry out -> value, the total of `value` over the rows before it.

    Rows are range-partitioned and sorted once; each slice is then summed on its own and shifted
    by the totals of the slices before it, of which there is one row per partition. `order` should
    decide ties; rows that tie in it keep one order, as the sorted rows are staged.
    """
    ranged = df.repartitionByRange(partitions(df.sparkSession), *order).sortWithinPartitions(*order)
    kept = staged(ranged.withColumn("_id", F.monotonically_increasing_id()), label)
    located = kept.withColumn("_slice", F.shiftright("_id", OFFSET_BITS))
    totals = located.groupBy("_slice").agg(*[F.sum(v).alias(f"_t_{o}") for o, v in sums.items()])
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select(
        "_slice", *[F.coalesce(F.sum(f"_t_{o}").over(earlier), F.lit(0)).alias(f"_s_{o}") for o in sums]
    )
    before = Window.partitionBy("_slice").orderBy("_id").rowsBetween(Window.unboundedPreceding, -1)
    inside = located.withColumns(
        {o: F.coalesce(F.sum(v).over(before), F.lit(0)) for o, v in sums.items()}
    )
    return (
        inside.join(F.broadcast(shifts), "_slice")
        .withColumns({o: (F.col(o) + F.col(f"_s_{o}")).cast("long") for o in sums})
        .drop("_id", "_slice", *[f"_s_{o}" for o in sums])
    )


def connected_components(links: DataFrame, label: str) -> DataFrame:
    """(node, component): the smallest node reachable from each node of the links (a, b).

    Alternates large-star and small-star steps: every node hangs its neighbours on its smallest one.
    Only minima are aggregated per node, so a node with very many links is combined before the
    shuffle, and each round is staged, so lost work is repeated from the round before.
    """
    edges = staged(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("u <> v")
        .distinct(),
        label,
    )
    seen = None
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = small.union(low.select("u", F.col("m").alias("v"))).filter("u <> v")
        stars = stars.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        edges = staged(stars, label)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    roots = edges.groupBy("u").agg(F.min("v").alias("component"))
    return roots.select(F.col("u").alias("node"), "component").union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def total(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)
