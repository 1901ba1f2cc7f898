"""Mixing sources to target weights by whole copies and a Pareto order sample.

Each source has a target size in words. A source's inclusion rate is target / size. The whole
part of the rate is allocated to every document as certain copies. The fraction left is the inclusion
probability p of one more copy: documents are ranked by Pareto's ratio of odds,
(u / (1 - u)) / (p / (1 - p)) with a uniform u drawn from the document itself, and taken in that
order until the rest of the target is filled. Thus a source's words miss its target by less than
the document at the cut, no document is used more than `limit` times, and reruns agree.

Ranking is one distributed running total over all sources, so a source with a third of all rows
is no heavier than others. Nulls: a null text has no words; a null source is a source of its own,
after all others. Repeated rows have equal ranks and are taken one after the other. Sources
without words take nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tamiz.llm.common import running_sums, staged
from tamiz.queries.base import table
from tamiz.runtime import small_side

LIMIT = 3
WEIGHTS = (1, 2, 3)
WORD = r"[^\x20\x09-\x0D]+"
# Pareto draws have 52 bits: the first 13 hexadecimal digits of an MD5.
DRAWS = 1 << 52


def draw(*columns: str) -> Column:
    """A number strictly between 0 and 1 that depends on the columns alone."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    digits = F.substring(F.md5(F.concat_ws("|", *shown).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(DRAWS))


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, limit: int = LIMIT
) -> DataFrame:
    """source, source_size, target from (source, source_size): one row per source.

    Weights repeat along the sources in code point order, null last. The target of a source is
    its weight's share of all words, at most `limit` times its own. Shares beyond that are dealt
    again by weight; sources reach their limit in the order of limit / weight, so the level of the
    others follows from running totals in that order.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weighed = sizes.withColumn("_w", F.get(F.array(*map(F.lit, weights)), (place - 1) % len(weights)))
    every = Window.partitionBy()
    order = Window.orderBy(F.col("_most") / F.col("_w"), F.col("source").asc_nulls_last())
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    leveled = weighed.withColumn("_most", F.col("source_size") * limit).withColumn(
        "_level",
        (F.sum("source_size").over(every) - F.coalesce(F.sum("_most").over(earlier), F.lit(0)))
        / (F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(earlier), F.lit(0))),
    )
    # The first source whose limit is not below its share sets the level for it and all after.
    fits = F.col("_w") * F.col("_level") <= F.col("_most")
    level = F.min(F.when(fits, F.struct(F.col("_most") / F.col("_w"), "source", "_level"))).over(every)
    target = F.least(F.col("_most").cast("double"), F.col("_w") * level["_level"])
    return leveled.select("source", "source_size", target.cast("double").alias("target"))


def sized(docs: DataFrame, *columns: str) -> DataFrame:
    """The columns, the words of each text and its random number."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(*columns, size.alias("size"), draw("doc_id", "source").alias("_u"))


def ranked(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Sized rows with their source's size and target, the certain copies _whole and the rank _odds of one more."""
    same = F.col("source").eqNullSafe(F.col("_source"))
    # One row per source: broadcast if a count allows it, else joined by shuffle.
    matched = rows.join(small_side(targets.withColumnRenamed("source", "_source")), same).drop("_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    p = F.col("_rate") - F.col("_whole")
    odds = (F.col("_u") / (1 - F.col("_u"))) / (p / (1 - p))
    return (
        matched.withColumn("_rate", rate)
        .withColumn("_whole", F.floor("_rate"))
        .withColumn("_odds", F.when(p > 0, odds).otherwise(F.lit(float("inf"))))
    )


def placed(docs: DataFrame, weights: Sequence[int], limit: int) -> tuple[DataFrame, DataFrame]:
    """(the ranked rows with `_inside`: whether one more copy is taken; source, source_size and target of each source)."""
    rows = staged(sized(docs, "doc_id", "source"), "mix")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = staged(source_targets(sizes, weights, limit), "mix-targets")
    order = [F.col("source").asc_nulls_last(), F.col("_odds"), F.col("doc_id"), F.col("size")]
    summed = running_sums(ranked(rows, targets), order, {"_before": "size"}, "mix-order")
    # Words of the sources before this one, to turn the running total into one within the source.
    ahead = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    starts = targets.select(
        F.col("source").alias("_source"),
        F.coalesce(F.sum("source_size").over(ahead), F.lit(0)).alias("_start"),
    )
    found = summed.join(starts, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    rest = F.col("target") - F.col("_whole") * F.col("source_size")
    # Taken if more than half of the document lies before the cut, which holds for a first part of each source's order.
    return found.withColumn("_inside", 2 * (F.col("_before") - F.col("_start")) + F.col("size") < 2 * rest), targets


def pareto_mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken (size times copies)."""
    found, _ = placed(docs, weights, limit)
    copies = F.least(F.col("_whole") + F.col("_inside").cast("int"), F.lit(limit)).cast("long")
    return found.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (F.col("size") * copies).cast("long").alias("taken"),
    )


KEY = ("_odds", "doc_id", "size")


def source_cuts(found: DataFrame) -> DataFrame:
    """For each source that takes more copies: `_cut`, the key of its last row that does, how many rows have this key
    (`_equal`) and how many of them take one (`_taking`)."""
    key = F.struct(*KEY)
    cuts = found.filter("_inside").groupBy("source").agg(F.max(key).alias("_cut"))
    cuts = cuts.withColumnRenamed("source", "_source")
    at = found.join(cuts, F.col("source").eqNullSafe(F.col("_source"))).filter(same_key())
    return at.groupBy("_source", "_cut").agg(F.count("*").alias("_equal"), F.sum(F.col("_inside").cast("int")).alias("_taking"))


def same_key() -> Column:
    return total_and([F.col(c).eqNullSafe(F.col(f"_cut.{c}")) for c in KEY])


def total_and(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, columns)


def mixed(docs: DataFrame, weights: Sequence[int] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """The documents of the mix, each repeated `copies` times, with all their columns.

    The copies of a document follow from its own rank and the cut of its source, so texts stay where they are.
    Rows that agree in id, source and size have one rank; where a source's cut falls among such rows, they are numbered, and the
    mix takes as many of them as `pareto_mix` does.
    """
    columns = docs.columns
    found, targets = placed(docs, weights, limit)
    cuts = staged(source_cuts(staged(found, "mix-placed")), "mix-cuts")
    whole = docs.select(F.struct(*columns).alias("_doc"), "doc_id", "source", "text")
    own = ranked(sized(whole, "_doc", "doc_id", "source"), targets).join(
        small_side(cuts), F.col("source").eqNullSafe(F.col("_source")), "left"
    )
    divided = same_key() & (F.col("_taking") < F.col("_equal"))
    below = F.coalesce(F.struct(*KEY) <= F.col("_cut"), F.lit(False))
    own = own.withColumn("_more", F.when(F.coalesce(divided, F.lit(False)), F.lit(None)).otherwise(below))
    decided = own.filter("_more IS NOT NULL").select("_doc", "_whole", "_more")
    if cuts.filter("_taking < _equal").count():
        tied = own.filter("_more IS NULL").withColumn("_one", F.lit(1))
        order = [F.col("source").asc_nulls_last(), F.xxhash64(F.col("_doc.text"))]
        numbered = running_sums(tied, order, {"_place": "_one"}, "mix-tied")
        ahead = Window.orderBy(F.col("_source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
        starts = cuts.filter("_taking < _equal").select(
            F.col("_source").alias("_of"), F.coalesce(F.sum("_equal").over(ahead), F.lit(0)).alias("_start")
        )
        chosen = numbered.join(starts, F.col("source").eqNullSafe(F.col("_of")))
        decided = decided.union(chosen.select("_doc", "_whole", (F.col("_place") - F.col("_start") < F.col("_taking")).alias("_more")))
    copies = F.least(F.col("_whole") + F.col("_more").cast("int"), F.lit(limit)).cast("int")
    repeated = F.explode(F.sequence(F.lit(1), "_copies"))
    taken = decided.select("_doc", copies.alias("_copies")).filter("_copies > 0")
    return taken.select("_doc", repeated.alias("_copy")).select("_doc.*")


def op4_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed with the weights 1, 2, 3 and at most three copies."""
    return pareto_mix(table(spark, sf_dir, "documents")).drop("source", "copies")


OP4_SQL = r"""
WITH d AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(source, '')), 1, 13))::BIGINT + 0.5::DOUBLE)
           / 4503599627370496::DOUBLE AS u
    FROM documents),
s AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS w
    FROM d GROUP BY source),
l AS (
    SELECT *, 3 * source_size AS most, (3 * source_size)::DOUBLE / w AS ratio,
           (sum(source_size) OVER ()
            - coalesce(sum(3 * source_size) OVER o, 0))::DOUBLE
           / (sum(w) OVER () - coalesce(sum(w) OVER o, 0))::DOUBLE AS level
    FROM s WINDOW o AS (ORDER BY (3 * source_size)::DOUBLE / w, source NULLS LAST
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
one AS (
    SELECT level FROM l WHERE w * level <= most ORDER BY ratio, source NULLS FIRST LIMIT 1),
t AS (
    SELECT l.source, source_size, least(most::DOUBLE, w * one.level) AS target,
           CASE WHEN source_size > 0 THEN least(most::DOUBLE, w * one.level) / source_size ELSE 0 END AS rate
    FROM l, one),
o AS (
    SELECT d.*, source_size, target, floor(rate)::BIGINT AS whole, rate - floor(rate)::BIGINT AS p
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
r AS (
    SELECT *, coalesce(sum(size) OVER (
        PARTITION BY source
        ORDER BY CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) ELSE 'infinity'::DOUBLE END, doc_id NULLS FIRST, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
    FROM o)
SELECT doc_id, size, source_size, target,
       (size * least(whole + CASE WHEN 2 * before + size < 2 * (target - whole * source_size) THEN 1 ELSE 0 END, 3))::BIGINT AS taken
FROM r
"""
