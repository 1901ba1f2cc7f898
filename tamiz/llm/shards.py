"""Sharding into contiguous runs of near-equal bytes, with equal texts kept together.

Method: minimax contiguous partition. Texts are ordered by their MD5; the leading bits cut that
order into `cells`, atomic groups that never split a group of equal texts. Of the cells only
their byte and row totals reach the driver (at most `cells` rows, whatever the input). There the
smallest capacity with which a greedy cut needs no more than the wanted shards is found by binary
search, and the cuts are placed within that capacity. All work on rows is DataFrame expressions.

Nulls: a null text counts as an empty one (0 bytes plus the overhead); null doc_ids are ordered first.
Repeated rows are kept, each with a slot of its own. An empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.llm.common import running_sums, staged, texts, total
from tamiz.queries.base import table

SHARDS = 40
CELLS = 1 << 16
OVERHEAD = 16


def greedy_cuts(ends: Sequence[int], shards: int, capacity: int) -> list[int] | None:
    """How many groups lie before each cut if every shard is filled up to `capacity`, or None if
    the groups do not fit. `ends` are the running totals of the group sizes."""
    cuts, filled = [], 0
    for _ in range(shards):
        here = bisect_right(ends, filled + capacity)
        cuts.append(here)
        if here == len(ends):
            return cuts + [here] * (shards - len(cuts))
        filled = ends[here - 1] if here else 0
    return None


def least_capacity(sizes: Sequence[int], shards: int) -> int:
    """Smallest largest shard over all ways to cut `sizes` into contiguous shards."""
    ends = list(accumulate(sizes))
    if not ends:
        return 0
    low, high = max(max(sizes), -(-ends[-1] // shards)), ends[-1]
    while low < high:
        middle = (low + high) // 2
        if greedy_cuts(ends, shards, middle) is None:
            low = middle + 1
        else:
            high = middle
    return low


def level_cuts(sizes: Sequence[int], shards: int) -> list[int]:
    """Cuts (groups before the end of each shard) that reach the least capacity.

    A plain greedy fill would leave the last shards light. So each cut is put where the shard comes
    closest to an equal part of what is left, as long as neither this shard nor the rest
    exceeds the capacity.
    """
    ends, capacity = list(accumulate(sizes)), least_capacity(sizes, shards)
    whole = ends[-1] if ends else 0
    # first[k]: the fewest groups that must lie before the last k shards.
    first, rest = [len(ends)], whole
    starts = [0, *ends]
    for _ in range(shards):
        first.append(bisect_left(starts, rest - capacity))
        rest = starts[first[-1]]
    cuts, at = [], 0
    for left in range(shards - 1, -1, -1):
        most = bisect_right(ends, starts[at] + capacity)
        wanted = starts[at] + (whole - starts[at]) / (left + 1)
        near = bisect_left(starts, wanted)
        if near > at + 1 and wanted - starts[near - 1] < starts[min(near, len(ends))] - wanted:
            near -= 1
        at = len(ends) if left == 0 else max(first[left], min(near, most), at)
        cuts.append(at)
    return cuts


def with_cells(docs: DataFrame, cells: int) -> DataFrame:
    head = F.conv(F.substring(F.md5(F.col("text").cast("binary")), 1, 8), 16, 10).cast("long")
    return texts(docs).select(
        "doc_id",
        (F.octet_length("text") + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        F.shiftright(head * cells, 32).cast("int").alias("cell"),
    )


def assign_shards(docs: DataFrame, shards: int = SHARDS, cells: int = CELLS) -> DataFrame:
    """doc_id, size, text_crc32, cell, shard and slot (0, 1, ... within the shard)."""
    if not 1 <= cells <= 1 << 24:
        raise ValueError("cells must be from 1 to 2**24, as their totals are held by the driver")
    rows = staged(with_cells(docs, cells), "shards")
    groups = (
        rows.groupBy("cell").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()
    )
    groups.sort(key=lambda g: g.cell)
    cuts = level_cuts([g.bytes for g in groups], shards)
    counts = [0, *accumulate(g.rows for g in groups)]
    firsts = [groups[c].cell if c < len(groups) else cells for c in cuts[:-1]]
    before = [0] + [counts[c] for c in cuts[:-1]]

    def shard_of(cell: Column) -> Column:
        return total([F.lit(0), *[(cell >= first).cast("int") for first in firsts]])

    numbered = running_sums(
        rows.withColumn("_one", F.lit(1)).withColumn("_row", F.monotonically_increasing_id()),
        ["cell", "doc_id", "_row"],
        {"_position": "_one"},
        "shard-order",
    ).withColumn("shard", shard_of(F.col("cell")))
    starts = F.array(*[F.lit(b).cast("long") for b in before])
    return numbered.select(
        "doc_id",
        "size",
        "text_crc32",
        "cell",
        "shard",
        (F.col("_position") - F.get(starts, F.col("shard"))).alias("slot"),
    )


def op2_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near-equal bytes."""
    return assign_shards(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
