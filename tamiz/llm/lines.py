"""Line deduplication across and within documents by winnowing.

Method: the lines of a document that have a word are hashed. From every line a window reaches over as many
lines as are needed for `MIN_WORDS` words, so equal runs of lines have equal windows wherever they
stand. Each window selects the line with its smallest hash (the leftmost of ties) as fingerprint: any
repeated run of at least that many words is guaranteed to hold a fingerprint in common. Windows
also reach back from every line, so that all lines of such a run, to its last one, lie in windows inside it. Fingerprint
positions are joined over the whole corpus, and those that occur once drop out. Around the others the
match is extended to both sides: every window that selected the fingerprint is compared as a whole
with its earliest occurrence, and windows that follow each other with the same distance
to their source join into one run. All repeated runs are deleted, but for their first occurrence in the order of
doc_id (null last) and line.

Lines without a word are neither compared nor deleted, unless nothing else is left. A line repeated very
often is counted per task before the shuffle, and only its window hash and place move. Nulls
count as empty texts and have no lines to compare; an empty table stays empty. Texts of any length are read whole, one at a time. Repeated rows (same id, same text) are one document and
answered alike; rows with one id and different texts are different documents, in the order of the texts' hashes. Each row
without id is a document of its own, in the order of the input. Other columns are carried along, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tamiz.llm.common import staged
from tamiz.queries.base import table

MIN_WORDS = 10
NO_ID = (1 << 63) - 1


def windows_of(lines: list[bytes], min_words: int = MIN_WORDS) -> list[tuple[int, int, int, int]]:
    """(fingerprint, window hash, first line, last line) of every window; lines are counted from 0. Windows reach
    ahead from a line or back from it: each line of a run of `min_words` words lies in a
    window inside the run that starts at it, ends at it, or starts where the run does."""
    held = [(k, n, xxhash.xxh3_64_intdigest(line)) for k, line in enumerate(lines) if (n := len(line.split()))]
    spans, end, words = set(), 0, 0
    for begin in range(len(held)):
        while end < len(held) and words < min_words:
            words += held[end][1]
            end += 1
        if words < min_words:
            break
        spans.add((begin, end))
        words -= held[begin][1]
    begin, words = 0, 0
    for end in range(1, len(held) + 1):
        words += held[end - 1][1]
        while words - held[begin][1] >= min_words:
            words -= held[begin][1]
            begin += 1
        if words >= min_words:
            spans.add((begin, end))
    found = []
    for begin, end in sorted(spans):
        hashes = [h for _, _, h in held[begin:end]]
        whole = xxhash.xxh3_64_intdigest(b"".join(h.to_bytes(8, "little") for h in hashes), seed=len(hashes))
        found.append((min(hashes), whole, held[begin][0], held[end - 1][0]))
    return found


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and the whole row as `_whole`, with _doc and _part, which together name a document. Rows
    without id are staged, so that their numbers stay the same."""
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("_whole"))
    own = F.xxhash64(F.coalesce("text", F.lit("")))
    named = rows.filter("doc_id IS NOT NULL").withColumn("_part", own)
    loose = rows.filter("doc_id IS NULL").withColumn("_part", F.monotonically_increasing_id())
    both = named.union(staged(loose, "line-rows"))
    return both.withColumn("_doc", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)))


def all_windows(rows: DataFrame, min_words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc", "part", "fingerprint", "whole", "first", "last"]
        for batch in batches:
            made = [[] for _ in names]
            keys = (batch.column(c).to_pylist() for c in ("doc", "part"))
            for doc, part, text in zip(*keys, batch.column("text").cast(pa.binary()), strict=True):
                for mark, whole, first, last in windows_of(text.as_py().split(b"\n"), min_words):
                    for column, value in zip(made, (doc, part, signed(mark), signed(whole), first, last), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in made], names=names)

    found = rows.select(F.col("_doc").alias("doc"), F.col("_part").alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    return found.mapInArrow(run, "doc long, part long, fingerprint long, whole long, first long, last long")


def repeated_windows(rows: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc, part, first, last, source, source_part, source_first of every window of keyed rows that occurs earlier."""
    found = staged(all_windows(rows, min_words), "line-windows")
    often = found.groupBy("fingerprint").agg(F.count("*").alias("n")).filter("n > 1").select("fingerprint")
    # Merge joins at every size, so that what is shuffled grows with the input alone.
    matched = found.join(often.hint("merge"), "fingerprint", "left_semi")
    sources = matched.groupBy("whole").agg(F.min(F.struct("doc", "part", "first")).alias("source"), F.count("*").alias("n"))
    sources = sources.filter("n > 1").drop("n")
    return (
        matched.join(sources.hint("merge"), "whole")
        .filter("doc <> source.doc OR part <> source.part OR first <> source.first")
        .select(
            "doc", "part", "first", "last",
            F.col("source.doc").alias("source"), F.col("source.part").alias("source_part"), F.col("source.first").alias("source_first"),
        )
    )


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc, part, first, last, source, source_part, source_first: windows joined into runs of lines with one source."""
    return runs_of(keyed(docs), min_words)


def runs_of(rows: DataFrame, min_words: int) -> DataFrame:
    found = repeated_windows(rows, min_words).withColumn("_gap", F.col("first") - F.col("source_first"))
    order = Window.partitionBy("doc", "part", "source", "source_part", "_gap").orderBy("first")
    reach = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = found.withColumn("_new", F.when(F.col("first") <= reach + 1, 0).otherwise(1))
    numbered = opened.withColumn("_run", F.sum("_new").over(order))
    return numbered.groupBy("doc", "part", "source", "source_part", "_gap", "_run").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.min("source_first").alias("source_first")
    ).drop("_gap", "_run")


def removed_lines(rows: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc and part of keyed rows, and the numbers of their deleted lines."""
    runs = runs_of(rows, min_words)
    spans = F.collect_list(F.sequence("first", "last"))
    return runs.groupBy("doc", "part").agg(F.array_distinct(F.flatten(spans)).alias("_covered"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, detail: bool = False) -> DataFrame:
    """The documents without their repeated runs, with all their columns. n_chars, if there,
    follows the text. Documents that lose all their words are left out; others without words stay.
    With `detail`, doc_id, n_lines, removed (line numbers) and the text of all documents instead."""
    columns, rows = docs.columns, keyed(docs)
    gone = staged(removed_lines(rows, min_words), "line-runs").withColumnsRenamed({"doc": "_doc", "part": "_part"})
    joined = rows.join(gone.hint("merge"), ["_doc", "_part"], "left")
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    blank = F.transform(F.col("_lines"), lambda line: ~line.rlike(r"[^\x20\x09-\x0D]"))
    covered = F.filter(F.col("_covered"), lambda k: ~F.get(F.col("_blank"), k.cast("int")))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.transform(F.col("_removed"), lambda k: k.cast("int")))
    cut = F.array_join(F.transform(kept, lambda k: F.get(F.col("_lines"), k)), "\n")
    parted = (
        joined.withColumn("_lines", lines)
        .withColumn("_blank", F.when(F.col("_covered").isNotNull(), blank))
        .withColumn("_removed", F.when(F.col("_covered").isNotNull(), F.array_sort(covered)))
    )
    text = F.when(F.col("_removed").isNotNull(), cut).otherwise(F.col("text"))
    if detail:
        empty = F.array().cast("array<bigint>")
        return parted.select(
            "doc_id", F.size("_lines").alias("n_lines"), F.coalesce("_removed", empty).alias("removed"), text.alias("text")
        )
    made = parted.select("_whole", F.col("_removed").isNotNull().alias("_changed"), text.alias("_text"))
    full = made.filter(~F.col("_changed") | F.col("_text").rlike(r"[^\x20\x09-\x0D]"))
    new = {"text": F.col("_text")}
    if "n_chars" in columns:
        kind = dict(docs.dtypes)["n_chars"]
        new["n_chars"] = F.when(F.col("_changed"), F.length("_text").cast(kind)).otherwise(F.col("_whole.n_chars"))
    return full.select(*[new[c].alias(c) if c in new else F.col("_whole")[c].alias(c) for c in columns])


def op5_winnowed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which lines of all documents go, and the hash of the text that stays."""
    return dedup_lines(table(spark, sf_dir, "documents"), detail=True).select(
        "doc_id", "n_lines", F.size("removed").alias("n_removed"), "removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )
