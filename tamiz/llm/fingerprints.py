"""Document fingerprints: MinHash signatures, banded in Spark and verified by Jaccard.

Method: each text's set of five-word shingles (A-Z lower-cased) is hashed to 64 bits. Of `PERMUTATIONS`
universal hash functions h(x) = ((a x + b) mod 2^64) >> 32 with odd a, the fingerprint keeps each
one's minimum over the set, vectorised in numpy. The share of equal minima estimates the
Jaccard similarity. Near duplicates are found by joining bands of the signature in Spark: every
text is compared with the leader of each of its band buckets, so a bucket of n texts gives n
comparisons, and the pair is verified by the exact Jaccard similarity of the sets. Texts of a bucket that
are still in different groups are then compared with each other, in cells of bounded size.

Nulls count as empty texts, which have no shingle and all minima at their maximum: empty texts
are alike, and unlike all others. A text with fewer than five words has its whole sequence as its only
shingle. Equal texts have equal fingerprints; repeated rows are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.llm.common import connected_components, partitions, staged, texts
from tamiz.llm.kernels import chunks, of_rows, shingles, text_bytes, words
from tamiz.llm.language_model import grouped
from tamiz.queries.base import table

PERMUTATIONS = 64
BANDS = 16
CELL_SETS = 256
NEAR = 0.8
_DRAWN = np.random.default_rng(9).integers(0, 1 << 63, (2, PERMUTATIONS), dtype=np.uint64)
_A, _B = _DRAWN[0] * np.uint64(2) + np.uint64(1), _DRAWN[1]
_NONE = np.uint32(0xFFFFFFFF)


def signatures(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of minima per text."""
    values, begins = shingles(*words(data, offsets))
    out = np.empty((len(offsets) - 1, PERMUTATIONS), np.uint32)
    for k in range(PERMUTATIONS):
        out[:, k] = of_rows(((values * _A[k] + _B[k]) >> np.uint64(32)).astype(np.uint32), begins, np.minimum, _NONE)
    return out


def as_text(signature: np.ndarray) -> list[str]:
    flat = signature.astype(">u4").tobytes().hex()
    width = 8 * PERMUTATIONS
    return [flat[i : i + width] for i in range(0, len(flat), width)]


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash (MD5) and signature (binary, big-endian) of every text."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                rows = signatures(*text_bytes(part.column("text"))).astype(">u4")
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_hash"), pa.array([r.tobytes() for r in rows], pa.binary())],
                    names=["doc_id", "text_hash", "signature"],
                )

    rows = texts(docs).select(F.col("doc_id").cast("long"), "text", F.md5(F.col("text").cast("binary")).alias("text_hash"))
    return rows.mapInArrow(sign, "doc_id long, text_hash string, signature binary")


def link_cells(near: float):
    """For mapInArrow over rows sorted by cell: links between its sets of different groups. In a cell of two
    blocks only sets of different blocks are compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in grouped(batches, "cell"):
            sets = [np.frombuffer(r["raw"], np.int64) for r in rows]
            group = np.array([r["group"] for r in rows])
            blocks = np.array([r["block"] for r in rows])
            sizes = np.array([len(x) for x in sets])
            crossing = blocks.min() != blocks.max()
            made = []
            for i in range(len(rows) - 1):
                fits = np.minimum(sizes[i], sizes[i + 1 :]) >= near * np.maximum(sizes[i], sizes[i + 1 :]) - 1e-9
                fits &= group[i + 1 :] != group[i]
                if crossing:
                    fits &= blocks[i + 1 :] != blocks[i]
                for j in (np.flatnonzero(fits) + i + 1).tolist():
                    if group[i] == group[j]:
                        continue
                    common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if common >= near * (sizes[i] + sizes[j] - common):
                        made.append((rows[i]["node"], rows[j]["node"]))
                        group[group == group[j]] = group[i]
            yield pa.RecordBatch.from_arrays([pa.array([m[k] for m in made], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return run


def near_duplicates(docs: DataFrame, near: float = NEAR, bands: int = BANDS) -> DataFrame:
    """doc_id and component (smallest doc_id reached) of every row. Equal texts are one; others are
    linked if they share a band bucket and their exact similarity is at least `near`: first each text
    with the leader of its bucket, then all that are still in different groups. With 16 bands of
    4 minima a pair at 0.8 shares a bucket with probability 0.9998. Rows without id take part; their component
    is null if no id is reached. The worst case is quadratic: a large bucket of texts in different groups."""
    spark = docs.sparkSession
    signed = staged(fingerprints(docs).withColumn("node", F.xxhash64("text_hash")), "fingerprints")
    classes = signed.groupBy("node").agg(F.min("doc_id").alias("rep"), F.first("signature").alias("signature"))
    width = 4 * PERMUTATIONS // bands
    pieces = F.array(*[F.struct(F.lit(k).alias("band"), F.substring("signature", 1 + k * width, width).alias("piece")) for k in range(bands)])
    banded = classes.filter(F.expr(f"signature <> unhex('{'ff' * 4 * PERMUTATIONS}')")).select("node", F.inline(pieces))
    banded = staged(banded, "fingerprint-bands")
    hubs = banded.groupBy("band", "piece").agg(F.min("node").alias("hub"), F.count("*").alias("n")).filter("n > 1")
    members = staged(banded.join(hubs, ["band", "piece"]), "fingerprint-buckets")
    pairs = staged(members.filter("node <> hub").select("node", "hub").distinct(), "fingerprint-pairs")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                values, begins = shingles(*words(*text_bytes(part.column("text"))))
                found = [np.unique(values[a:b]).view(np.int64) for a, b in zip(begins[:-1], begins[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), pa.array(found, pa.list_(pa.int64())), pa.array([f.tobytes() for f in found], pa.binary())],
                    names=["node", "grams", "raw"],
                )

    wanted = members.select("node").distinct()
    own = F.xxhash64(F.md5(F.col("text").cast("binary")))
    grams = staged(
        texts(docs).select(own.alias("node"), "text").join(wanted, "node").dropDuplicates(["node"])
        .mapInArrow(sets, "node long, grams array<long>, raw binary"),
        "fingerprint-sets",
    )
    common = F.size(F.array_intersect("x", "y"))
    links = (
        pairs.join(grams.select("node", F.col("grams").alias("x")), "node")
        .join(grams.select(F.col("node").alias("hub"), F.col("grams").alias("y")), "hub")
        .filter(common >= near * (F.size("x") + F.size("y") - common))
        .select(F.col("node").alias("a"), F.col("hub").alias("b"))
    )
    groups = staged(connected_components(links, "fingerprint-led"), "fingerprint-led")
    # What the leaders leave open: buckets with several groups, dealt into cells of two blocks of sets.
    told = members.join(groups, "node", "left").withColumn("group", F.coalesce("component", "node")).drop("component")
    told = staged(told, "fingerprint-open")
    left = told.groupBy("band", "piece").agg(F.min("group").alias("_low"), F.max("group").alias("_high")).filter("_low <> _high")
    blocks = F.ceil(F.col("n") / F.lit(CELL_SETS)).cast("int")
    # The leader itself has been compared with all.
    rest = told.filter("node <> hub").join(left.select("band", "piece"), ["band", "piece"]).withColumn("_blocks", blocks)
    rest = rest.withColumn("block", F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int"))
    rest = rest.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    cell = F.xxhash64("band", "piece", F.least("block", "_other"), F.greatest("block", "_other"))
    dealt = rest.select(cell.alias("cell"), "block", "node", "group").join(grams.select("node", "raw"), "node")
    dealt = dealt.repartition(partitions(spark), "cell").sortWithinPartitions("cell")
    more = dealt.mapInArrow(link_cells(near), "a long, b long")
    spans = groups.select(F.col("node").alias("a"), F.col("component").alias("b"))
    final = connected_components(spans.union(more), "fingerprint-groups")
    whole = classes.select("node", "rep").join(final, "node", "left").withColumn("_group", F.coalesce("component", "node"))
    lowest = whole.groupBy("_group").agg(F.min("rep").alias("lowest"))
    named = whole.select("node", "_group").join(lowest, "_group").select("node", F.col("lowest").alias("component"))
    return signed.select("doc_id", "node").join(named, "node").select("doc_id", "component")


EDITED_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def compare_edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by slice; a ghost row ends each slice with the first document of the next one."""
    held: pa.RecordBatch | None = None
    for batch in batches:
        rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        for part in chunks(rows):
            # The row after the part is needed too; the last row of all waits for its successor.
            stop = part.num_rows
            if (at := _row_of(part, rows)) + stop == rows.num_rows:
                stop -= 1
            if stop > 0:
                yield _edited(rows.slice(at, stop + 1))
        held = rows.slice(rows.num_rows - 1, 1)


def _row_of(part: pa.RecordBatch, rows: pa.RecordBatch) -> int:
    return part.column(0).offset - rows.column(0).offset


def _edited(rows: pa.RecordBatch) -> pa.RecordBatch:
    """Results for all rows but the last, each with the row after it; ghosts give none."""
    data, offsets = text_bytes(rows.column("text"))
    leads = np.flatnonzero((data & 0xC0) != 0x80)
    firsts = np.searchsorted(leads, offsets)
    n = np.diff(firsts)
    ends = np.append(leads, len(data))
    cut = n[:-1] // 3
    kept = ends[firsts[:-2] + n[:-1] - cut]
    taken = ends[firsts[1:-1] + np.minimum(cut, n[1:])]
    raw = data.tobytes()
    edited = [
        raw[a:b] + raw[c:d] for a, b, c, d in zip(offsets[:-2], kept, offsets[1:-1], taken, strict=True)
    ]
    own = signatures(data, offsets)
    other = signatures(
        np.frombuffer(b"".join(edited), np.uint8), np.concatenate([[0], np.cumsum([len(e) for e in edited])]).astype(np.int64)
    )
    real = ~rows.column("ghost").to_numpy(zero_copy_only=False)[:-1]
    out = pa.RecordBatch.from_arrays(
        [
            rows.column("doc_id").slice(0, rows.num_rows - 1),
            pa.array(n[:-1], pa.int64()),
            pa.array([hashlib.sha256(e).hexdigest() for e in edited]),
            pa.array(as_text(own[:-1])),
            pa.array(as_text(other)),
            pa.array((own[:-1] == other).mean(axis=1)),
            pa.array((own[:-1] == own[1:]).mean(axis=1)),
        ],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )
    return out.filter(pa.array(real))


def edit_study(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint against those of its edited text and of the next document.

    The next document is the one with the next smaller doc_id (after the last: the first; null ids
    come last, and ties are ordered by text). The ids are cut into slices at approximate
    quantiles. Every slice also receives, as a ghost, the first document of the next slice, so
    texts are shuffled once and no ordering spans more than a slice.
    """
    spark = docs.sparkSession
    rows = texts(docs).select(F.col("doc_id").cast("long"), "text")
    n = partitions(spark)
    found = rows.select("doc_id").approxQuantile("doc_id", [k / n for k in range(1, n)], 0.1 / n)
    bounds = F.array(*[F.lit(b) for b in sorted({int(b) for b in found}, reverse=True)]).cast("array<long>")
    # Null ids belong to the last slice, as no bound is below them.
    place = F.when(F.col("doc_id").isNull(), F.size(bounds)).otherwise(F.size(F.filter(bounds, lambda b: F.col("doc_id") < b)))
    heads = (
        rows.select("doc_id", F.md5(F.col("text").cast("binary")).alias("m"), place.alias("slice"))
        .groupBy("slice")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), -F.col("doc_id"), "m")).alias("head"))
        .orderBy("slice")
        .collect()
    )
    if not heads:
        return spark.createDataFrame([], EDITED_SCHEMA)
    slices = [h["slice"] for h in heads]
    ghosts = F.array(
        *[
            F.struct(F.lit(s).alias("slice"), F.lit(None if h[0] else -h[1]).cast("long").alias("id"), F.lit(h[2]).alias("m"))
            for s, h in zip([slices[-1], *slices[:-1]], [x["head"] for x in heads], strict=True)
        ]
    )
    text_hash = F.md5(F.col("text").cast("binary"))
    copies = F.filter(ghosts, lambda g: g["id"].eqNullSafe(F.col("doc_id")) & (g["m"] == text_hash))
    asked = F.concat(
        F.array(F.struct(F.col("_slice").alias("slice"), F.lit(False).alias("ghost"))),
        F.transform(F.coalesce(copies, F.array()), lambda g: F.struct(g["slice"].alias("slice"), F.lit(True).alias("ghost"))),
    )
    dealt = (
        rows.withColumn("_slice", place)
        .select("doc_id", "text", F.inline(asked))
        .repartitionById(n, F.col("slice"))
        .sortWithinPartitions("slice", "ghost", F.col("doc_id").desc_nulls_last(), F.md5(F.col("text").cast("binary")))
        .select("doc_id", "text", "ghost")
    )
    return dealt.mapInArrow(compare_edits, EDITED_SCHEMA)


def op9_minhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, of their edited texts, and their likenesses."""
    return edit_study(table(spark, sf_dir, "documents"))
