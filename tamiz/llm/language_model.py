"""Language-model scores from a Bloom filter of quantised n-gram counts.

Method: log-frequency Bloom filter. Word pairs of the training texts are counted exactly on Spark. A
pair with count c is put into the filter once for every level 1 .. 1 + floor(log2(c / floor)); a
reader probes level after level until one is missing and takes the last level's count, which is
never above the true one but for false positives. The filter has one segment per hash bucket, which stays in
its bucket. Its size follows from the levels of the bucket's pairs, so that at most half of it is filled, and
the number of buckets from the training tokens: every pair is in the filter, however many there are.

Each block of texts asks the buckets for the counts of its own distinct words, which are exact, and of its
distinct word pairs, which the filter answers. So a word or pair costs a block one request however often it
occurs, and answers go back to the block.
Probabilities are smoothed towards them, P(w | h) = s c(h, w) / c(h) + (1 - s) P(w) with
P(w) = (c(w) + 1) / (N + V + 1); 1 - s is the share of training tokens whose pair occurs only once, which is
Good and Turing's estimate of how often a pair is new. A text ends with an end token.

Nulls: a null text counts as empty and is scored as an end alone. Repeated rows are counted and
scored each. Without training texts all counts are 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.llm.common import bucket_of, partitions, staged, texts
from tamiz.llm.kernels import chunks, counted, mix, pack, pack_sorted, text_bytes, unpack, unpack_sorted, words
from tamiz.queries.base import table

BLOCK_BYTES = 16 << 20
# The least size of the whole filter; it grows with the pairs.
FILTER_BITS = 1 << 29
BUCKET_TOKENS = 1 << 22
PROBES = 8
FOLDS, HELD_OUT = 7, 2
END = np.uint64(0x5DEECE66D1234567)
START = np.uint64(0x2545F4914F6CDD1D)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Number, rows, token hashes (words and an end per text) and token offsets of each block."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for block in chunks(batch, limit=BLOCK_BYTES):
            hashes, firsts, done = [], [np.zeros(1, np.int64)], 0
            for part in chunks(block):
                own, first = words(*text_bytes(part.column("text")))
                ended = np.insert(own, first[1:], END)
                hashes.append(ended)
                firsts.append(done + first[1:] + np.arange(1, len(first)))
                done += len(ended)
            yield number, block, np.concatenate(hashes), np.concatenate(firsts)
            number += 1


def training(block: pa.RecordBatch, firsts: np.ndarray) -> np.ndarray:
    used = ~block.column("held_out").to_numpy(zero_copy_only=False)
    return np.repeat(used, np.diff(firsts))


def split(values: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """Borders of the hash buckets in sorted `bits`-bit values."""
    borders = np.arange(1, buckets, dtype=np.uint64) << np.uint64(bits - buckets.bit_length() + 1)
    return np.concatenate([[0], np.searchsorted(values, borders), [len(values)]])


def block_rows(buckets: int):
    """For mapInArrow: a block's sorted distinct tokens with its texts as numbers into them, and per bucket those
    tokens with their counts in the block's training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, block, hashes, firsts in blocks(batches):
            distinct, local = np.unique(hashes, return_inverse=True)
            trained = training(block, firsts)
            counts = np.bincount(local[trained], minlength=len(distinct)).astype(np.uint64)
            borders = split(distinct, 64, buckets)
            docs = block.column("doc_id")
            text = pa.array(
                [
                    {
                        "doc_id": docs.to_pylist(),
                        "held_out": block.column("held_out").to_pylist(),
                        "sizes": np.diff(firsts),
                        "tokens": zstandard_u32(local),
                    }
                ],
                pa.struct([("doc_id", pa.list_(pa.int64())), ("held_out", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int64())), ("tokens", pa.binary())]),
            )
            yield rows_of([number], [-1], [pack_sorted(distinct)], [b""], [int(trained.sum())], text)
            some = np.flatnonzero(np.diff(borders))
            yield rows_of(
                [number] * len(some),
                some.tolist(),
                [pack_sorted(distinct[borders[b] : borders[b + 1]]) for b in some],
                [pack(counts[borders[b] : borders[b + 1]]) for b in some],
                [0] * len(some),
                pa.nulls(len(some), text.type),
            )

    return run


BLOCK_SCHEMA = (
    "block long, bucket int, tokens binary, counts binary, total long, "
    "texts struct<doc_id: array<long>, held_out: array<boolean>, sizes: array<long>, tokens: binary>"
)


def rows_of(block, bucket, tokens, counts, total, found) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(block, pa.int64()),
            pa.array(bucket, pa.int32()),
            pa.array(tokens, pa.binary()),
            pa.array(counts, pa.binary()),
            pa.array(total, pa.int64()),
            found,
        ],
        names=["block", "bucket", "tokens", "counts", "total", "texts"],
    )


def zstandard_u32(values: np.ndarray) -> bytes:
    return pack(values.astype(np.uint64))


def grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, list[dict]]]:
    """Consecutive rows with one key, from sorted batches."""
    rows, current = [], None
    for batch in batches:
        for row in batch.to_pylist():
            if rows and row[key] != current:
                yield current, rows
                rows = []
            current = row[key]
            rows.append(row)
    if rows:
        yield current, rows


def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per bucket: the counts over all blocks, sent back to every block that asked. One row with
    block -1 tells how many distinct training tokens the bucket has."""
    for bucket, rows in grouped(batches, "bucket"):
        asked = [unpack_sorted(r["tokens"]) for r in rows]
        distinct, counts = counted(np.concatenate(asked), np.concatenate([unpack(r["counts"]) for r in rows]))
        yield answers_of(bucket, rows, asked, distinct, counts, int((counts > 0).sum()))


ANSWER_SCHEMA = "block long, bucket int, counts binary, total long"


def answers_of(bucket: int, rows: list[dict], asked: list[np.ndarray], distinct: np.ndarray, counts: np.ndarray, total: int) -> pa.RecordBatch:
    """The total in a row with block -1, and the counts of what each block asked for, in its order."""
    return pa.RecordBatch.from_arrays(
        [
            pa.array([-1, *(r["block"] for r in rows)], pa.int64()),
            pa.array([bucket] * (len(rows) + 1), pa.int32()),
            pa.array([b"", *(pack(counts[np.searchsorted(distinct, a)]) for a in asked)], pa.binary()),
            pa.array([total] + [0] * len(rows), pa.int64()),
        ],
        names=["block", "bucket", "counts", "total"],
    )


def pair_hashes(hashes: np.ndarray, firsts: np.ndarray, bits: int) -> np.ndarray:
    """For each token the hash of it and the token before; the first follows a start."""
    before = np.empty_like(hashes)
    before[1:] = hashes[:-1]
    before[firsts[:-1]] = START
    return mix(before * np.uint64(0xD6E8FEB86659FD93) + hashes) >> np.uint64(64 - bits)


def told_tokens(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct tokens, numbers into them, tokens per text and token offsets of a block's row of texts."""
    sizes = np.array(row["texts"]["sizes"], np.int64)
    local = unpack(row["texts"]["tokens"]).astype(np.int64)
    return unpack_sorted(row["tokens"]), local, sizes, np.concatenate([[0], np.cumsum(sizes)])


def pair_rows(bits: int, buckets: int):
    """For mapInArrow over the rows of texts: by bucket each block's distinct pairs, with their counts in its
    training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                (row,) = batch.slice(at, 1).to_pylist()
                known, local, sizes, firsts = told_tokens(row)
                pairs = pair_hashes(known[local], firsts, bits)
                used = np.repeat(~np.array(row["texts"]["held_out"], bool), sizes)
                trained, times = np.unique(pairs[used], return_counts=True)
                distinct = np.unique(pairs)
                counts = np.zeros(len(distinct), np.uint64)
                counts[np.searchsorted(distinct, trained)] = times
                borders = split(distinct, bits, buckets)
                some = np.flatnonzero(np.diff(borders))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(some), row["block"]), pa.int64()),
                        pa.array(some, pa.int32()),
                        pa.array([pack_sorted(distinct[borders[b] : borders[b + 1]]) for b in some], pa.binary()),
                        pa.array([pack(counts[borders[b] : borders[b + 1]]) for b in some], pa.binary()),
                    ],
                    names=["block", "bucket", "pairs", "counts"],
                )

    return run


def places(pairs: np.ndarray, level: np.ndarray | int, probe: int, size: int) -> np.ndarray:
    """Bit of the segment that a probe of the pairs at their level looks at."""
    seed = pairs + np.asarray(level).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    one = mix(seed)
    step = mix(seed ^ np.uint64(0xA0761D6478BD642F)) | np.uint64(1)
    return (one + np.uint64(probe) * step) % np.uint64(size)


def segment(pairs: np.ndarray, counts: np.ndarray, size: int, probes: int = PROBES) -> tuple[int, np.ndarray]:
    """(floor, bits packed into bytes) of one bucket's filter."""
    room, floor = int(size * np.log(2) / probes), 1
    while True:
        kept = counts >= floor
        levels = np.floor(np.log2(counts[kept] / floor)).astype(np.int64) + 1
        if not len(levels) or levels.sum() <= room:
            break
        floor *= 2
    found, bits = pairs[kept], np.zeros(size, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        own = found[levels >= level]
        for probe in range(probes):
            bits[places(own, level, probe, size)] = True
    return floor, np.packbits(bits, bitorder="little")


def room_for(counts: np.ndarray, probes: int = PROBES) -> int:
    """Bits of a segment that all levels of these counts fill by half at most: about 12 for each."""
    levels = int(np.floor(np.log2(counts)).sum()) + len(counts)
    return -(-int(np.ceil((levels + 1) * probes / np.log(2))) // 8) * 8


def answer_pairs(hash_bits: int, least: int, first: int):
    """For mapInArrow: each bucket's segment is filled, and read for the pairs that the blocks ask for. Buckets
    are numbered from `first` in the answers; one row with block -1 tells how many pairs occur once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in grouped(batches, "bucket"):
            asked = [unpack_sorted(r["pairs"]) for r in rows]
            distinct, counts = counted(np.concatenate(asked), np.concatenate([unpack(r["counts"]) for r in rows]))
            pairs, counts = distinct[counts > 0], counts[counts > 0]
            size = max(least, room_for(counts))
            floor, bits = segment(pairs, counts, size)
            found = Filter(bits, np.array([floor]), hash_bits, size).counts(distinct).astype(np.uint64)
            yield answers_of(first + bucket, rows, asked, distinct, found, int((counts == 1).sum()))

    return run


class Filter:
    """Reads the counts of pairs; a bucket without pairs has no segment."""

    def __init__(self, bits: np.ndarray, floors: np.ndarray, hash_bits: int, size: int):
        self.bits, self.floors, self.size = bits, floors, size
        self.shift = np.uint64(hash_bits - (len(floors).bit_length() - 1))

    def counts(self, pairs: np.ndarray) -> np.ndarray:
        bucket = (pairs >> self.shift).astype(np.int64)
        out = np.zeros(len(pairs))
        floors = self.floors[bucket]
        alive = np.flatnonzero(floors > 0)
        level = 0
        while len(alive):
            level += 1
            for probe in range(PROBES):
                at = places(pairs[alive], level, probe, self.size)
                byte = self.bits[bucket[alive] * (self.size // 8) + (at >> np.uint64(3)).astype(np.int64)]
                alive = alive[(byte >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1]
            out[alive] = floors[alive] * 2.0 ** (level - 1)
        return out


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def scorer(hash_bits: int, buckets: int, n: int, v: int, documents: int, seen: float):
    """For mapInArrow over rows sorted by block and bucket: the texts come first, then the counts of their
    tokens and, from bucket number `buckets` on, of their pairs, each in the order of their hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in grouped(batches, "block"):
            found = rows[0]["texts"]
            distinct, local, sizes, firsts = told_tokens(rows[0])
            counts, pair_counts = (
                np.concatenate([unpack(r["counts"]) for r in rows[1:] if (r["bucket"] >= buckets) == paired]).astype(float)
                for paired in (False, True)
            )
            base = np.log10((counts + 1) / (n + v + 1))
            own = counts[local]
            history = np.empty(len(local))
            history[1:] = own[:-1]
            history[firsts[:-1]] = documents
            pair = pair_counts[np.unique(pair_hashes(distinct[local], firsts, hash_bits), return_inverse=True)[1]]
            # A pair cannot be more frequent than either of its tokens.
            pair = np.minimum(pair, np.minimum(history, own))
            weight = np.where(history > 0, seen, 0.0)
            smooth = np.log10(weight * pair / np.maximum(history, 1) + (1 - weight) * 10.0 ** base[local])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(found["doc_id"], pa.int64()),
                    pa.array(found["held_out"], pa.bool_()),
                    pa.array(sizes),
                    pa.array(np.add.reduceat((own > 0).astype(np.int64), firsts[:-1])),
                    pa.array(np.full(len(sizes), n, np.int64)),
                    pa.array(np.add.reduceat(base[local], firsts[:-1])),
                    pa.array(np.add.reduceat(smooth, firsts[:-1])),
                ],
                names=[c.split()[0] for c in RESULT.split(", ")],
            )

    return run


def score(docs: DataFrame, held_out: Column, filter_bits: int = FILTER_BITS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every text;
    texts that are not held out are the training texts. The filter has `filter_bits` bits at least."""
    spark = docs.sparkSession
    count = partitions(spark)
    buckets = max(64, 1 << (2 * count - 1).bit_length())
    rows = texts(docs).select(
        F.col("doc_id").cast("long"), "text", F.coalesce(held_out, F.lit(False)).alias("held_out")
    )
    told = staged(rows.mapInArrow(block_rows(buckets), BLOCK_SCHEMA), "lm-blocks")
    asked = told.filter("bucket >= 0").drop("texts", "total").repartition(count, "bucket").sortWithinPartitions("bucket")
    answers = staged(asked.mapInArrow(answer, ANSWER_SCHEMA), "lm-counts")
    n = told.agg(F.sum("total")).first()[0] or 0
    v = answers.filter("block = -1").agg(F.sum("total")).first()[0] or 0
    documents = rows.filter("NOT held_out").count()
    # Pairs are told apart by enough bits that chance collisions stay far below the filter's own errors.
    hash_bits = min(64, max(40, n.bit_length() + 14))
    # More training tokens make more buckets, not larger ones.
    pair_buckets = max(buckets, 1 << (n // BUCKET_TOKENS).bit_length())
    least = max(8, filter_bits // pair_buckets // 8 * 8)
    pairs = told.filter("bucket = -1").select("block", "tokens", "texts").mapInArrow(
        pair_rows(hash_bits, pair_buckets), "block long, bucket int, pairs binary, counts binary"
    )
    paired = staged(
        pairs.repartition(count, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(answer_pairs(hash_bits, least, buckets), ANSWER_SCHEMA),
        "lm-pairs",
    )
    singles = paired.filter("block = -1").agg(F.sum("total")).first()[0] or 0
    back = (
        told.filter("bucket = -1")
        .unionByName(answers.union(paired).filter("block >= 0"), allowMissingColumns=True)
        .repartition(count, "block")
        .sortWithinPartitions("block", "bucket")
    )
    return back.mapInArrow(scorer(hash_bits, buckets, n, v, documents, 1 - singles / max(n, 1)), RESULT)


def op10_log_frequency_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a model of those outside the held-out seventh."""
    return score(table(spark, sf_dir, "documents"), bucket_of("doc_id", FOLDS) == HELD_OUT)
