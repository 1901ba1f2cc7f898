"""Packing documents into token sequences with little padding.

Method: minimum bin slack. A document's ids, closed by an end id, are cut into pieces of the sequence size and
one remainder. Only the counts of the piece lengths (at most `size` numbers, whatever the
input) reach the driver. There each window takes the largest length left and a subset-sum program
over bitsets, one bit per fill, finds the multiset of lengths that fills the rest most closely;
its counts are traced back through the bitsets, and the window is repeated as often as the lengths last.
If no multiset fills the window, one that fills a smaller power of two exactly is taken before
padding. Spark then ranks the pieces within their lengths and looks up the place of each rank.

Nulls: a null text counts as empty; an empty text is the end id alone. Repeated rows are packed
each for itself; null ids are ordered first. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import os
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.llm.common import running_sums, staged, texts
from tamiz.llm.kernels import chunks, mix
from tamiz.queries.base import table

SIZE = 1024
END = 0
CACHED_WORDS = 1_000_000
CHUNK_BYTES = 1 << 20


class Encoder:
    """Ids of whole texts by a byte-level BPE tokenizer file, each distinct pre-token encoded once.

    The pre-tokens of this kind of tokenizer (contractions; runs of letters, of digits or of other
    characters, with one blank before; white space) are found by numpy over code points and are
    encoded independently of each other, so equal ones share their ids.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.kind = character_kinds()
        self._clear()

    def _clear(self) -> None:
        # Hashes of the known pre-tokens, sorted, and which entry of begin and size each one is.
        self.known, self.entry = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.begin, self.size = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)

    def __call__(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and the first one of each text, with the end."""
        if any(s in t for t in found for s in self.specials):
            own = [self.tokenizer.encode(t, add_special_tokens=False).ids for t in found]
            begins = np.concatenate([[0], np.cumsum([len(i) for i in own])]).astype(np.int64)
            return np.array([i for ids in own for i in ids], np.uint32), begins
        points = np.frombuffer("".join(found).encode("utf-32-le", "surrogatepass"), np.uint32)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in found])]).astype(np.int64)
        if not len(points):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        starts = pretoken_starts(points, offsets, self.kind)
        lengths = np.diff(starts, append=len(points))
        powers = np.full(int(lengths.max()), 0x9E3779B97F4A7C15, np.uint64)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        place = np.arange(len(points)) - np.repeat(starts, lengths)
        hashes = np.add.reduceat((points.astype(np.uint64) + np.uint64(1)) * powers[place], starts)
        distinct, sample, inverse = np.unique(mix(hashes ^ lengths.astype(np.uint64)), return_index=True, return_inverse=True)
        entry = self._entries(distinct, starts[sample], lengths[sample], points)[inverse]
        sizes = self.size[entry].astype(np.int64)
        ends = np.cumsum(sizes)
        index = np.arange(ends[-1]) + np.repeat(self.begin[entry] - (ends - sizes), sizes)
        first = np.searchsorted(starts, offsets)
        return self.ids[index], np.concatenate([[0], ends])[first]

    def _entries(self, distinct: np.ndarray, starts: np.ndarray, lengths: np.ndarray, points: np.ndarray) -> np.ndarray:
        if len(self.known) + len(distinct) > CACHED_WORDS:
            self._clear()
        at = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), bool)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != distinct[inside]
        if new.any():
            ids, sizes = self._encoded(starts[new], lengths[new], points)
            entries = np.arange(len(sizes), dtype=np.int32) + np.int32(len(self.size))
            self.begin = np.concatenate([self.begin, len(self.ids) + np.cumsum(sizes) - sizes])
            self.size = np.concatenate([self.size, sizes.astype(np.int32)])
            self.ids = np.concatenate([self.ids, ids])
            self.known, self.entry = np.insert(self.known, at[new], distinct[new]), np.insert(self.entry, at[new], entries)
            at = np.searchsorted(self.known, distinct)
        return self.entry[at]

    def _encoded(self, starts: np.ndarray, lengths: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all these pre-tokens and how many each one has. They are given as words of one text, which
        the tokenizer encodes one by one: a single result instead of one per word."""
        ends = np.cumsum(lengths)
        held = points[np.arange(ends[-1]) + np.repeat(starts - (ends - lengths), lengths)]
        text = held.tobytes().decode("utf-32-le", "surrogatepass")
        borders = [0, *ends.tolist()]
        words = [text[a:b] for a, b in pairwise(borders)]
        made = self.tokenizer.encode_batch([words], is_pretokenized=True, add_special_tokens=False)[0]
        return np.array(made.ids, np.uint32), np.bincount(np.array(made.word_ids, np.int64), minlength=len(words))


_OTHER, _LETTER, _NUMBER, _SPACE = range(4)


@lru_cache(maxsize=1)
def character_kinds() -> np.ndarray:
    """For every code point whether it is a letter, a number, white space or something else."""
    kinds = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}"), (_SPACE, r"\s")):
        kinds[[ord(c) for c in regex.findall(pattern, every)]] = kind
    return kinds


def pretoken_starts(points: np.ndarray, offsets: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    n = len(points)
    kind = kinds[points]
    begins = np.zeros(n + 1, bool)
    begins[offsets] = True
    blank = kind == _SPACE
    start = begins[:n].copy()
    # A run starts where the kind changes, except after a blank, which the run takes along.
    start[1:] |= (kind[1:] != kind[:-1]) & ~((points[:-1] == 0x20) & ~blank[1:])
    # The last white space before something else stands apart from the white space before it.
    last = blank[:-1] & ~blank[1:] & ~begins[1:n]
    start[:-1] |= last
    # Contractions: an apostrophe that starts a pre-token, and one or two given letters.
    quotes = np.flatnonzero((points == 0x27) & start)
    if len(quotes):
        padded = np.concatenate([points, np.zeros(3, np.uint32)])
        ends = np.concatenate([begins, np.ones(3, bool)])
        one, two = padded[quotes + 1], padded[quotes + 2]
        inside1, inside2 = ~ends[quotes + 1], ~ends[quotes + 1] & ~ends[quotes + 2]
        short = inside1 & np.isin(one, [ord(c) for c in "stmd"])
        long = inside2 & (((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l")))
        for at, more in ((quotes[short], 2), (quotes[long], 3)):
            start[at + 1] = False
            after = at + more
            start[after[after < n]] = True
    return np.flatnonzero(start)


def pieces(docs: DataFrame, tokenizer: str, size: int = SIZE, with_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of all pieces; with_ids adds the ids themselves
    (little-endian unsigned 32-bit)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(tokenizer)
        for batch in batches:
            for part in chunks(batch, limit=CHUNK_BYTES):
                ids, begins = encode(part.column("text").to_pylist())
                rows = [[] for _ in range(6)]
                for doc, a, b in zip(part.column("doc_id").to_pylist(), begins[:-1], begins[1:], strict=True):
                    own = np.append(ids[a:b], np.uint32(END)).astype("<u4")
                    for at in range(0, len(own), size):
                        raw = own[at : at + size].tobytes()
                        values = (doc, at, len(raw) // 4, zlib.crc32(raw), len(own), raw)
                        for column, value in zip(rows, values, strict=True):
                            column.append(value)
                kinds = [pa.int64()] * 5 + [pa.binary()]
                made = [pa.array(c, k) for c, k in zip(rows, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(made[: 5 + with_ids], names=names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids]
    schema = ", ".join(f"{n} {'binary' if n == 'ids' else 'long'}" for n in names)
    return texts(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, schema)


def fill(counts: dict[int, int], room: int) -> Counter:
    """The multiset of lengths (at most `counts` of each) with the largest total up to `room`."""
    reached, steps, limit = 1, [], (1 << (room + 1)) - 1
    for length in sorted(counts, reverse=True):
        for _ in range(min(counts[length], room // length)):
            grown = (reached | reached << length) & limit
            if grown == reached:
                break
            steps.append((length, reached))
            reached = grown
            if reached >> room & 1:
                break
        if reached >> room & 1:
            break
    chosen, at = Counter(), reached.bit_length() - 1
    for length, before in reversed(steps):
        if not before >> at & 1:
            chosen[length] += 1
            at -= length
    return chosen


def windows(counts: dict[int, int], size: int = SIZE) -> list[tuple[Counter, int]]:
    """(multiset of lengths, how many sequences hold it) until all lengths are used up."""
    left, out = {k: v for k, v in counts.items() if v}, []
    while left:
        largest = max(left)
        others = {k: v - (k == largest) for k, v in left.items() if v - (k == largest)}
        best = fill(others, size - largest) + Counter({largest: 1})
        if sum(k * v for k, v in best.items()) < size:
            capacity = 1 << (size.bit_length() - 2)
            while capacity >= largest:
                exact = fill(others, capacity - largest) + Counter({largest: 1})
                if sum(k * v for k, v in exact.items()) == capacity:
                    best = exact
                    break
                capacity >>= 1
        times = min(left[k] // v for k, v in best.items())
        out.append((best, times))
        for k, v in best.items():
            left[k] -= v * times
            if not left[k]:
                del left[k]
    return out


def places(counts: dict[int, int], size: int = SIZE) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first rank, ranks, per sequence, first sequence, first offset)."""
    rows, used, sequence = [], Counter(), 0
    for multiset, times in windows(counts, size):
        offset = 0
        for length, each in sorted(multiset.items(), reverse=True):
            rows.append((length, used[length], each * times, each, sequence, offset))
            used[length] += each * times
            offset += each * length
        sequence += times
    return rows


def pack(docs: DataFrame, tokenizer: str, size: int = SIZE, with_ids: bool = False) -> DataFrame:
    """The pieces with sequence_id and offset."""
    spark = docs.sparkSession
    cut = staged(pieces(docs, tokenizer, size, with_ids), "pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    # At most `size` lengths in the few windows each occurs in.
    schema = "_length long, _first long, _ranks long, _each long, _sequence long, _offset long"
    plan = spark.createDataFrame(places(counts, size), schema)
    ahead = dict(zip(sorted(counts), accumulate([0, *(counts[k] for k in sorted(counts))]), strict=False))
    firsts = spark.createDataFrame([(k, v) for k, v in ahead.items()], "_l long, _before long")
    narrow = cut.drop("ids").withColumn("_one", F.lit(1))
    ranked = (
        running_sums(narrow, ["length", "doc_id", "start", "ids_crc32"], {"_rank": "_one"}, "piece-order")
        .join(F.broadcast(firsts), F.col("length") == F.col("_l"))
        .withColumn("_rank", F.col("_rank") - F.col("_before"))
    )
    within = (F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_first") + F.col("_ranks"))
    nth = F.col("_rank") - F.col("_first")
    packed = ranked.join(F.broadcast(plan), (F.col("length") == F.col("_length")) & within).select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        (F.col("_sequence") + F.floor(nth / F.col("_each"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + F.pmod(nth, F.col("_each")) * F.col("length")).cast("long").alias("offset"),
    )
    if not with_ids:
        return packed
    ids = cut.select(F.col("doc_id").alias("_d"), F.col("start").alias("_s"), F.col("ids_crc32").alias("_c"), "ids")
    ids = ids.dropDuplicates(["_d", "_s", "_c"])
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("start") == F.col("_s")) & (F.col("ids_crc32") == F.col("_c"))
    return packed.join(ids, same).drop("_d", "_s", "_c")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids (binary) and n_tokens; a sequence never holds more than its size."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.aggregate(parts, F.lit(b""), lambda a, b: F.concat(a, b["ids"])).alias("ids"),
        F.sum("length").alias("n_tokens"),
    )


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op8_minimum_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    return pack(table(spark, sf_dir, "documents"), tokenizer_path())
