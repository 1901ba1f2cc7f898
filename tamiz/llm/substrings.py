"""Suffix-array deduplication: removes every byte covered by a 100-byte string that starts earlier.

Method: column-wise construction of a collection's Burrows-Wheeler transform. All strings of a
collection take part at once; each round inserts one more symbol of every string, from the last to the first.
The place of a longer suffix follows from counting symbols in the transform, and the common prefix
with its neighbours from the least common prefix between equal symbols, so both are kept up to date by sequential
passes. Neighbours with 100 bytes or more in common are equal strings.

To run it on a cluster, documents are cut into short overlapping strings in such a way that equal
100-byte windows meet. Each window's mark is the smallest hash of its 32-byte substrings; a run
of windows with one mark is one string, of 255 bytes at most. Runs go to a bucket of their mark as hashes and
positions, deduplicated within each block before. Equal runs are answered there: all but the first
are removed. Where one mark has different runs, two of them can only share a window if they agree on `SIDE` bytes before or
after their mark, as a window has so many on one side of it; the bytes of those that do are fetched, and their
collection is built, a few marks at a time; Spark's shuffle files hold the strings between the passes.
A mark with more than `MANY` different runs is a very common string in very many surroundings: its windows
are spread singly and compared by two 64-bit hashes, which gives the same answer.

Order is by doc_id (null last), then position. Rows with one id, or without any, and different texts are different documents,
in the order of the texts' hashes. Repeated rows (same id or both without, same text) are one
document and answered alike. Null texts count as empty; those below 100 bytes lose nothing, longer ones are read whole
whatever their length. An empty table stays empty. Other columns are not looked at, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.llm.common import partitions, staged, texts
from tamiz.llm.kernels import chunks, mix, pack, pack_sorted, text_bytes, unpack, unpack_sorted
from tamiz.llm.language_model import grouped, split
from tamiz.operators.numbering import number_rows
from tamiz.queries.base import table
from tamiz.runtime import small_side

LENGTH = 100
MARK = 32
# A window around a mark reaches at least so far to one side of it.
SIDE = (LENGTH - MARK) // 2
LONGEST = 255
MANY = 4096
CHUNK_BYTES = 1 << 20
BLOCK_BYTES = 16 << 20
COLLECTION_BYTES = 1 << 18
OUT_BYTES = 4 << 20
# Where rows without id stand, and the bits of a place that are its position in the text.
NO_ID = (1 << 63) - 1
PLACE_BITS = 32

_SYMBOL = np.random.default_rng(3).integers(0, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_POWER), -1, 1 << 64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Hasher:
    """64-bit hashes of substrings, from running sums of a polynomial with odd base."""

    def __init__(self, data: np.ndarray, table: int = 0):
        weighted = _SYMBOL[table][data] * powers(_POWER, len(data))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(weighted, dtype=np.uint64)])
        self.back = powers(_INVERSE, len(data) + 1)

    def __call__(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[begin]) * self.back[begin] + (end - begin).astype(np.uint64))

    def all(self, length: int) -> np.ndarray:
        """Of every substring of one length."""
        n = len(self.sums) - length
        return mix((self.sums[length:] - self.sums[:n]) * self.back[:n])


def sliding(pick: np.ufunc, values: np.ndarray, width: int) -> np.ndarray:
    """Minimum or maximum of every `width` consecutive values, by doubling."""
    reach = 1
    while 2 * reach <= width:
        values, reach = pick(values[:-reach], values[reach:]), 2 * reach
    return pick(values[: len(values) - (width - reach)], values[width - reach :]) if reach < width else values


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, start in the text, bytes, mark, hash of the bytes, sides) of all runs of windows with one mark. The
    bytes of a run that holds its mark twice are given as negative: such a run may repeat itself. `sides`
    are 16 bits for the bytes on each side of the mark, 0 where the run does not hold so many."""
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64, np.uint32))
    if len(data) < LENGTH:
        return none
    hashes = Hasher(data)
    width = LENGTH - MARK + 1
    short = hashes.all(MARK)
    marks = sliding(np.minimum, short, width)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(marks)]
    inside = np.arange(len(marks)) + LENGTH <= offsets[row + 1]
    at = np.flatnonzero(inside)
    if not len(at):
        return none
    fresh = np.ones(len(at), bool)
    fresh[1:] = (marks[at[1:]] != marks[at[:-1]]) | (row[at[1:]] != row[at[:-1]])
    first = np.flatnonzero(fresh)
    count = np.diff(first, append=len(at))
    # Long runs are cut, so that no string is longer than LONGEST.
    step = LONGEST - LENGTH + 1
    parts = -(-count // step)
    piece = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    begin = np.repeat(at[first], parts) + piece * step
    windows = np.minimum(np.repeat(count, parts) - piece * step, step)
    size = windows + LENGTH - 1
    # Where marks stand: the substring's hash is the largest of the marks of the windows around it.
    around = np.zeros(len(marks) + 2 * (width - 1), np.uint64)
    around[width - 1 : width - 1 + len(marks)] = marks
    stands = np.flatnonzero(sliding(np.maximum, around, width) == short)
    low, high = np.searchsorted(stands, begin), np.searchsorted(stands, begin + size - MARK, "right")
    held, step, left = np.zeros(len(begin), np.int64), 0, np.arange(len(begin))
    place = np.zeros(len(begin), np.int64)
    while len(left := left[low[left] + step < high[left]]):
        here = stands[low[left] + step]
        own = short[here] == marks[begin[left]]
        held[left] += own
        place[left[own]] = here[own]
        step += 1
    sides = np.zeros(len(begin), np.uint32)
    for shift, first_byte, last_byte in ((0, place - SIDE, place + MARK), (16, place, place + MARK + SIDE)):
        fits = np.flatnonzero((first_byte >= begin) & (last_byte <= begin + size))
        cut = (hashes(first_byte[fits], last_byte[fits]) >> np.uint64(48)).astype(np.uint32) | np.uint32(1)
        sides[fits] |= cut << np.uint32(shift)
    signed = np.where(held > 1, -size, size)
    # Smallest hashes crowd at the low end; scrambled again they fill all buckets alike.
    return row[begin], begin - offsets[row[begin]], signed, mix(marks[begin]), hashes(begin, begin + size), sides


RUN_COLUMNS = ("mark", "content", "sides", "doc", "start", "size")
RUN_SCHEMA = "bucket int, " + ", ".join(f"{c} binary" for c in RUN_COLUMNS)


def block_runs(buckets: int):
    """For mapInArrow: per bucket the first of a block's equal runs, sorted by mark, and, without marks, the
    places of the others, which are removed in any case."""

    def row(bucket: int, columns: list[np.ndarray], part: slice, marked: bool) -> dict:
        mark, content, sides, doc, start, size = (c[part] for c in columns)
        return {
            "bucket": bucket,
            "mark": pack_sorted(mark) if marked else None,
            "content": pack(content) if marked else None,
            "sides": sides.tobytes() if marked else None,
            "doc": pack(doc.view(np.uint64)),
            "start": pack(start.astype(np.uint64)),
            "size": pack(size),
        }

    schema = pa.schema([("bucket", pa.int32()), *((c, pa.binary()) for c in RUN_COLUMNS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in chunks(batch, limit=BLOCK_BYTES):
                found = [[] for _ in RUN_COLUMNS]
                for part in chunks(block, limit=CHUNK_BYTES):
                    rows, start, size, mark, content, sides = runs(*text_bytes(part.column("text")))
                    size = size.view(np.uint64)
                    doc, base = (part.column(c).to_numpy()[rows] for c in ("doc", "base"))
                    start = start + base
                    for held, values in zip(found, (mark, content, sides, doc, start, size), strict=True):
                        held.append(values)
                columns = [np.concatenate(held) for held in found]
                mark, content, sides, doc, start, size = columns
                order = np.lexsort((start, doc, content, mark))
                columns = [c[order] for c in columns]
                first = np.ones(len(order), bool)
                first[1:] = (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1])
                # A repeated row has the very place of the first one and is not later than it.
                head = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
                doc, start = columns[3], columns[4]
                later = ~first & ((doc != doc[head]) | (start != start[head]))
                later = [c[later] for c in columns]
                columns = [c[first] for c in columns]
                borders = split(columns[0], 64, buckets)
                made = [row(b, columns, slice(borders[b], borders[b + 1]), True) for b in np.flatnonzero(np.diff(borders)).tolist()]
                if len(later[0]):
                    made.append(row(int(later[0][0]) % buckets, later, slice(None), False))
                yield pa.RecordBatch.from_pylist(made, schema)

    return run


def places(doc, start, size, mark=None, content=None, many=None) -> pa.RecordBatch:
    n = len(doc)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(doc.astype(np.int64)),
            pa.array(start.astype(np.int64)),
            pa.array(size.astype(np.int64)),
            pa.nulls(n, pa.int64()) if mark is None else pa.array(mark.view(np.int64)),
            pa.nulls(n, pa.bool_()) if many is None else pa.array(many),
        ],
        names=["doc", "start", "size", "mark", "many"],
    )


PLACE_SCHEMA = "doc long, start long, size long, mark long, many boolean"


def may_share(mark: np.ndarray, sides: np.ndarray, own_twice: np.ndarray) -> np.ndarray:
    """Of the different runs, sorted by mark, those that may share a window with another one of their mark or
    repeat themselves. Where a run holds its mark twice, its sides are not known, so all of that mark stay."""
    fresh = np.ones(len(mark), bool)
    fresh[1:] = mark[1:] != mark[:-1]
    member = np.cumsum(fresh) - 1
    chosen = np.bincount(member, own_twice)[member] > 0
    for shift in (0, 16):
        side = (sides >> np.uint32(shift)) & np.uint32(0xFFFF)
        at = np.flatnonzero(side)
        _, group, count = np.unique((member[at].astype(np.uint64) << np.uint64(16)) | side[at], return_inverse=True, return_counts=True)
        chosen[at] |= count[group] > 1
    return chosen


def answer_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Removed places (without mark), and the first places of different runs under one mark."""
    for _, rows in grouped(batches, "bucket"):
        for r in rows:
            if r["mark"] is None:
                doc, start, size = (unpack(r[c]).view(np.int64) for c in ("doc", "start", "size"))
                yield places(doc, start, np.abs(size))
        rows = [r for r in rows if r["mark"] is not None]
        if not rows:
            continue
        mark = np.concatenate([unpack_sorted(r["mark"]) for r in rows])
        content, doc, start, size = (np.concatenate([unpack(r[c]) for r in rows]) for c in ("content", "doc", "start", "size"))
        sides = np.concatenate([np.frombuffer(r["sides"], np.uint32) for r in rows])
        doc, own_twice, size = doc.view(np.int64), size.view(np.int64) < 0, np.abs(size.view(np.int64))
        order = np.lexsort((start, doc, content, mark))
        mark, content, sides, doc, start, size, own_twice = (c[order] for c in (mark, content, sides, doc, start, size, own_twice))
        first = np.ones(len(order), bool)
        first[1:] = (mark[1:] != mark[:-1]) | (content[1:] != content[:-1])
        head = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
        # A repeated row has the very place of the first one and is not later than it.
        later = ~first & ((doc != doc[head]) | (start != start[head]))
        yield places(doc[later], start[later], size[later])
        mark, sides, doc, start, size, own_twice = (c[first] for c in (mark, sides, doc, start, size, own_twice))
        several = may_share(mark, sides, own_twice)
        mark, doc, start, size = (c[several] for c in (mark, doc, start, size))
        _, member, count = np.unique(mark, return_inverse=True, return_counts=True)
        yield places(doc, start, size, mark, many=count[member] > MANY)


def fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the asked places of each text; of marks with many runs the hashes of their windows."""
    names = ["mark", "doc", "start", "text", "one", "two"]
    plain = zstandard.ZstdDecompressor()
    for batch in batches:
        made: list[list] = [[] for _ in names]
        keys = zip(batch.column("doc").to_pylist(), batch.column("base").to_pylist(), strict=True)
        for (doc, base), text, asked in zip(keys, batch.column("packed"), batch.column("asked"), strict=True):
            raw = plain.decompress(text.as_py())
            hashes = None
            for place in asked.as_py():
                begin = place["start"] - base
                end = begin + place["size"]
                if not place["many"]:
                    rows = [(place["mark"], doc, base + begin, raw[begin:end], None, None)]
                else:
                    if hashes is None:
                        flat = np.frombuffer(raw, np.uint8)
                        hashes = [Hasher(flat, k).all(LENGTH).view(np.int64) for k in range(2)]
                    inside = range(begin, end - LENGTH + 1)
                    rows = [(None, doc, base + at, None, int(hashes[0][at]), int(hashes[1][at])) for at in inside]
                for values in rows:
                    for column, value in zip(made, values, strict=True):
                        column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(made, kinds, strict=True)], names=names)


def collection_order(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All suffixes of the strings in order: (string, suffix length, common prefix with the suffix before).

    The transform holds, for the row of every suffix, the symbol before it. It is kept as the sorted rows of each
    symbol, one symbol after the other, which is at once the map to the rows of the suffixes one
    longer: entry k stands for row n + k, after the n empty suffixes. In a round, the symbol before the
    newest suffix of every string makes the next longer suffix at its place. That shares with the suffix of
    the previous row of the same symbol one more than the least common prefix on the way there.
    """
    n = len(strings)
    lengths = np.array([len(s) for s in strings], np.int64)
    ends = np.cumsum(lengths)
    used, flat = np.unique(np.frombuffer(b"".join(strings), np.uint8), return_inverse=True)
    # Collections are small, so rows, and string and length in one number, fit 32 bits.
    width = int(lengths.max(initial=1)).bit_length()
    if (n << width) + ends[-1] + n >> 31:
        raise ValueError("the collection is too large")
    common, code = np.zeros(n, np.int16), np.arange(n, dtype=np.int32) << width
    alive = np.flatnonzero(lengths > 0).astype(np.int32)
    starts = np.zeros(len(used) + 1, np.int64)
    rows, size = np.zeros(0, np.int32), 0
    symbol, place = flat[ends[alive] - 1], alive
    while len(alive):
        rows, own = merged_rows(rows, starts, symbol, place)
        size += 1
        # Common prefixes of the new suffixes and of those after them; rows are still the old ones.
        newest = rows[own]
        same_before, same_after = own > starts[symbol], own + 1 < starts[symbol + 1]
        low = np.concatenate([rows[own[same_before] - 1], newest[same_after]]) + 1
        high = np.concatenate([newest[same_before], rows[own[same_after] + 1]])
        shared = 1 + range_minima(common, low, high)
        place = n + own
        old = np.ones(n + len(rows), bool)
        old[place] = False
        code = inserted(code, old, place, (alive << width) | size)
        common = inserted(common, old, place, np.int16(0))
        common[np.concatenate([place[same_before], place[same_after] + 1])] = shared
        rows = np.flatnonzero(old).astype(np.int32)[rows]
        more = lengths[alive] > size
        alive, place = alive[more], place[more].astype(np.int32)
        symbol = flat[ends[alive] - size - 1]
    return code >> width, code & ((1 << width) - 1), common


def merged_rows(rows: np.ndarray, starts: np.ndarray, symbol: np.ndarray, place: np.ndarray):
    """Put new rows into the sorted rows of their symbols; also where each one now stands. `starts`,
    the border of every symbol's rows, is brought up to date."""
    order = np.lexsort((place, symbol))
    symbol, place = symbol[order], place[order]
    first = np.flatnonzero(np.concatenate([[True], symbol[1:] != symbol[:-1]]))
    at = np.empty(len(order), np.int64)
    for begin, end in zip(first, np.append(first[1:], len(order)), strict=True):
        low, high = starts[symbol[begin]], starts[symbol[begin] + 1]
        at[begin:end] = low + rows[low:high].searchsorted(place[begin:end])
    at += np.arange(len(at))
    old = np.ones(len(rows) + len(at), bool)
    old[at] = False
    own = np.empty(len(at), np.int64)
    own[order] = at
    starts[1:] += np.cumsum(np.bincount(symbol, minlength=len(starts) - 1))
    return inserted(rows, old, at, place), own


def inserted(values: np.ndarray, old: np.ndarray, place: np.ndarray, new) -> np.ndarray:
    out = np.empty(len(old), values.dtype)
    out[old] = values
    out[place] = new
    return out


def range_minima(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minimum of values[low..high] for every pair."""
    if not len(low):
        return np.zeros(0, values.dtype)
    order = np.argsort(low)
    borders = np.stack([low[order], high[order] + 1], axis=1).ravel()
    out = np.empty(len(low), values.dtype)
    out[order] = np.minimum.reduceat(np.append(values, values.dtype.type(0)), borders)[::2]
    return out


def repeated_windows(doc: np.ndarray, start: np.ndarray, strings: list[bytes]) -> tuple[np.ndarray, ...]:
    """(doc, start, bytes) covered by windows of the strings that occur earlier within the collection."""
    owner, length, common = collection_order(strings)
    group = np.cumsum(common < LENGTH)
    window = np.flatnonzero(length >= LENGTH)
    owner, length, group = owner[window], length[window].astype(np.int64), group[window]
    sizes = np.array([len(s) for s in strings], np.int64)
    at, own = start[owner] + sizes[owner] - length, doc[owner]
    order = np.lexsort((at, own, group))
    group, at, own = group[order], at[order], own[order]
    first = np.ones(len(group), bool)
    first[1:] = group[1:] != group[:-1]
    head = np.maximum.accumulate(np.where(first, np.arange(len(group)), 0)) if len(group) else first.astype(int)
    later = ~first & ((own != own[head]) | (at != at[head]))
    return joined(own[later], at[later])


def joined(doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows at consecutive positions as one place."""
    order = np.lexsort((at, doc))
    doc, at = doc[order], at[order]
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (at[1:] > at[:-1] + 1)
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], at[first], at[last] - at[first] + LENGTH if len(first) else at[:0]


def collections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Removed places of the strings, which come sorted by mark: whole marks make a collection."""

    def done(held: list[list[dict]]) -> pa.RecordBatch:
        rows = [r for group in held for r in group]
        doc, start = (np.array([r[c] for r in rows], np.int64) for c in ("doc", "start"))
        return places(*repeated_windows(doc, start, [r["text"] for r in rows]))

    held, size = [], 0
    for _, rows in grouped(batches, "mark"):
        held.append(rows)
        size += sum(len(r["text"]) for r in rows)
        if size >= COLLECTION_BYTES:
            yield done(held)
            held, size = [], 0
    if held:
        yield done(held)


def placed(docs: DataFrame) -> DataFrame:
    """doc_id, text, doc and base. A byte of a text stands at its position plus base, which is 0 unless the id
    stands for several texts: these follow each other with gaps, each 2^PLACE_BITS after the one before."""
    doc, own = F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), F.xxhash64("text").alias("own")
    rows = texts(docs).select(F.col("doc_id").cast("long"), "text").select("doc_id", "text", doc, own)
    pairs = rows.select("doc", "own").distinct()
    several = pairs.groupBy("doc").agg(F.count("*").alias("n")).filter("n > 1").select("doc")
    numbered = number_rows(pairs.join(several, "doc", "left_semi"), ["doc", "own"], "number")
    bases = small_side(staged(numbered.select("doc", "own", F.shiftleft("number", PLACE_BITS).alias("base")), "substring-bases"))
    return rows.join(bases, ["doc", "own"], "left").select("doc_id", "text", "doc", F.coalesce("base", F.lit(0).cast("long")).alias("base"))


def base_of(start: str) -> Column:
    return F.shiftleft(F.shiftright(start, PLACE_BITS), PLACE_BITS)


def repeated_places(rows: DataFrame) -> DataFrame:
    """doc, start, size of placed rows: byte ranges, possibly overlapping, whose bytes are all to be removed."""
    spark = rows.sparkSession
    count = partitions(spark)
    buckets = max(64, 1 << (2 * count - 1).bit_length())
    dealt = rows.mapInArrow(block_runs(buckets), RUN_SCHEMA).repartition(count, "bucket").sortWithinPartitions("bucket")
    answered = staged(dealt.mapInArrow(answer_runs, PLACE_SCHEMA), "substring-runs")
    asked = answered.filter("mark IS NOT NULL").groupBy("doc", base_of("start").alias("base")).agg(
        F.collect_list(F.struct("mark", "start", "size", "many")).alias("asked")
    )
    # Merge joins at every size, so that what is shuffled grows with the input alone.
    found = squeezed(rows).select("doc", "base", "packed").join(asked.hint("merge"), ["doc", "base"])
    schema = "mark long, doc long, start long, text binary, one long, two long"
    strings = staged(found.mapInArrow(fetched, schema), "substring-strings")
    sorted_marks = strings.filter("mark IS NOT NULL").select("mark", "doc", "start", "text")
    sorted_marks = sorted_marks.dropDuplicates(["mark", "doc", "start"]).repartition(count, "mark").sortWithinPartitions("mark")
    built = sorted_marks.mapInArrow(collections, PLACE_SCHEMA)
    spread = strings.filter("mark IS NULL").select("one", "two", F.struct("doc", "start").alias("place"))
    first = spread.groupBy("one", "two").agg(F.min("place").alias("first"), F.count("*").alias("n")).filter("n > 1")
    windows = spread.join(first, ["one", "two"]).filter("place <> first").select(
        "place.doc", "place.start", F.lit(LENGTH).cast("long").alias("size")
    )
    columns = ["doc", "start", "size"]
    return answered.filter("mark IS NULL").select(*columns).union(built.select(*columns)).union(windows.select(*columns))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def squeezed(rows: DataFrame) -> DataFrame:
    """Placed rows with their bytes compressed one by one, so that less is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        smaller = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for part in chunks(batch):
                packed = [smaller.compress(text.as_py()) for text in part.column("text").cast(pa.binary())]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(packed, pa.binary())], names=["doc_id", "doc", "base", "packed"])

    return rows.select("doc_id", "doc", "base", "text").mapInArrow(run, "doc_id long, doc long, base long, packed binary")


def cut_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "n_removed", "spans", "kept"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])), pa.binary()]
    plain = zstandard.ZstdDecompressor()

    def made(rows: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names=names)

    rows, size = [[] for _ in names], 0
    for batch in batches:
        columns = (batch.column(c) for c in ("packed", "starts", "sizes"))
        for doc, packed, starts, sizes in zip(batch.column("doc_id").to_pylist(), *columns, strict=True):
            raw = plain.decompress(packed.as_py())
            spans = []
            if starts.is_valid:
                begin, reach = starts.values.to_numpy(), sizes.values.to_numpy()
                spans = merged(list(zip(begin.tolist(), (begin + reach).tolist(), strict=True)))
            kept, at = [], 0
            for begin, end in spans:
                kept.append(raw[at:begin])
                at = end
            kept.append(raw[at:])
            values = (doc, len(raw), sum(e - b for b, e in spans), [{"begin": b, "end": e} for b, e in spans], b"".join(kept))
            for column, value in zip(rows, values, strict=True):
                column.append(value)
            size += len(raw)
            if size >= OUT_BYTES:
                yield made(rows)
                rows, size = [[] for _ in names], 0
    yield made(rows)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (removed byte ranges) and kept (remaining bytes) of every row."""
    rows = placed(docs)
    held = repeated_places(rows).withColumn("base", base_of("start"))
    spans = held.groupBy("doc", "base").agg(F.collect_list(F.struct((F.col("start") - F.col("base")).alias("start"), "size")).alias("_s"))
    spans = spans.select("doc", "base", F.col("_s.start").alias("starts"), F.col("_s.size").alias("sizes"))
    joined_rows = squeezed(rows).join(spans.hint("merge"), ["doc", "base"], "left").select("doc_id", "packed", "starts", "sizes")
    schema = "doc_id long, n_bytes long, n_removed long, spans array<struct<begin: long, end: long>>, kept binary"
    return joined_rows.mapInArrow(cut_texts, schema)


def op3_collection_bwt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without bytes of 100-byte strings that start earlier."""
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
