"""Exact Jaccard self-join of documents over word shingles, and the groups it links.

Method: set-relation skipping. A document's set holds its distinct five-word shingles. Equal sets are one
class. Classes are indexed by their prefix: the first n - ceil(0.8 n) + 1 shingles in one order of
all shingles, frequent ones last, so that two similar sets share a prefix shingle. An index list is
ordered by set size and cut into blocks; a block is skipped if its sizes or positions rule out
the overlap that the threshold asks for. Long lists are answered in two steps. First every set of a list is compared with the
list's leader, the set that has this shingle at the earliest position, which is the one that shares most. The
answers of the others derive from the leader's: sets already in one group need no comparison, nor do
sets whose distances from a common leader differ by more than 0.2, as Jaccard distance is a metric.
Every set also has a sketch, a bitmap of two to four bits per shingle. A bit that only one of two sets has stands for a shingle that the
other lacks, so sketches bound the common size from above; a pair below the threshold by that is dropped before any set moves.
Only what remains is compared, so a group of many near copies costs about as many comparisons as it has sets. Pairs are
compared in cells of a few hundred sets around a common partner, and a set moves once to each of its cells.

Nulls count as empty texts; without words a document has an empty set and is linked with nothing.
Rows with a null id take the group of the texts linked with theirs, else null; repeated rows and ids are
answered row by row. Sets are told apart by 64-bit hashes. An empty table has an empty result, texts of any length are read whole, and
other columns are carried along or ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.llm.common import connected_components, partitions, staged, texts
from tamiz.llm.kernels import (
    chunks,
    counted,
    mix,
    of_rows,
    pack,
    pack_sorted,
    shingles,
    text_bytes,
    unpack,
    unpack_sorted,
    words,
)
from tamiz.llm.language_model import grouped, split
from tamiz.queries.base import table
from tamiz.runtime import small_side

# Two sets are linked if 100 * common >= PERCENT * union.
PERCENT = 80
BLOCK_BYTES = 32 << 20
FREQUENT = 4
MOST_FREQUENT = 1 << 20
LIST_BLOCK = 128
SHORT_LIST = 8
CELL_SETS = 256
# Sets whose distances from a third differ by more than this cannot be linked.
FAR = 1 - PERCENT / 100 + 1e-9
# Sketches are compared in slices of about this many bytes.
SKETCH_BYTES = 4 << 20
_SALT = np.uint64(0xA24BAED4963EE407)


def overlap_needed(both: np.ndarray) -> np.ndarray:
    """Smallest common size with which two sets of `both` shingles in all are linked."""
    return (PERCENT * both + 99 + PERCENT) // (100 + PERCENT)


def gram_sets(part: pa.RecordBatch, frequent: np.ndarray | None = None):
    """(values, begins, keys): each row's distinct shingles, by hash or with frequent ones last, and
    a key of each set."""
    values, begins = shingles(*words(*text_bytes(part.column("text"))))
    row = np.repeat(np.arange(part.num_rows), np.diff(begins))
    late = np.zeros(len(values), bool)
    if frequent is not None and len(frequent) and len(values):
        late = frequent[np.minimum(np.searchsorted(frequent, values), len(frequent) - 1)] == values
    order = np.lexsort((values, late, row))
    values, row = values[order], row[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    values, row = values[fresh], row[fresh]
    begins = np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int64)
    keys = mix(of_rows(mix(values ^ _SALT), begins, np.add, np.uint64(0)) + np.diff(begins).astype(np.uint64))
    return values, begins, keys


def sketches(values: np.ndarray, begins: np.ndarray) -> pa.Array:
    """A bitmap of each row's shingles as binary: a power of two of bits, two to four times their number, 64 at least."""
    n = np.diff(begins)
    bits = np.int64(1) << np.ceil(np.log2(np.maximum(2 * n, 64))).astype(np.int64)
    bits[n == 0] = 0
    ends = np.concatenate([[0], np.cumsum(bits)])
    row = np.repeat(np.arange(len(n)), n)
    flags = np.zeros(ends[-1], bool)
    flags[ends[row] + (values & (bits[row] - 1).astype(np.uint64)).astype(np.int64)] = True
    data = np.packbits(flags, bitorder="little")
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer((ends // 8).astype(np.int32)), pa.py_buffer(data)])


def folded(sketch: np.ndarray, size: int) -> np.ndarray:
    """Sketches, one per row, with their bits folded to `size` bytes."""
    while sketch.shape[1] > size:
        half = sketch.shape[1] // 2
        sketch = sketch[:, :half] | sketch[:, half:]
    return sketch


class Sketches:
    """The sketches of some sets, and an upper bound of what two of them have in common."""

    def __init__(self, raw: list[bytes], n: np.ndarray):
        self.n, self.size = n, np.array([len(r) for r in raw], np.int64)
        self.by, self.place = {}, np.zeros(len(raw), np.int64)
        for size in np.unique(self.size):
            own = np.flatnonzero(self.size == size)
            self.place[own] = np.arange(len(own))
            self.by[int(size)] = np.frombuffer(b"".join(raw[k] for k in own), np.uint8).reshape(len(own), size)

    def rows(self, at: np.ndarray, size: int) -> np.ndarray:
        made = np.empty((len(at), size), np.uint8)
        for wide in np.unique(self.size[at]):
            own = self.size[at] == wide
            made[own] = folded(self.by[int(wide)][self.place[at[own]]], size)
        return made

    def may_link(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether the sketches of the pairs (i, j) allow the overlap that a link needs."""
        fit = np.zeros(len(i), bool)
        both = np.minimum(self.size[i], self.size[j])
        for size in np.unique(both):
            every = np.flatnonzero(both == size)
            step = max(1, SKETCH_BYTES // int(size))
            for start in range(0, len(every), step):
                at = every[start : start + step]
                a, b = self.rows(i[at], int(size)), self.rows(j[at], int(size))
                common = np.minimum(
                    self.n[i[at]] - np.bitwise_count(a & ~b).sum(1, dtype=np.int64),
                    self.n[j[at]] - np.bitwise_count(b & ~a).sum(1, dtype=np.int64),
                )
                fit[at] = common >= overlap_needed(self.n[i[at]] + self.n[j[at]])
        return fit


def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document with its set's size, key and sketch, and rows with the shingles that occur
    in `FREQUENT` documents of a block or more."""
    for batch in batches:
        for block in chunks(batch, limit=BLOCK_BYTES):
            seen = []
            for part in chunks(block):
                values, begins, keys = gram_sets(part)
                seen.append(values)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(np.diff(begins)),
                        pa.array(keys.view(np.int64)),
                        pa.nulls(part.num_rows, pa.int64()),
                        sketches(values, begins),
                    ],
                    names=["doc_id", "n_shingles", "key", "gram", "sketch"],
                )
            grams, counts = counted(np.concatenate(seen), np.ones(sum(map(len, seen)), np.int64))
            often = counts >= FREQUENT
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(int(often.sum()), pa.int64()),
                    pa.array(counts[often]),
                    pa.nulls(int(often.sum()), pa.int64()),
                    pa.array(grams[often].view(np.int64)),
                    pa.nulls(int(often.sum()), pa.binary()),
                ],
                names=["doc_id", "n_shingles", "key", "gram", "sketch"],
            )


def prefixes(frequent, buckets: int):
    """For mapInArrow: per hash bucket the prefix shingles of a block's sets, as (gram, key,
    size, position), sorted by gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late = frequent.value
        for batch in batches:
            for block in chunks(batch, limit=BLOCK_BYTES):
                found = [[] for _ in range(4)]
                for part in chunks(block):
                    values, begins, keys = gram_sets(part, late)
                    _, first = np.unique(keys, return_index=True)
                    n = np.diff(begins)
                    length = np.zeros(len(n), np.int64)
                    length[first] = np.where(n[first] > 0, n[first] - (PERCENT * n[first] + 99) // 100 + 1, 0)
                    row = np.repeat(np.arange(len(n)), length)
                    at = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)
                    for column, made in zip(found, (values[begins[row] + at], keys[row], n[row], at), strict=True):
                        column.append(made)
                gram, key, n, at = (np.concatenate(c) for c in found)
                order = np.argsort(gram, kind="stable")
                gram, key, n, at = gram[order], key[order], n[order].astype(np.uint64), at[order].astype(np.uint64)
                borders = split(gram, 64, buckets)
                some = np.flatnonzero(np.diff(borders))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(some, pa.int32()),
                        pa.array([pack_sorted(gram[borders[b] : borders[b + 1]]) for b in some], pa.binary()),
                        *(
                            pa.array([pack(c[borders[b] : borders[b + 1]]) for b in some], pa.binary())
                            for c in (key, n, at)
                        ),
                    ],
                    names=["bucket", "gram", "key", "n", "at"],
                )

    return run


def list_pairs(first: np.ndarray, n: np.ndarray, rest: np.ndarray):
    """Pairs (i, j) of entries within index lists that may be similar. Entries are sorted by list and
    size; `first` marks where lists begin, `rest` is how many shingles an entry's set has from here on.

    Every entry meets, block by block, the entries after it in its list. A block ahead is skipped for
    a whole block of entries if its smallest size is too large, or if the most that is left from its
    positions cannot reach the overlap.
    """
    ends = np.append(first[1:], len(n))
    long = ends - first
    # Short lists: all at once, one distance between two entries at a time.
    short = np.repeat(long <= LIST_BLOCK, long)
    last = np.repeat(ends, long)
    i = np.flatnonzero(short)
    for step in range(1, LIST_BLOCK):
        i = i[i + step < last[i]]
        if not len(i):
            break
        yield filtered(i, i + step, n, rest)
    for a, b in zip(first[long > LIST_BLOCK], ends[long > LIST_BLOCK], strict=True):
        for low in range(a, b, LIST_BLOCK):
            own = np.arange(low, min(low + LIST_BLOCK, b))
            largest, reach = n[own].max(), rest[own].max()
            for ahead in range(low, b, LIST_BLOCK):
                other = np.arange(ahead, min(ahead + LIST_BLOCK, b))
                if 100 * largest < PERCENT * n[other[0]]:
                    break
                if min(reach, rest[other].max()) < overlap_needed(n[own[0]] + n[other[0]]):
                    continue
                i, j = (x.ravel() for x in np.meshgrid(own, other, indexing="ij"))
                yield filtered(i[i < j], j[i < j], n, rest)


def filtered(i: np.ndarray, j: np.ndarray, n: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    fit = np.minimum(rest[i], rest[j]) >= overlap_needed(n[i] + n[j])
    return i[fit], j[fit]


def list_starts(gram: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]])) if len(gram) else np.zeros(0, np.int64)


INDEX_COLUMNS = ("x", "y", "x_size", "y_size", "matches", "fitting", "gram", "key", "n", "at")
INDEX_SCHEMA = ", ".join(f"{c} long" for c in INDEX_COLUMNS)


def index_rows(**given: np.ndarray) -> pa.RecordBatch:
    """Rows with the given columns: pairs of sets, entries of long lists, or counts by set."""
    n = len(next(iter(given.values())))
    columns = [
        pa.array(np.ascontiguousarray(given[c]).view(np.int64)) if c in given else pa.nulls(n, pa.int64())
        for c in INDEX_COLUMNS
    ]
    return pa.RecordBatch.from_arrays(columns, names=list(INDEX_COLUMNS))


def short_pairs(gram: np.ndarray, key: np.ndarray, n: np.ndarray, at: np.ndarray) -> pa.RecordBatch | None:
    """All pairs of the short lists whose sizes fit, with how many shingles they share there and at
    how many of them their positions allow the overlap."""
    found = [(i, j) for i, j in list_pairs(list_starts(gram), n, n)]
    if not found:
        return None
    i, j = (np.concatenate(c) for c in zip(*found, strict=True))
    fits = (np.minimum(n[i] - at[i], n[j] - at[j]) >= overlap_needed(n[i] + n[j])).astype(np.int64)
    order = np.lexsort((key[j], key[i]))
    i, j, fits = i[order], j[order], fits[order]
    first = np.flatnonzero(np.concatenate([[True], (key[i[1:]] != key[i[:-1]]) | (key[j[1:]] != key[j[:-1]])]))
    if not len(i):
        return None
    return index_rows(
        x=key[i[first]], y=key[j[first]], x_size=n[i[first]], y_size=n[j[first]],
        matches=np.diff(first, append=len(i)), fitting=np.add.reduceat(fits, first),
    )


def long_lists(gram: np.ndarray, key: np.ndarray, n: np.ndarray, at: np.ndarray) -> Iterator[pa.RecordBatch]:
    """In how many long lists each set stands; the entries that may be similar to another of their
    list; and those entries' pairs with the leader of the list."""
    keys, counts = np.unique(key, return_counts=True)
    yield index_rows(key=keys, n=counts)
    useful = np.zeros(len(gram), bool)
    for i, j in list_pairs(list_starts(gram), n, n - at):
        useful[i] = True
        useful[j] = True
    gram, key, n, at = gram[useful], key[useful], n[useful], at[useful]
    if not len(gram):
        return
    yield index_rows(gram=gram, key=key, n=n, at=at)
    # The leader has the fewest shingles before this one: the set with the least of its own.
    starts = list_starts(gram)
    counts = np.diff(starts, append=len(gram))
    best = np.lexsort((key, at, np.repeat(np.arange(len(starts)), counts)))
    i, j = filtered(np.repeat(best[starts], counts), np.arange(len(gram)), n, n - at)
    pairs = np.unique(np.stack([key[i[i != j]], key[j[i != j]]], axis=1), axis=0)
    yield index_rows(x=pairs[:, 0], y=pairs[:, 1])


def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the index lists of each bucket say: see `short_pairs` and `long_lists`."""
    for _, rows in grouped(batches, "bucket"):
        gram = np.concatenate([unpack_sorted(r["gram"]) for r in rows])
        key, n, at = (np.concatenate([unpack(r[c]) for r in rows]) for c in ("key", "n", "at"))
        _, member, size = np.unique(gram, return_inverse=True, return_counts=True)
        several = size[member] > 1
        gram, key, n, at = gram[several], key[several], n[several].astype(np.int64), at[several].astype(np.int64)
        order = np.lexsort((key, n, gram))
        gram, key, n, at = gram[order], key[order], n[order], at[order]
        fresh = np.ones(len(gram), bool)
        fresh[1:] = (gram[1:] != gram[:-1]) | (key[1:] != key[:-1])
        gram, key, n, at = gram[fresh], key[fresh], n[fresh], at[fresh]
        length = np.diff(list_starts(gram), append=len(gram))
        short = np.repeat(length <= SHORT_LIST, length)
        if short.any() and (made := short_pairs(gram[short], key[short], n[short], at[short])):
            yield made
        if not short.all():
            yield from long_lists(gram[~short], key[~short], n[~short], at[~short])


def undecided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of the long lists that the leaders' answers and the sketches leave open. Entries come sorted by gram, each
    with its group, its sketch and one leader at distance d."""
    for batch in whole_lists(batches):
        gram, key, n, at, group, leader = (batch.column(c).to_numpy() for c in ("gram", "key", "n", "at", "group", "leader"))
        d, sketch = batch.column("d").to_numpy(), batch.column("sketch")
        order = np.lexsort((key, n, gram))
        # A list whose sets are all in one group has nothing left to ask.
        first = list_starts(gram[order])
        length = np.diff(first, append=len(gram))
        own = group[order]
        mixed = np.repeat(np.minimum.reduceat(own, first) != np.maximum.reduceat(own, first), length) if len(first) else gram > 0
        order = order[mixed]
        gram, key, n, at, group, leader, d = (c[order] for c in (gram, key, n, at, group, leader, d))
        if not len(gram):
            continue
        known = Sketches([sketch[int(k)].as_py() for k in order], n)
        held = []
        for i, j in list_pairs(list_starts(gram), n, n - at):
            ask = (group[i] != group[j]) & (leader[i] != key[j]) & (leader[j] != key[i])
            ask &= (leader[i] != leader[j]) | (np.abs(d[i] - d[j]) <= FAR)
            i, j = i[ask], j[ask]
            fit = known.may_link(i, j)
            held.append(np.stack([key[i[fit]], key[j[fit]]], axis=1))
        found = np.unique(np.concatenate(held), axis=0) if held else np.zeros((0, 2), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(found[:, k].copy()) for k in (0, 1)], names=["x", "y"])


def whole_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches, sorted by gram, cut only where a list ends."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        gram = batch.column("gram").to_numpy()
        if not len(gram):
            continue
        cut = int(np.searchsorted(gram, gram[-1]))
        if cut or (held and held[-1].column("gram")[0].as_py() != gram[0]):
            done = [*held, batch.slice(0, cut)]
            yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The key and the sorted set, as bytes, of each text."""
    for batch in batches:
        for part in chunks(batch):
            values, begins, keys = gram_sets(part)
            rows = [values[a:b].tobytes() for a, b in zip(begins[:-1], begins[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(rows, pa.binary())], names=["node", "data"]
            )


def compare_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(x, y, common, x_size, y_size) from rows sorted by cell: its sets first, then its pairs."""
    names = ["x", "y", "common", "x_size", "y_size"]
    for _, rows in grouped(batches, "cell"):
        sets = {r["x"]: np.frombuffer(r["data"], np.uint64) for r in rows if r["data"] is not None}
        made = []
        for r in rows:
            if r["data"] is None:
                own, other = sets[r["x"]], sets[r["y"]]
                at = np.minimum(np.searchsorted(own, other), len(own) - 1)
                made.append((r["x"], r["y"], int((own[at] == other).sum()), len(own), len(other)))
        columns = list(zip(*made, strict=True)) if made else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def sketch_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs (x, y) that their sketches leave open, from rows sorted by cell: its sketches first, then its pairs."""
    for _, rows in grouped(batches, "cell"):
        held = [r for r in rows if r["data"] is not None]
        place = {r["x"]: k for k, r in enumerate(held)}
        known = Sketches([r["data"] for r in held], np.array([r["n"] for r in held], np.int64))
        pairs = [(r["x"], r["y"]) for r in rows if r["data"] is None]
        i, j = (np.array([place[p[k]] for p in pairs], np.int64) for k in (0, 1))
        kept = [p for p, fit in zip(pairs, known.may_link(i, j), strict=True) if fit]
        yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in kept], pa.int64()) for k in (0, 1)], names=["x", "y"])


def in_cells(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (x, y) and the sets (node, n, data) they compare, dealt into cells and sorted, sets first.

    Each set belongs to its partner with the most pairs, or to itself if it has more, and so to one of the blocks of about `CELL_SETS`
    of that centre. A pair is compared in the cell of its two blocks, and a set moves once to every cell in which it has
    a pair, not once for every pair. The joins are the same at every size.
    """
    ends = pairs.select(F.col("x").alias("node"), F.col("y").alias("other")).union(pairs.select("y", "x"))
    degree = ends.groupBy("node").agg(F.count("*").alias("_links"))
    partners = ends.join(degree.withColumnRenamed("node", "other"), "other").groupBy("node").agg(
        F.max(F.struct("_links", F.col("other").alias("centre"))).alias("_best")
    )
    own = F.struct("_links", F.col("node").alias("centre"))
    homes = degree.join(partners, "node").select("node", F.greatest(own, "_best")["centre"].alias("centre"))
    several = homes.groupBy("centre").agg(F.ceil(F.count("*") / F.lit(CELL_SETS)).alias("_blocks"))
    block = F.xxhash64("centre", F.pmod(F.xxhash64("node"), F.col("_blocks")))
    blocks = staged(homes.join(several, "centre").select("node", block.alias("block")), "jaccard-blocks")
    placed = (
        pairs.join(blocks.select(F.col("node").alias("x"), F.col("block").alias("_bx")), "x")
        .join(blocks.select(F.col("node").alias("y"), F.col("block").alias("_by")), "y")
        .select(F.xxhash64(F.least("_bx", "_by"), F.greatest("_bx", "_by")).alias("cell"), "x", "y")
    )
    placed = staged(placed, "jaccard-cells")
    used = placed.select("cell", "x").union(placed.select("cell", F.col("y"))).distinct()
    moved = sets.join(used.hint("merge"), F.col("x") == sets["node"]).select("cell", "x", F.lit(None).cast("long").alias("y"), "n", "data")
    asked = placed.select("cell", "x", "y", F.lit(None).cast("long").alias("n"), F.lit(None).cast("binary").alias("data"))
    return moved.unionByName(asked).repartition(partitions(pairs.sparkSession), "cell").sortWithinPartitions("cell")


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The common size of the sets of each pair."""
    return in_cells(pairs, sets).mapInArrow(compare_cells, "x long, y long, common long, x_size long, y_size long")


def plausible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs that their sketches leave open."""
    known = classes.select(F.col("key").alias("node"), "n", F.col("sketch").alias("data"))
    return in_cells(pairs, known).mapInArrow(sketch_cells, "x long, y long")


def sets_of(nodes: DataFrame, classes: DataFrame, rows: DataFrame, few: bool = False) -> DataFrame:
    """The sets of some classes, from the text of one document of each; null ids are found by each other. With `few`
    the ids are counted, and texts stay in place if a broadcast can hold them."""
    ids = classes.join(nodes, classes["key"] == nodes["node"]).select("first_id").distinct()
    ids = small_side(staged(ids, "jaccard-ids")) if few else ids.hint("merge")
    keyed = rows.join(ids, rows["doc_id"].eqNullSafe(ids["first_id"])).select("doc_id", "text")
    # Rows that share an id may add sets nobody asks for, or one set twice; neither changes an answer.
    return keyed.mapInArrow(listed, "node long, data binary").withColumn("n", F.shiftright(F.octet_length("data"), 3).cast("long"))


def nodes_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("x").alias("node")).union(pairs.select("y")).distinct()


def similarity_groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) of every row."""
    spark = docs.sparkSession
    rows = texts(docs).select(F.col("doc_id").cast("long"), "text")
    count = partitions(spark)
    buckets = max(64, 1 << (2 * count - 1).bit_length())
    kinds = "doc_id long, n_shingles long, key long, gram long, sketch binary"
    told = staged(rows.mapInArrow(describe, kinds), "jaccard-sets")
    signed = told.filter("gram IS NULL").select("doc_id", "n_shingles", "key")
    # The most frequent shingles, at most MOST_FREQUENT of them: they only move to the end of the order.
    often = told.filter("gram IS NOT NULL").groupBy("gram").agg(F.sum("n_shingles").alias("n"))
    top = often.orderBy(F.desc("n"), "gram").limit(MOST_FREQUENT).select("gram").toPandas()["gram"]
    late = spark.sparkContext.broadcast(np.sort(top.to_numpy(np.int64).view(np.uint64)))
    # Copies are combined before the shuffle.
    whole = told.filter("n_shingles > 0 AND gram IS NULL").groupBy("key")
    classes = staged(
        whole.agg(F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")), "jaccard-classes"
    )
    index = rows.mapInArrow(prefixes(late, buckets), "bucket int, gram binary, key binary, n binary, at binary")
    dealt = index.repartition(count, "bucket").sortWithinPartitions("bucket")
    listed_rows = staged(dealt.mapInArrow(candidates, INDEX_SCHEMA), "jaccard-index")
    entries = listed_rows.filter("gram IS NOT NULL").select("gram", "key", "n", "at")
    # Step one: short lists whole, long ones against their leaders.
    pairs = staged(plausible(staged(likely_pairs(listed_rows), "jaccard-pairs"), classes), "jaccard-plausible")
    sets = staged(sets_of(nodes_of(pairs), classes, rows), "jaccard-grams")
    first = staged(compared(pairs, sets), "jaccard-first")
    similar = F.expr(f"100 * common >= {PERCENT} * (x_size + y_size - common)")
    links = first.filter(similar).select(F.col("x").alias("a"), F.col("y").alias("b"))
    groups = staged(connected_components(links, "jaccard-near"), "jaccard-near")
    distance = 1 - F.col("common") / (F.col("x_size") + F.col("y_size") - F.col("common"))
    leaders = first.groupBy("y").agg(F.min(F.struct(distance.alias("d"), F.col("x").alias("leader"))).alias("best"))
    # Step two: pairs of long lists that neither step one nor the sketches decide.
    told = entries.join(groups, entries["key"] == groups["node"], "left").drop("node")
    told = told.join(leaders, told["key"] == leaders["y"], "left").join(classes.select("key", "sketch"), "key").select(
        "gram", "key", "n", "at", F.coalesce("component", "key").alias("group"),
        F.coalesce("best.leader", "key").alias("leader"), F.coalesce("best.d", F.lit(0.0)).alias("d"), "sketch",
    )
    open_pairs = told.repartition(count, "gram").sortWithinPartitions("gram").mapInArrow(undecided, "x long, y long")
    open_pairs = staged(open_pairs.distinct(), "jaccard-open")
    # These are few; the texts of sets that step one has not read are read for them.
    unread = nodes_of(open_pairs).join(nodes_of(pairs), "node", "left_anti")
    sets = sets.unionByName(staged(sets_of(unread, classes, rows, few=True), "jaccard-rest"))
    more = compared(open_pairs, sets).filter(similar).select(F.col("x").alias("a"), F.col("y").alias("b"))
    spans = groups.select(F.col("node").alias("a"), F.col("component").alias("b"))
    final = connected_components(spans.union(more), "jaccard-all")
    whole = classes.join(final, classes["key"] == final["node"], "left").select(
        "key", "first_id", F.coalesce("component", "key").alias("component")
    )
    lowest = whole.groupBy("component").agg(F.min("first_id").alias("component_id"))
    answer = whole.join(lowest, "component").select(F.col("key").alias("_key"), "component_id")
    # Documents without words have no class, so nothing is found for them.
    asking = signed.withColumn("_asked", F.when(F.col("n_shingles") > 0, F.col("key")))
    return asking.join(answer, F.col("_asked") == F.col("_key"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def likely_pairs(listed_rows: DataFrame) -> DataFrame:
    """(x, y): the pairs of short lists that can still reach the overlap, and all pairs with leaders.

    Beyond the shared shingles of their prefixes two sets can have no more in common than the longer
    of their rests; shared shingles in long lists are not counted pair by pair, so as many as
    the set with fewer of them has are granted.
    """
    often = listed_rows.filter("gram IS NULL AND key IS NOT NULL").groupBy("key").agg(F.sum("n").alias("long"))
    short = listed_rows.filter("matches IS NOT NULL").groupBy("x", "y").agg(
        F.first("x_size").alias("x_size"), F.first("y_size").alias("y_size"),
        F.sum("matches").alias("matches"), F.sum("fitting").alias("fitting"),
    ).filter("fitting > 0")
    granted = (
        short.join(often.select(F.col("key").alias("x"), F.col("long").alias("x_long")), "x", "left")
        .join(often.select(F.col("key").alias("y"), F.col("long").alias("y_long")), "y", "left")
        .withColumn("granted", F.least(F.coalesce("x_long", F.lit(0)), F.coalesce("y_long", F.lit(0))))
    )
    rest = f"greatest(ceil({PERCENT} * x_size / 100), ceil({PERCENT} * y_size / 100)) - 1"
    needed = f"ceil({PERCENT} * (x_size + y_size) / {100 + PERCENT})"
    fit = granted.filter(f"matches + granted + {rest} >= {needed}").select("x", "y")
    led = listed_rows.filter("x IS NOT NULL AND matches IS NULL").select("x", "y")
    return fit.union(led).distinct()


def one_per_group(docs: DataFrame) -> DataFrame:
    """The documents whose id is the smallest of their group, with all their columns. Rows with one id
    stay or go together, and rows without id stay."""
    kept = similarity_groups(docs).filter("doc_id = component_id").select(F.col("doc_id").alias("_kept")).distinct()
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").alias("_id"))
    led = rows.join(kept, F.col("_id") == F.col("_kept")).select("_row.*")
    return docs.filter("doc_id IS NULL").unionByName(led)


def op7_set_relation_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of all documents linked by a similarity of 0.8 or more."""
    return similarity_groups(table(spark, sf_dir, "documents"))
