"""Hard negatives of embeddings by an STR-packed R-tree.

Method: rows are packed sort-tile-recursively: cut into slabs by label, these by the coordinate of largest variance, sorted
by the next one, and dealt into tiles of at most `TILE` rows; a tile packs its rows in the same way into leaves of `LEAF`. Every
tile and leaf has its minimum bounding box. With the query's positive components taken from a box's upper corner and the negative
ones from its lower corner, a box bounds every inner product inside it from above, and the other way round from below.

A search asks for the `count` best rows within each of a query's score windows. Its queue takes boxes best first; a box is dropped if its
interval lies outside all windows, strictly below the count-th best found so far, or if its labels do not fit. Tiles are the upper level:
each query first searches the tile with the best bound, which raises the windows' lower ends, and then all tiles
that these leave open. Queries meet boxes and rows in blocks (a tile with its rows, and queries as they stream by), never all at once.

All numbers are integers, so no bound is rounded. Of rows that agree in vector and label only the smallest ids can be among the
best, so one more of them than is asked for is kept. Rows that agree in all three count once; with a null id they come last in ties. A
row is no positive of itself; a row with the same id and another vector is. Vectors of different lengths are compared over their
common components. Rows with a null label or vector, or a null or non-finite component, take no part. An empty table, or one without
anchors, gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tamiz.llm.common import partitions, staged
from tamiz.llm.vectors import exact_kind, integer_vectors, matrix
from tamiz.queries.base import table

POSITIVES = 5
NEGATIVES = 3
TILE = 4096
LEAF = 32
# Slabs per sort key at most; the borders of all slabs are a few numbers each.
SLABS = 256
# Boxes that one task holds, and queries that one task searches a tile with.
BOXES = 4096
QUERIES = 1 << 16
# Queries searched at once, and leaves each of them opens before its windows are narrowed again.
SLICE = 128
STEP = 8
NO_ID = (1 << 63) - 1
LOWEST = -(1 << 62)
HIGHEST = 1 << 62


def slabs(rows: DataFrame, count: int) -> DataFrame:
    """The rows with slab1 (of labels), slab2 (of the most spread component within it) and the next component, by which a slab is
    sorted. Borders are quantile sketches, of which there are at most `SLABS` times `SLABS`."""
    own = rows.select(F.posexplode("q").alias("place", "x")).groupBy("place").agg(F.var_pop("x").alias("v"))
    spread = [r.place for r in own.orderBy(F.desc("v"), "place").limit(2).collect()]
    first, second = (spread + [0, 0])[:2]
    cuts = F.array(*[F.lit(k / count) for k in range(1, count)]) if count > 1 else F.array(F.lit(1.0))
    labels = rows.agg(F.percentile_approx("label", cuts)).first()[0] or [0]
    marked = rows.withColumn("slab1", place_of(F.array(*map(F.lit, labels)), F.col("label")))
    keyed = marked.withColumns({"x1": F.coalesce(F.get("q", F.lit(first)), F.lit(0)), "x2": F.coalesce(F.get("q", F.lit(second)), F.lit(0))})
    inner = keyed.groupBy("slab1").agg(F.percentile_approx("x1", cuts).alias("_cuts"))
    return keyed.join(F.broadcast(inner), "slab1").withColumn("slab2", place_of(F.col("_cuts"), F.col("x1"))).drop("_cuts", "x1")


def place_of(borders: Column, value: Column) -> Column:
    """How many borders lie below the value."""
    return F.size(F.filter(borders, lambda b: b < value))


TREE = "tile long, vec_id long, label long, q array<int>, last_label long, high array<int>"


def tiled(limit: int):
    """For mapInArrow: rows in packing order get the number of their tile; after each tile comes its box, which has a last
    label and a high corner beside the first label and the low corner."""
    names = [c.split()[0] for c in TREE.split(", ")]

    def box(tile: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        labels = np.concatenate([b.column("label").to_numpy() for b in held])
        width = widths(*(b.column("q") for b in held))
        q = np.concatenate([matrix(b.column("q"), width) for b in held])
        ints = pa.list_(pa.int32())
        corners = [pa.array([labels.min()]), pa.array([q.min(0)], ints), pa.array([labels.max()]), pa.array([q.max(0)], ints)]
        return pa.RecordBatch.from_arrays([pa.array([tile]), pa.nulls(1, pa.int64()), *corners], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, room, held = TaskContext.get().partitionId() << 32, limit, []
        for whole in batches:
            start = 0
            while start < whole.num_rows:
                batch = whole.slice(start, room)
                n = batch.num_rows
                columns = [pa.array(np.full(n, tile)), *(batch.column(c) for c in ("vec_id", "label", "q"))]
                yield pa.RecordBatch.from_arrays([*columns, pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.int32()))], names=names)
                held.append(batch)
                start, room = start + n, room - n
                if not room:
                    yield box(tile, held)
                    tile, room, held = tile + 1, limit, []
        if held:
            yield box(tile, held)

    return run


def packed_tree(rows: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """(rows with their tile, boxes of the tiles) of rows (vec_id, label, q); `most` copies of a vector and label at most can
    be asked for."""
    order = Window.partitionBy("label", "q").orderBy(F.col("vec_id").asc_nulls_last())
    few = rows.distinct().withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= most).drop("_place")
    few = staged(few.withColumn("vec_id", F.coalesce("vec_id", F.lit(NO_ID))), "tree-rows")
    count = min(SLABS, max(1, round((few.count() / TILE) ** (1 / 3))))
    keys = ["slab1", "slab2", "x2", "vec_id"]
    ranged = slabs(few, count).repartitionByRange(partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys)
    tree = staged(ranged.select("vec_id", "label", "q").mapInArrow(tiled(TILE), TREE), "tree")
    return tree.filter("high IS NULL").select("tile", "vec_id", "label", "q"), tree.filter("high IS NOT NULL").drop("vec_id")


class Boxes:
    """Boxes with the smallest and largest label of each."""

    def __init__(self, low: np.ndarray, high: np.ndarray, first: np.ndarray, last: np.ndarray):
        self.low, self.high, self.first, self.last = low, high, first, last

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(least, most): bounds of the inner products of each row of `q` with what is in each box."""
        kind = exact_kind(q, self.low, self.high)
        up, down = np.maximum(q, 0).astype(kind), np.minimum(q, 0).astype(kind)
        low, high = self.low.astype(kind).T, self.high.astype(kind).T
        return (up @ low + down @ high).astype(np.int64), (up @ high + down @ low).astype(np.int64)

    def fitting(self, label: np.ndarray, same: bool) -> np.ndarray:
        """Whether each box may hold rows of each label, or of another one."""
        label = label[:, None]
        return (self.first <= label) & (label <= self.last) if same else (self.first != label) | (self.last != label)


def packing_order(label: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Sort-tile-recursive order of a tile's rows: by label, then the two components of largest variance."""
    spread = np.argsort(-q.astype(float).var(0), kind="stable")[:2]
    keys = [label, *(q[:, k] for k in spread)]
    slices = max(1, round((len(label) / LEAF) ** (1 / len(keys))))

    def cut(rows: np.ndarray, level: int) -> list[np.ndarray]:
        rows = rows[np.argsort(keys[level][rows], kind="stable")]
        if level + 1 == len(keys):
            return [rows]
        size = -(-len(rows) // slices)
        return [x for a in range(0, len(rows), size) for x in cut(rows[a : a + size], level + 1)]

    return np.concatenate(cut(np.arange(len(label)), 0))


class Tree:
    """The leaves of one tile."""

    def __init__(self, ids: np.ndarray, label: np.ndarray, q: np.ndarray):
        order = packing_order(label, q)
        leaves = -(-len(order) // LEAF)
        # The last leaf is filled up with its last row; `real` tells them apart.
        filled = np.concatenate([order, np.repeat(order[-1:], leaves * LEAF - len(order))]).reshape(leaves, LEAF)
        self.ids, self.label, self.q = ids[filled], label[filled], q[filled]
        self.real = (np.arange(leaves * LEAF) < len(order)).reshape(leaves, LEAF)
        self.boxes = Boxes(self.q.min(1), self.q.max(1), self.label.min(1), self.label.max(1))
        wide = self.q.astype(np.int64)
        self.norm = (wide * wide).sum(2)

    def search(self, ids, label, q, low, high, same: bool, count: int):
        """(query, window, id, score): up to `count` best rows of each query's windows [low, high], best first."""
        m, windows = low.shape
        least, most = self.boxes.bounds(q)
        fit = self.boxes.fitting(label, same)
        rank = np.where(fit, most, LOWEST - 1)
        queue = np.argsort(-rank, 1, kind="stable")
        kind = exact_kind(q, self.q.reshape(-1, self.q.shape[2]))
        rows, asked = self.q.astype(kind), q.astype(kind)
        norm = (q.astype(np.int64) ** 2).sum(1)
        best = np.full((m, windows, count), LOWEST)
        who = np.full((m, windows, count), NO_ID)
        floor, active = low.copy(), np.arange(m)
        for step in range(0, queue.shape[1], STEP):
            # Boxes come by their upper bounds, so a query is done once the next is below all its windows.
            ahead = queue[active, step]
            active = active[rank[active, ahead] >= floor[active].min(1)]
            if not len(active):
                break
            leaf = queue[active, step : step + STEP]
            top, bottom = rank[active[:, None], leaf], least[active[:, None], leaf]
            open_ = ((top[:, :, None] >= floor[active][:, None]) & (bottom[:, :, None] <= high[active][:, None])).any(2)
            at, k = np.nonzero(open_ & fit[active[:, None], leaf])
            if not len(at):
                continue
            own, box = active[at], leaf[at, k]
            score = (rows[box] @ asked[own][:, :, None])[:, :, 0].astype(np.int64)
            alike = self.label[box] == label[own][:, None]
            itself = alike & (self.ids[box] == ids[own][:, None]) & (score == norm[own][:, None]) & (self.norm[box] == norm[own][:, None])
            usable = self.real[box] & (alike == same) & ~itself
            for w in range(windows):
                hit, place = np.nonzero(usable & (score >= floor[own, w][:, None]) & (score <= high[own, w][:, None]))
                if len(hit):
                    narrowed = merge(best[:, w], who[:, w], own[hit], score[hit, place], self.ids[box[hit], place])
                    floor[narrowed, w] = np.maximum(low[narrowed, w], best[narrowed, w, -1])
        query, window, k = np.nonzero(best > LOWEST)
        return query, window, who[query, window, k], best[query, window, k]


def merge(best: np.ndarray, who: np.ndarray, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Take found rows into the queries' lists, which are sorted by score and id; returns the queries concerned."""
    count = best.shape[1]
    asked = np.unique(query)
    held = best[asked] > LOWEST
    rows = np.concatenate([np.repeat(asked, count)[held.ravel()], query])
    scores = np.concatenate([best[asked][held], score])
    names = np.concatenate([who[asked][held], ids])
    order = np.lexsort((names, -scores, rows))
    rows, scores, names = rows[order], scores[order], names[order]
    start = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    place = np.arange(len(rows)) - np.repeat(start, np.diff(start, append=len(rows)))
    kept = place < count
    best[rows[kept], place[kept]], who[rows[kept], place[kept]] = scores[kept], names[kept]
    return asked


MIXED = ["block", "part", "tile", "query", "vec_id", "label", "q", "last_label", "high", "lows", "highs", "skip"]


def windows_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The windows of each query; missing ones are empty."""
    width = int(np.diff(batch.column("lows").offsets.to_numpy()).max(initial=1))
    low, high = (matrix(batch.column(c), width).astype(np.int64) for c in ("lows", "highs"))
    size = np.diff(batch.column("lows").offsets.to_numpy())
    gone = (np.arange(width) >= size[:, None]) | (low > high)
    low[gone], high[gone] = HIGHEST, LOWEST
    return low, high


def by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, Iterator[pa.RecordBatch]]]:
    """For rows sorted by block, part and kind: what a block holds, and its queries as they come. Every block has contents; the
    queries must be used up before the next one is asked for."""
    pieces = cut_up(batches)
    ahead = next(pieces, None)
    while ahead is not None:
        key, held = ahead[0], []
        while ahead is not None and ahead[0] == key and not ahead[1]:
            held.append(ahead[2])
            ahead = next(pieces, None)

        def own():
            nonlocal ahead
            while ahead is not None and ahead[0] == key:
                yield ahead[2]
                ahead = next(pieces, None)

        if held:
            yield pa.Table.from_batches(held).combine_chunks(), own()
        for _ in own():
            pass


def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], bool, pa.RecordBatch]]:
    """((block, part), is it of queries, rows) in the order of the input."""
    for batch in batches:
        if not batch.num_rows:
            continue
        block, part = (batch.column(c).to_numpy() for c in ("block", "part"))
        asking = np.asarray(batch.column("query").is_valid())
        edges = (block[1:] != block[:-1]) | (part[1:] != part[:-1]) | (asking[1:] != asking[:-1])
        starts = np.concatenate([[0], np.flatnonzero(edges) + 1, [batch.num_rows]])
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            for c in range(a, b, SLICE) if asking[a] else (a,):
                yield (int(block[a]), int(part[a])), bool(asking[a]), batch.slice(c, min(SLICE, b - c) if asking[a] else b - a)


def widths(*columns: pa.Array) -> int:
    return max(int(np.diff(c.offsets.to_numpy()).max(initial=0)) for c in columns)


def open_tiles(same: bool, only_best: bool):
    """For mapInArrow: (query, tile) for each box that a query's windows and label leave open, but for the tile it has
    searched before; with `only_best` the one with the largest upper bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, asking in by_block(batches):
            low, high = (held.column(c).combine_chunks() for c in ("q", "high"))
            low, high = (c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in (low, high))
            tiles, wide = held.column("tile").to_numpy(), widths(low, high)
            first, last = (held.column(c).to_numpy() for c in ("label", "last_label"))
            for batch in asking:
                width = max(wide, widths(batch.column("q")))
                boxes = Boxes(matrix(low, width), matrix(high, width), first, last)
                least, most = boxes.bounds(matrix(batch.column("q"), width))
                floor, ceiling = windows_of(batch)
                skip = batch.column("skip").fill_null(-1).to_numpy()
                fit = boxes.fitting(batch.column("label").to_numpy(), same) & (tiles != skip[:, None])
                reach = np.zeros(fit.shape, bool)
                for w in range(floor.shape[1]):
                    reach |= (most >= floor[:, w : w + 1]) & (least <= ceiling[:, w : w + 1])
                fit &= reach
                query = batch.column("query").to_numpy()
                if only_best:
                    place = np.where(fit, most, LOWEST - 1).argmax(1)
                    some = fit[np.arange(len(query)), place]
                    at, k, bound = np.flatnonzero(some), place[some], most[some, place[some]]
                else:
                    at, k = np.nonzero(fit)
                    bound = most[at, k]
                yield pa.RecordBatch.from_arrays([pa.array(query[at]), pa.array(tiles[k]), pa.array(bound)], names=["query", "tile", "bound"])

    return run


def searched(same: bool, count: int):
    """For mapInArrow: (query, window, vec_id, score) found in each tile by the queries sent to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, asking in by_block(batches):
            column = held.column("q").combine_chunks()
            column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
            ids, label = (held.column(c).to_numpy() for c in ("vec_id", "label"))
            tree, wide = None, -1
            for batch in asking:
                width = max(wide, widths(column, batch.column("q")))
                if width > wide:
                    tree, wide = Tree(ids, label, matrix(column, width)), width
                low, high = windows_of(batch)
                own = [batch.column(c).to_numpy() for c in ("vec_id", "label")]
                query, window, who, score = tree.search(*own, matrix(batch.column("q"), wide), low, high, same, count)
                names = ["query", "window", "vec_id", "score"]
                query = batch.column("query").to_numpy()[query]
                yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(window), pa.array(who), pa.array(score)], names=names)

    return run


def in_blocks(contents: DataFrame, queries: DataFrame, parts: int | Column, spark: SparkSession) -> DataFrame:
    """Contents (block, ...) and queries (block, part, ...) dealt by block and part, contents first and copied to each part."""
    kinds = {"block": "long", "part": "int", "tile": "long", "query": "long", "vec_id": "long", "label": "long", "q": "array<int>",
             "last_label": "long", "high": "array<int>", "lows": "array<long>", "highs": "array<long>", "skip": "long"}

    def full(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(kinds[c]).alias(c) for c in MIXED])

    held = contents.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1 if isinstance(parts, Column) else F.lit(parts - 1))))
    both = full(held).unionByName(full(queries))
    dealt = both.repartition(partitions(spark), "block", "part")
    return dealt.sortWithinPartitions("block", "part", F.col("query").asc_nulls_first())


def reached(queries: DataFrame, boxes: DataFrame, same: bool, only_best: bool) -> DataFrame:
    """(query, tile) to be searched. Boxes stand in blocks of about `BOXES`; every query meets every block."""
    spark = queries.sparkSession
    blocks = max(1, -(-boxes.count() // BOXES))
    parts = partitions(spark)
    held = boxes.withColumn("block", F.pmod(F.xxhash64("tile"), F.lit(blocks)))
    asking = queries.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    asking = asking.withColumn("part", F.pmod(F.xxhash64("query"), F.lit(parts)).cast("int"))
    found = in_blocks(held, asking, parts, spark).mapInArrow(open_tiles(same, only_best), "query long, tile long, bound long")
    if only_best and blocks > 1:
        best = F.max(F.struct("bound", "tile")).alias("_best")
        found = found.groupBy("query").agg(best).select("query", F.col("_best.tile").alias("tile"))
    return found.select("query", "tile")


def found_in(pairs: DataFrame, queries: DataFrame, rows: DataFrame, same: bool, count: int) -> DataFrame:
    """What the queries find in the tiles they are paired with."""
    asked = staged(pairs, "tree-pairs")
    load = asked.groupBy("tile").agg(F.ceil(F.count("*") / F.lit(QUERIES)).cast("int").alias("_parts"))
    held = rows.join(load, "tile").withColumn("block", F.col("tile"))
    asking = asked.join(load, "tile").withColumn("part", F.pmod(F.xxhash64("query"), F.col("_parts")).cast("int"))
    asking = asking.select("query", F.col("tile").alias("block"), "part").join(queries, "query")
    dealt = in_blocks(held, asking, F.col("_parts"), rows.sparkSession)
    return dealt.mapInArrow(searched(same, count), "query long, window long, vec_id long, score long")


def best_rows(queries: DataFrame, tree: tuple[DataFrame, DataFrame], same: bool, count: int) -> DataFrame:
    """(query, window, rank, vec_id, score): the `count` best rows with the same or another label in each window of the queries
    (query, vec_id, label, q, lows, highs)."""
    rows, boxes = tree
    order = Window.partitionBy("query", "window").orderBy(F.desc("score"), "vec_id")
    seeds = staged(reached(queries, boxes, same, only_best=True), "tree-seeds")
    first = staged(found_in(seeds, queries, rows, same, count), "tree-first")
    # A window with enough rows begins at the last of them; ties stay inside.
    full = first.groupBy("query", "window").agg(F.count("*").alias("n"), F.min("score").alias("least")).filter(F.col("n") >= count)
    raised = full.groupBy("query").agg(F.map_from_entries(F.collect_list(F.struct("window", "least"))).alias("_raised"))
    narrowed = queries.join(raised, "query", "left").join(seeds.withColumnRenamed("tile", "skip"), "query", "left")
    lows = F.transform("lows", lambda low, k: F.greatest(low, F.coalesce(F.try_element_at("_raised", k.cast("long")), low)))
    narrowed = staged(narrowed.withColumn("lows", F.when(F.col("_raised").isNull(), F.col("lows")).otherwise(lows)).drop("_raised"), "tree-narrowed")
    more = found_in(reached(narrowed, boxes, same, only_best=False), narrowed.drop("skip"), rows, same, count)
    ranked = first.unionByName(more).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= count).select("query", "window", "rank", "vec_id", "score")


def hard_negatives(
    rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = 10, most: int = 19
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of rows (vec_id, label, q): the best rows of another
    label that score between least / 20 and most / 20 of the positive's score."""
    used = rows.filter("label IS NOT NULL")
    tree = packed_tree(used, max(positives, negatives) + 1)
    anchors = used.filter(is_anchor).distinct().withColumn("query", F.monotonically_increasing_id())
    whole = {"lows": F.array(F.lit(LOWEST + 1)), "highs": F.array(F.lit(HIGHEST))}
    anchors = staged(anchors.withColumn("vec_id", F.coalesce("vec_id", F.lit(NO_ID))), "anchors")
    near = staged(best_rows(anchors.withColumns(whole), tree, True, positives).drop("window"), "positives")

    windows = near.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("_near"))
    asked = anchors.join(windows, "query").withColumns({
        "lows": F.transform("_near", lambda p: low_of(p["score"], least)),
        "highs": F.transform("_near", lambda p: high_of(p["score"], most)),
    }).drop("_near")
    hard = best_rows(staged(asked, "anchor-windows"), tree, False, negatives)
    pairs = near.select("query", (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = anchors.select("query", F.col("vec_id").alias("anchor_id"))
    joined = hard.join(pairs, ["query", "window"]).join(named, "query")
    ids = {c: F.nullif(F.col(c), F.lit(NO_ID)) for c in ("anchor_id", "positive_id", "negative_id")}
    return joined.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"}).withColumns(ids).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def high_of(score: Column, share: int) -> Column:
    """floor(score * share / 20), exact for every long."""
    rest = F.pmod(score, F.lit(20))
    return F.call_function("div", score - rest, F.lit(20)) * share + F.floor(rest * share / 20)


def low_of(score: Column, share: int) -> Column:
    """ceil(score * share / 20), exact for every long."""
    return -high_of(-score, share)


def op13_str_tree_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives for each of the five positives of every fiftieth embedding."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    given = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("vec_id"), moved.alias("label"), "embedding")
    rows = staged(integer_vectors(given, ["vec_id", "label"]), "negatives-rows")
    return hard_negatives(rows, F.col("vec_id") % 50 == 0)


OP13_SQL = """
WITH r AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [floor(256 * x::DOUBLE) FOR x IN embedding] AS q
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
    SELECT a.vec_id AS anchor_id, o.vec_id AS other_id, a.label = o.label AS alike, list_inner_product(a.q, o.q)::BIGINT AS score
    FROM r a JOIN r o ON a.vec_id % 50 = 0 AND a.vec_id <> o.vec_id),
p AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER w AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT alike AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY rank <= 3
"""
