"""Centroid clustering with ns-bounds.

Method: every vector keeps its centroid, an upper bound of the distance to it, and for each group of a few centroids a lower
bound of the distance to any other centroid of the group, each with the round in which it was evaluated. The centroids of
all rounds are retained. A bound is loosened by the norm of the centroid's total displacement since that
round, which is never more than the sum of its drifts per round. Groups whose loosened bound stays above the upper bound
are skipped; the others are rescanned exactly, in integers, after the distance to the own centroid
has been made exact. Bounds are rounded to the safe side, so the result is that of a full scan, ties included.

Vectors and bounds are rewritten to the shared folder in each round by tasks that never shuffle them. A task also sums its vectors by
centroid; those sums are added up by Spark, and one row per centroid and component reaches the driver, which depends on the
parameters alone.

Vectors that are null, of another length, or hold a null or non-finite component are left out; components are floor(256 * x).
Rows are counted one by one: repeated rows and ids are vectors of their own. A null id counts as the empty text where the start is drawn.
Ties there go to the smaller vector. With fewer vectors than centroids all are centroids; an empty table gives an empty
result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tamiz.llm.common import staged
from tamiz.llm.vectors import exact_kind, integer_vectors, matrix
from tamiz.queries.base import table

CENTROIDS = 40
ROUNDS = 5
DIMENSION = 64
SEED = 2
# Centroids that share a lower bound.
GROUP = 5
SLICE = 4096
# Relative room for rounding in square roots and in bounds stored as 32-bit floats.
UP, DOWN = 1 + 1e-6, 1 - 1e-6
NONE = np.int64((1 << 63) - 1)


def squared(q: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of `q` to all centroids."""
    kind = exact_kind(q, centroids)
    a, b = q.astype(kind), centroids.astype(kind)
    return ((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T)).astype(np.int64)


def own_squared(q: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of `q` to the row of `centroids` at the same place."""
    apart = q.astype(np.int64) - centroids
    return (apart * apart).sum(1)


class Bounds:
    """What is known of a slice of vectors: `cluster`, its squared distance `d2` in round `seen`, and per group of centroids
    the lower bound `low` of all others in it, evaluated in round `when`."""

    def __init__(self, cluster: np.ndarray, d2: np.ndarray, seen: np.ndarray, low: np.ndarray, when: np.ndarray):
        self.cluster, self.d2, self.seen, self.low, self.when = cluster, d2, seen, low, when

    @staticmethod
    def unknown(n: int, groups: int) -> Bounds:
        zeros = np.zeros(n, np.int64)
        return Bounds(zeros, zeros.copy(), zeros.copy(), np.full((n, groups), -np.inf, np.float32), np.zeros((n, groups), np.uint8))

    def assign(self, q: np.ndarray, history: np.ndarray, groups: list[np.ndarray]) -> int:
        """Move every vector to its nearest centroid of the last round; returns how many distances were computed."""
        now, every = len(history) - 1, np.arange(len(groups))
        centroids = history[now]
        moved = np.sqrt(((centroids - history) ** 2).sum(2).astype(float)) * UP
        farthest = np.stack([moved[:, g].max(1) for g in groups], 1)
        upper = np.sqrt(self.d2) * UP + moved[self.seen, self.cluster]
        lower = self.low - farthest[self.when, every]
        undecided = lower <= upper[:, None]
        rows = np.flatnonzero(undecided.any(1))
        self.d2[rows] = own_squared(q[rows], centroids[self.cluster[rows]])
        self.seen[rows] = now
        undecided[rows] = lower[rows] <= (np.sqrt(self.d2[rows]) * UP)[:, None]
        best, best_d2, computed = self.cluster.copy(), self.d2.copy(), len(rows)
        second = np.full(self.low.shape, NONE)
        for g, members in enumerate(groups):
            at = np.flatnonzero(undecided[:, g])
            if not len(at):
                continue
            d2 = squared(q[at], centroids[members])
            computed += d2.size
            d2[self.cluster[at][:, None] == members] = NONE
            order = np.argsort(d2, 1, kind="stable")
            line = np.arange(len(at))
            nearest, first = members[order[:, 0]], d2[line, order[:, 0]]
            if len(members) > 1:
                second[at, g] = d2[line, order[:, 1]]
            self.low[at, g] = np.sqrt(first.astype(float)) * DOWN
            self.when[at, g] = now
            better = (first < best_d2[at]) | ((first == best_d2[at]) & (nearest < best[at]))
            best[at[better]], best_d2[at[better]] = nearest[better], first[better]
        self._move(best, best_d2, second, lower, undecided, groups, now)
        return computed

    def _move(self, best, best_d2, second, lower, undecided, groups, now) -> None:
        """The centroid left behind now counts for its group's bound, the new one no longer does."""
        group_of = np.repeat(np.arange(len(groups)), [len(g) for g in groups])
        at = np.flatnonzero(best != self.cluster)
        left, joined = group_of[self.cluster[at]], group_of[best[at]]
        behind = np.sqrt(self.d2[at].astype(float)) * DOWN
        self.low[at, joined] = np.sqrt(second[at, joined].astype(float)) * DOWN
        stale = ~undecided[at, left]
        self.low[at[stale], left[stale]] = lower[at[stale], left[stale]]
        self.when[at, left] = now
        self.low[at, left] = np.minimum(self.low[at, left], behind)
        self.cluster, self.d2 = best, best_d2


STATE = "vec_id long, q array<int>, cluster int, d2 long, seen int, low binary, when binary, n long, sums array<long>"


def rows_of(data: np.ndarray) -> pa.Array:
    """Each row of a two-dimensional array as binary."""
    flat = np.ascontiguousarray(data)
    ends = np.arange(len(flat) + 1, dtype=np.int32) * (flat.shape[1] * flat.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(flat), [None, pa.py_buffer(ends), pa.py_buffer(flat)])


def assigned(history: np.ndarray, dimension: int, final: bool):
    """For mapInArrow: the vectors with their centroid and bounds, then the task's sums by centroid. With `final` all
    distances are made exact."""
    k = history.shape[1]
    groups = np.array_split(np.arange(k), -(-k // GROUP))
    names = [c.split()[0] for c in STATE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, dimension), np.int64), np.zeros(k, np.int64)
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE):
                batch = whole.slice(start, SLICE)
                n, q = batch.num_rows, matrix(batch.column("q"), dimension)
                if batch.column("low").null_count:
                    state = Bounds.unknown(n, len(groups))
                else:
                    low = np.frombuffer(b"".join(batch.column("low").to_pylist()), np.float32).reshape(n, -1).copy()
                    when = np.frombuffer(b"".join(batch.column("when").to_pylist()), np.uint8).reshape(n, -1).copy()
                    cluster, d2, seen = (batch.column(c).to_numpy().astype(np.int64) for c in ("cluster", "d2", "seen"))
                    state = Bounds(cluster, d2, seen, low, when)
                state.assign(q, history, groups)
                if final:
                    state.d2 = own_squared(q, history[-1][state.cluster])
                counts += np.bincount(state.cluster, minlength=k)
                np.add.at(sums, state.cluster, q)
                parts = [
                    batch.column("vec_id"), batch.column("q"), pa.array(state.cluster.astype(np.int32)), pa.array(state.d2),
                    pa.array(state.seen.astype(np.int32)), rows_of(state.low), rows_of(state.when), pa.nulls(n, pa.int64()),
                    pa.nulls(n, pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(parts, names=names)
        some = np.flatnonzero(counts)
        offsets = pa.array(np.arange(len(some) + 1, dtype=np.int32) * dimension)
        parts = [
            pa.nulls(len(some), pa.int64()), pa.nulls(len(some), pa.list_(pa.int32())), pa.array(some.astype(np.int32)),
            pa.nulls(len(some), pa.int64()), pa.nulls(len(some), pa.int32()), pa.nulls(len(some), pa.binary()),
            pa.nulls(len(some), pa.binary()), pa.array(counts[some]), pa.ListArray.from_arrays(offsets, pa.array(sums[some].ravel())),
        ]
        yield pa.RecordBatch.from_arrays(parts, names=names)

    return run


def moved_centroids(told: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """floor(sum / count) of every component; centroids without vectors stay. The driver gets at most a row per centroid
    and component."""
    parts = told.filter("n IS NOT NULL").select("cluster", "n", F.posexplode("sums").alias("place", "part"))
    whole = "decimal(38,0)"
    found = parts.groupBy("cluster", "place").agg(F.sum(F.col("part").cast(whole)).alias("total"), F.sum(F.col("n").cast(whole)).alias("n"))
    made = centroids.copy()
    for row in found.collect():
        made[row.cluster, row.place] = int(row.total) // int(row.n)
    return made


def start_centroids(kept: DataFrame, k: int, seed: int) -> np.ndarray:
    """The vectors whose ids have the smallest hashes, in that order."""
    shown = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    drawn = kept.orderBy(F.sha2(shown, 256), "q").select("q").limit(k).collect()
    return np.array([r.q for r in drawn], np.int64)


def ns_clusters(
    vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dimension: int = DIMENSION, seed: int = SEED
) -> tuple[DataFrame, np.ndarray]:
    """vec_id, cluster, distance (exact, squared) of each vector, and the final centroids as rows of integers."""
    spark = vectors.sparkSession
    ids = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    kept = staged(integer_vectors(ids, ["vec_id"], dimension), "vectors")
    centroids = start_centroids(kept, k, seed)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), np.zeros((0, dimension), np.int64)
    nothing = {c: F.lit(None) for c in ("cluster", "d2", "seen", "low", "when")}
    kinds = {"cluster": "int", "d2": "long", "seen": "int", "low": "binary", "when": "binary"}
    state = kept.select("vec_id", "q", *[v.cast(kinds[c]).alias(c) for c, v in nothing.items()])
    history = centroids[None]
    for turn in range(rounds + 1):
        # Later readers of a state take its vectors; the sums stand beside them.
        told = staged(state.mapInArrow(assigned(history, dimension, turn == rounds), STATE), f"clusters-{turn}")
        state = told.filter("n IS NULL").drop("n", "sums")
        if turn < rounds:
            centroids = moved_centroids(told, centroids)
            history = np.concatenate([history, centroids[None]])
    return state.select("vec_id", "cluster", F.col("d2").alias("distance")), centroids


def op11_ns_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings in 40 clusters after 5 rounds."""
    found, centroids = ns_clusters(table(spark, sf_dir, "embeddings"))
    shown = [(j, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for j, c in enumerate(centroids.tolist())]
    hashes = spark.createDataFrame(shown, "cluster int, centroid_sha256 string")
    whole = F.sum("_own").over(Window.partitionBy())
    totals = (
        found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("_own"))
        .select("cluster", F.col("_own").cast("long").alias("cluster_inertia"), whole.cast("long").alias("inertia"))
    )
    # One row per centroid.
    told = F.broadcast(totals.join(F.broadcast(hashes), "cluster"))
    return found.join(told, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql() -> str:
    steps = [
        r"""WITH kept AS (
    SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(vec_id::VARCHAR, '')), q) AS place, vec_id, q FROM (
        SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS q FROM embeddings
        WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)),
parts AS MATERIALIZED (SELECT place, unnest(range(64)) AS i, unnest(q) AS x FROM kept),
c0 AS MATERIALIZED (SELECT (place - 1)::INT AS cluster, i, x FROM parts WHERE place <= 40)"""
    ]
    for r in range(ROUNDS + 1):
        steps.append(
            f"""a{r} AS MATERIALIZED (
    SELECT place, min(struct_pack(d := d, k := cluster)) AS best FROM (
        SELECT p.place, c.cluster, sum((p.x - c.x) * (p.x - c.x))::BIGINT AS d
        FROM parts p JOIN c{r} c ON p.i = c.i GROUP BY ALL) GROUP BY place)"""
        )
        if r < ROUNDS:
            steps.append(
                f"""m{r} AS (
    SELECT a.best.k AS cluster, i, sum(x)::BIGINT AS s, count(*) AS n FROM parts p JOIN a{r} a ON p.place = a.place GROUP BY ALL),
c{r + 1} AS MATERIALIZED (
    SELECT c.cluster, c.i, CASE WHEN n IS NULL THEN c.x ELSE (s - ((s % n) + n) % n) // n END AS x
    FROM c{r} c LEFT JOIN m{r} m ON m.cluster = c.cluster AND m.i = c.i)"""
            )
    return (
        ",\n".join(steps)
        + f""",
h AS (SELECT cluster, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY cluster)
SELECT vec_id, a.best.k AS cluster, a.best.d AS distance,
       (sum(a.best.d) OVER (PARTITION BY a.best.k))::BIGINT AS cluster_inertia, (sum(a.best.d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{ROUNDS} a JOIN kept ON kept.place = a.place JOIN h ON h.cluster = a.best.k"""
    )


OP11_SQL = _sql()
