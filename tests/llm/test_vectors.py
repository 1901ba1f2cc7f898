"""Clustering and hard negatives against brute force on small fixtures."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tamiz.llm import clustering, hard_negatives
from tamiz.llm.vectors import integer_vectors

SCHEMA = (
    "vec_id long, embedding array<double>, label int, q string, cluster string, tile string, _vector string, low int, "
    "query string, block int, distance string"
)
EXTRA = ("a", "b", "c", "d", 1, "e", 2, "f")


def table_of(spark, rows):
    return spark.createDataFrame([(i, v, y, *EXTRA) for i, v, y in rows], SCHEMA).repartition(3)


def vectors(n, dimension, seed):
    """Clustered vectors with ties, repeated rows and ids, rows out of use, and null ids."""
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(6, dimension))
    rows = []
    for i in range(n):
        v = (middles[i % 6] + 0.6 * rng.normal(size=dimension)).tolist()
        rows.append((i, v, int(i % 4)))
    rows += [(k + n, rows[3][1], int(k % 3)) for k in range(15)]
    rows += [rows[5], rows[5], rows[0], (7, rows[9][1], 1), (None, rows[2][1], 2), (None, rows[4][1], 0), (50, rows[8][1], 3)]
    bad = [None, [], [None] * dimension, [math.nan] * dimension, [math.inf] + [0.0] * (dimension - 1), [0.5] * (dimension - 1)]
    rows += [(1000 + 50 * k, v, 1) for k, v in enumerate(bad)]
    rows += [(2000, [0.0] * dimension, 1), (2001, [0.0] * dimension, None)]
    return rows


def kept_vector(v, dimension=None):
    if v is None or any(x is None or not math.isfinite(x) for x in v) or dimension not in (None, len(v)):
        return None
    return tuple(math.floor(256 * x) for x in v)


def brute_clusters(rows, k, rounds, dimension):
    kept = [(i, q) for i, v, _ in rows if (q := kept_vector(v, dimension))]
    digest = lambda i: hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest()
    centroids = [list(q) for _, q in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]
    for turn in range(rounds + 1):
        found = [min((sum((a - b) ** 2 for a, b in zip(q, c)), j) for j, c in enumerate(centroids)) for _, q in kept]
        if turn < rounds:
            for j in range(len(centroids)):
                own = [q for (_, q), (_, at) in zip(kept, found) if at == j]
                if own:
                    centroids[j] = [sum(x) // len(own) for x in zip(*own)]
    return Counter((i, j, d) for (i, _), (d, j) in zip(kept, found)), centroids


@pytest.mark.parametrize("k", [1, 7, 13])
def test_clusters(spark, k):
    rows = vectors(260, 8, 3)
    made, centroids = clustering.ns_clusters(table_of(spark, rows), k, 4, 8)
    want, final = brute_clusters(rows, k, 4, 8)
    assert Counter((r.vec_id, r.cluster, r.distance) for r in made.collect()) == want
    assert centroids.tolist() == final


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = [(1, [0.0, 1.0], 0), (2, [0.0, 1.0], 0), (None, [1.0, 1.0], 0)]
    made, centroids = clustering.ns_clusters(table_of(spark, rows), 5, 2, 2)
    want, final = brute_clusters(rows, 5, 2, 2)
    assert Counter(tuple(r) for r in made.collect()) == want and centroids.tolist() == final
    none, centroids = clustering.ns_clusters(table_of(spark, [(1, None, 0)]), 5, 2, 2)
    assert none.count() == 0 and none.columns == ["vec_id", "cluster", "distance"] and not len(centroids)


def test_bounds_skip_most_distances_and_stay_exact():
    rng = np.random.default_rng(1)
    middles = rng.integers(-3000, 3000, (20, 16))
    q = (middles[rng.integers(0, 20, 4000)] + rng.integers(-60, 60, (4000, 16))).astype(np.int32)
    centroids = middles + rng.integers(-40, 40, middles.shape)
    groups = np.array_split(np.arange(20), 4)
    history, state, computed = centroids[None], clustering.Bounds.unknown(4000, 4), []
    for _ in range(6):
        computed.append(state.assign(q, history, groups))
        assert (state.cluster == clustering.squared(q, history[-1]).argmin(1)).all()
        moved = np.stack([q[state.cluster == j].astype(int).sum(0) // max(1, (state.cluster == j).sum()) for j in range(20)])
        history = np.concatenate([history, moved[None]])
    assert computed[0] > 4000 * 19 and max(computed[1:]) < computed[0] / 8


def test_huge_components_are_exact_or_refused(spark):
    big = float(clustering.np.int64(1 << 18))
    rows = [(k, [big - k % 3, -big + k % 5, k / 256], 0) for k in range(40)]
    made, _ = clustering.ns_clusters(table_of(spark, rows), 3, 2, 3)
    assert Counter(tuple(r) for r in made.collect()) == brute_clusters(rows, 3, 2, 3)[0]
    with pytest.raises(Exception, match="beyond"):
        integer_vectors(table_of(spark, [(1, [1e30], 0)]), ["vec_id"]).collect()


def brute_negatives(rows):
    used = list({(i, y, q) for i, v, y in rows if (q := kept_vector(v)) is not None and y is not None})
    last = 1 << 63
    order = lambda r: (-r[1], last if r[0][0] is None else r[0][0])
    made = Counter()
    for a in used:
        if a[0] is None or a[0] % 50:
            continue
        scored = sorted(((r, sum(x * y for x, y in zip(a[2], r[2]))) for r in used if r != a), key=order)
        for p, score in [x for x in scored if x[0][1] == a[1]][:5]:
            fit = [x for x in scored if x[0][1] != a[1] and 50 * score <= 100 * x[1] <= 95 * score][:3]
            made.update((a[0], p[0], k + 1, n[0], score, s) for k, (n, s) in enumerate(fit))
    return made


@pytest.mark.parametrize("tile,queries,boxes", [(4096, 1 << 16, 4096), (24, 3, 4)])
def test_hard_negatives(spark, monkeypatch, tile, queries, boxes):
    for name, value in (("TILE", tile), ("QUERIES", queries), ("BOXES", boxes)):
        monkeypatch.setattr(hard_negatives, name, value)
    rows = vectors(400, 6, 4)
    given = integer_vectors(table_of(spark, rows).withColumn("label", F.col("label").cast("long")), ["vec_id", "label"])
    made = hard_negatives.hard_negatives(given, F.col("vec_id") % 50 == 0)
    found = Counter((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in made.collect())
    want = brute_negatives(rows)
    assert found == want and len(want) > 100


def test_hard_negatives_of_nothing(spark):
    for rows in ([], [(None, None, None)], [(1, [1.0], 0), (2, [1.0], 1)]):
        given = integer_vectors(table_of(spark, rows).withColumn("label", F.col("label").cast("long")), ["vec_id", "label"])
        made = hard_negatives.hard_negatives(given, F.col("vec_id") % 50 == 0)
        assert made.count() == 0
        assert made.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_boxes_bound_and_windows_prune():
    rng = np.random.default_rng(2)
    label, q = rng.integers(0, 3, 500), rng.integers(-90, 90, (500, 4)).astype(np.int32)
    tree = hard_negatives.Tree(np.arange(500), label, q)
    least, most = tree.boxes.bounds(q[:50])
    score = (tree.q.astype(int) @ q[:50].T.astype(int))
    assert (least <= score.min(1).T).all() and (score.max(1).T <= most).all()
    tight = (most >= np.sort(score.reshape(-1, 50), 0)[-5][:, None]).mean()
    assert tight < 0.7
