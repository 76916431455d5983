"""Clustering against plain integer arithmetic, and the progressive search against all distances."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from kerbline.llm import centroids


def plain(rows, clusters, rounds, seed=3):
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) by Python integers."""
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows]
    first = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    middle = [list(v) for _, v in first[:clusters]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(middle))

    for _ in range(rounds):
        homes = [near(v)[1] for _, v in kept]
        for k in range(len(middle)):
            own = [v for (_, v), home in zip(kept, homes) if home == k]
            if own:
                middle[k] = [sum(x) // len(own) for x in zip(*own)]
    last = [near(v) for _, v in kept]
    sums = [sum(d for d, k in last if k == j) for j in range(len(middle))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    return sorted((str(i), k, d, sums[k], sum(sums), digest[k]) for (i, _), (d, k) in zip(kept, last))


def table(spark, rows):
    full = [(i, v, "x", 1, 2.0) for i, v in rows]
    return spark.createDataFrame(full, "vec_id long, embedding array<float>, order string, cluster int, distance double")


def shown(df):
    return sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())


def vectors(n, size=64, seed=1, scale=1.0):
    rng = np.random.default_rng(seed)
    spots = rng.normal(size=(5, size))
    return [(k, [float(np.float32(x)) for x in scale * (spots[k % 5] + rng.normal(size=size) / 3)]) for k in range(n)]


@pytest.mark.parametrize("size", [64, 8])
def test_transform(size):
    values = np.random.default_rng(2).integers(-(1 << 20), 1 << 20, (40, size))
    coefficients = centroids.transformed(values)
    assert np.array_equal(centroids.restored(coefficients), values)
    assert np.array_equal((coefficients.astype(object) ** 2).sum(1), size * (values.astype(object) ** 2).sum(1))
    signs = centroids.hadamard(np.eye(size, dtype=np.int64))[centroids.sequency(size)]
    assert (signs[:, 1:] != signs[:, :-1]).sum(1).tolist() == list(range(size))


@pytest.mark.parametrize("large", [1, 1 << 21])
def test_search_equals_all_distances(large):
    rng = np.random.default_rng(5)
    points = rng.integers(-40, 40, (500, 64)) * large
    goals = np.concatenate([points[:6], points[:2], rng.integers(-40, 40, (4, 64)) * large])
    cluster, distance = centroids.nearest(centroids.transformed(points), centroids.transformed(goals))
    gaps = ((points[:, None].astype(object) - goals[None].astype(object)) ** 2).sum(2)
    assert cluster.tolist() == [min(range(len(goals)), key=lambda k: (row[k], k)) for row in gaps]
    assert distance.tolist() == gaps.min(1).tolist()


def test_clusters(spark):
    rows = vectors(150)
    assert shown(centroids.clustered(table(spark, rows))) == plain(rows, 8, 10)


def test_ties_copies_and_missing_ids(spark):
    rows = [(1, [0.5] * 64), (1, [0.5] * 64), (2, [-0.5] * 64), (None, [0.0] * 64), (None, [0.25] * 64), (3, [-0.0004] * 64)]
    assert shown(centroids.clustered(table(spark, rows), clusters=3, rounds=4)) == plain(rows, 3, 4)


def test_unusable_vectors_have_no_row(spark):
    rows = vectors(12)
    bad = [(90, None), (91, []), (92, [1.0] * 63), (93, [1.0] * 65), (94, [None] + [1.0] * 63), (95, [float("nan")] * 64), (96, [float("inf")] * 64)]
    assert shown(centroids.clustered(table(spark, rows + bad))) == plain(rows, 8, 10)


def test_few_and_none(spark):
    rows = vectors(3)
    assert shown(centroids.clustered(table(spark, rows))) == plain(rows, 8, 10)
    empty = centroids.clustered(table(spark, rows).where("false"))
    assert empty.collect() == [] and empty.columns[0] == "vec_id"
    unnamed = centroids.clustered(table(spark, [(None, [1.0] * 64)]))
    assert unnamed.collect() == []


def test_large_and_too_large_components(spark):
    rows = [(k, [float(np.float32(x)) for x in row]) for k, row in enumerate(np.random.default_rng(3).normal(size=(20, 64)) * 30_000)]
    assert shown(centroids.clustered(table(spark, rows), clusters=4, rounds=3)) == plain(rows, 4, 3)
    with pytest.raises(Exception, match="are not clustered"):
        centroids.clustered(table(spark, [(1, [1e30] * 64)])).collect()
