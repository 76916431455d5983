"""Centroid clustering of integer vectors, with the nearest centroid found coarse to fine in the Walsh-Hadamard domain.

The Walsh-Hadamard transform of integers is exact and keeps squared distances up to the factor of the dimension. Vectors
are transformed once, their coefficients ordered by sequency (coarse first), and written. To find a vector's nearest
centroid, the squared differences of the coarsest coefficients are summed for all centroids; the one that looks nearest
is finished, and its full distance is the bound. Finer coefficients are added for the others, and a centroid whose sum
exceeds the bound is out: sums only grow. What is left after the last coefficient has its exact distance.

A round takes one pass over the written coefficients. A task hands back one sum per centroid and coefficient, so what
reaches the driver does not grow with the vectors; the transform of a sum is the sum of transforms.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbline.llm.common import map_arrow, settle

SCALE = 1024
#: Components up to here keep every squared distance within a long.
LARGEST = 1 << 27
#: Coefficients up to here keep all sums of this module within 64 bits; beyond, Python's integers are used.
NARROW = 1 << 27
#: Vectors of a numpy pass; ends of the bands of coefficients, coarse to fine.
CHUNK, BANDS = 4096, (4, 16)


def hadamard(values: np.ndarray) -> np.ndarray:
    """The transform of every row, coefficients in natural order; twice gives the rows times their length."""
    out, size = values.copy(), values.shape[1]
    step = 1
    while step < size:
        pairs = out.reshape(len(out), -1, 2, step)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(len(out), size)
        step *= 2
    return out


def sequency(size: int) -> np.ndarray:
    """Natural numbers of the coefficients, those with the fewest sign changes first."""
    rows = hadamard(np.eye(size, dtype=np.int64))
    return np.argsort((rows[:, 1:] != rows[:, :-1]).sum(1), kind="stable")


def scaled(vectors: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) of finite doubles, exactly."""
    out = np.floor(vectors * SCALE)
    if out.size and np.abs(out).max() > LARGEST:
        raise ValueError(f"components beyond {LARGEST // SCALE} are not clustered: their distances exceed a long")
    return out.astype(np.int64)


def transformed(vectors: np.ndarray) -> np.ndarray:
    """Coefficients of integer vectors, coarse to fine."""
    return hadamard(vectors)[:, sequency(vectors.shape[1])]


def restored(coefficients: np.ndarray) -> np.ndarray:
    """The vectors, or sums of vectors, that have these coefficients."""
    natural = np.empty_like(coefficients)
    natural[:, sequency(coefficients.shape[1])] = coefficients
    return hadamard(natural) // coefficients.shape[1]


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of each vector's nearest centroid (ties: the smaller) and the squared distance; all given as coefficients."""
    size = vectors.shape[1]
    if max((np.abs(x).max() for x in (vectors, centroids) if x.size), default=0) > NARROW:
        vectors, centroids = vectors.astype(object), centroids.astype(object)
    ends = [0, *(end for end in BANDS if end < size), size]
    first = vectors[:, None, : ends[1]] - centroids[None, :, : ends[1]]
    sums = (first * first).sum(2)
    every = np.arange(len(vectors))
    likely = sums.argmin(1)
    gap = vectors - centroids[likely]
    bound = (gap * gap).sum(1)
    alive = sums <= bound[:, None]
    alive[every, likely] = False  # finished already
    for low, high in zip(ends[1:], ends[2:]):
        row, centroid = np.nonzero(alive)
        gap = vectors[row, low:high] - centroids[centroid, low:high]
        sums[row, centroid] += (gap * gap).sum(1)
        alive[row, centroid] = sums[row, centroid] <= bound[row]
    alive[every, likely] = True
    sums[every, likely] = bound
    best = np.where(alive, sums, bound.max(initial=0) + 1).argmin(1)
    return best, sums[every, best] // size


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def prepared(vectors: DataFrame, key: str, embedding: str, size: int, seed: int) -> DataFrame:
    """vec_id, `order` (sha256 of `<seed>:<key>`) and the coefficients of every vector of `size` finite components."""
    value = F.col("vector")
    whole = (F.size(value) == size) & F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(f"`{key}`").cast("long").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("vector"))
    rows = rows.filter(F.coalesce(whole, F.lit(False)))
    rows = rows.withColumn("order", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256))
    schema = T.StructType(
        [T.StructField("vec_id", T.LongType()), T.StructField("order", T.StringType()), T.StructField("coefficients", T.ArrayType(T.LongType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = transformed(scaled(_matrix(batch.column("vector"), size)))
            lists = pa.ListArray.from_arrays(np.arange(len(found) + 1, dtype=np.int32) * size, found.ravel())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("order"), lists], names=schema.names)

    return settle(map_arrow(rows, run, schema), "clustering-vectors")


def _sums(rows: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Members of every centroid and the sums of their coefficients."""
    count, size = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members, total = np.zeros(count, np.int64), np.zeros((count, size), object)
        for batch in batches:
            values = _matrix(batch.column("coefficients"), size)
            for at in range(0, len(values), CHUNK):
                part = values[at : at + CHUNK]
                found, _ = nearest(part, centroids)
                members += np.bincount(found, minlength=count)
                for k in np.unique(found).tolist():
                    total[k] += part[found == k].sum(0).astype(object)
        some = np.flatnonzero(members)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(some, size), pa.int32()),
                pa.array(np.tile(np.arange(size), len(some)), pa.int32()),
                pa.array(np.repeat(members[some], size), pa.int64()),
                pa.array([Decimal(int(x)) for x in total[some].ravel()], pa.decimal128(38, 0)),
            ],
            names=["cluster", "place", "members", "total"],
        )

    parts = map_arrow(rows.select("coefficients"), run, "cluster int, place int, members long, total decimal(38,0)")
    members, total = np.zeros(count, np.int64), np.zeros((count, size), object)
    # As many rows as centroids have components, whatever the number of vectors.
    for row in parts.groupBy("cluster", "place").agg(F.sum("members"), F.sum("total")).collect():
        members[row[0]], total[row[0], row[1]] = row[2], int(row[3])
    return members, total


def seeds(rows: DataFrame, clusters: int) -> np.ndarray:
    """Coefficients of the vectors that come first by their hash; of equal hashes the smaller vector."""
    first = rows.filter("order IS NOT NULL").orderBy("order", "coefficients").limit(clusters).collect()
    return np.array([row.coefficients for row in first], np.int64)


def trained(rows: DataFrame, clusters: int, rounds: int) -> np.ndarray:
    """Final centroids, as integer vectors in their numbers' order."""
    start = seeds(rows, clusters)
    if not len(start):
        return start.reshape(0, 0)
    centroids = restored(start)
    for _ in range(rounds):
        members, total = _sums(rows, transformed(centroids))
        means = restored(total)
        moved = centroids.copy()
        for k in np.flatnonzero(members).tolist():
            moved[k] = np.array([x // int(members[k]) for x in means[k]], np.int64)
        if np.array_equal(moved, centroids):
            break  # further rounds would change nothing
        centroids = moved
    return centroids


def _long(value: int) -> Column:
    """The value, or null where a long can't hold it."""
    return F.lit(value if value < 1 << 63 else None).cast("long")


def clustered(
    vectors: DataFrame,
    clusters: int = 8,
    rounds: int = 10,
    key: str = "vec_id",
    embedding: str = "embedding",
    size: int = 64,
    seed: int = 3,
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector of `size` finite components.

    `size` is a power of two. Components become floor(1024 * x). Vectors that are null, of another length, or have a null
    or non-finite component have no row; one with a component beyond 131,072 fails the job, as distances may exceed a
    long. An inertia beyond a long is null. A vector without a key starts no centroid, but is clustered. Repeated rows are vectors of their own and may
    start two centroids; ties go to the smaller number. With fewer vectors than clusters, there are as many centroids as
    vectors. An empty table gives no rows. Further columns are left out, whatever their names.
    """
    if size & (size - 1) or size < 1 or clusters < 1:
        raise ValueError("size must be a power of two, clusters at least 1")
    rows = prepared(vectors, key, embedding, size, seed)
    centroids = trained(rows, clusters, rounds)
    goals = transformed(centroids) if centroids.size else centroids
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _matrix(batch.column("coefficients"), size)
            parts = [nearest(values[at : at + CHUNK], goals) for at in range(0, len(values), CHUNK)] if goals.size else []
            if parts:
                cluster, distance = (np.concatenate(x) for x in zip(*parts))
                found = [batch.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance.tolist(), pa.int64())]
                yield pa.RecordBatch.from_arrays(found, names=schema.names)

    placed = settle(map_arrow(rows.select("vec_id", "coefficients"), run, schema), "clustering-placed")
    sums = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum")).collect()  # a row a cluster
    own = {row["cluster"]: int(row["sum"]) for row in sums}
    names = [hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest() for centroid in centroids.tolist()]
    inertia, text = sum(own.values()), F.array(*map(F.lit, names)) if names else F.array().cast("array<string>")
    each = F.array(*(_long(own.get(k, 0)) for k in range(len(names)))) if names else F.array().cast("array<long>")
    return placed.select(
        "vec_id",
        "cluster",
        "distance",
        F.get(each, F.col("cluster")).alias("cluster_inertia"),
        _long(inertia).alias("inertia"),
        F.get(text, F.col("cluster")).alias("centroid_sha256"),
    )
