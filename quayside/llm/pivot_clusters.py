"""Centroid clustering with a pivot table (LAESA) under Lloyd's rounds, in whole numbers.

The distances of every vector to a few fixed pivots are computed once and
stored beside the vector. In each round the differences between those and the
centroids' own pivot distances bound every distance from below (triangle
inequality); only centroids whose bound is not above an exact distance already
known get an exact integer distance. The bounds decide what is computed, never
the result.

A task returns one row of sums for each of its centroids, so a vector that
makes up a third of the table costs no more than others. The driver holds the
centroids, their sums and a bounded sample from which the pivots are picked.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.session import materialise

#: Whole numbers for one unit of a component.
SCALE = 1024
#: Components beyond this size count as this size, so that every squared distance fits a long.
LARGEST = 1 << 27
#: Pivots, and the rows of smallest hash among which they are picked.
PIVOTS, SAMPLE = 12, 256
#: Room for the rounding of pivot distances, relative to them.
SLACK = 1e-9
LONGEST = (1 << 63) - 1


def whole(vectors: DataFrame, dims: int, seed: int) -> DataFrame:
    """vec_id, v (array<int>) and the hash that orders the starting centroids, of the vectors that are kept."""
    e = vectors["embedding"]
    bad = F.exists(e, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    edge = F.lit(float(LARGEST))
    v = F.transform(e, lambda x: F.floor(F.greatest(F.least(x.cast("double") * SCALE, edge), -edge)).cast("int"))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(vectors["vec_id"].cast("string"), F.lit("")))
    return vectors.where((F.size(e) == dims) & ~bad).select(
        vectors["vec_id"].cast("long").alias("vec_id"), v.alias("v"), F.sha2(name, 256).alias("name"))


def squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = v - c
    return np.einsum("ij,ij->i", d, d)


def to_pivots(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([squared(v, p) for p in pivots], 1).astype(np.float64))


def spread(sample: np.ndarray, count: int) -> np.ndarray:
    """Rows of the sample far from each other: each next one is the farthest from those picked."""
    picked = [0]
    near = squared(sample, sample[0])
    while len(picked) < min(count, len(sample)) and near.max() > 0:
        picked.append(int(near.argmax()))
        near = np.minimum(near, squared(sample, sample[picked[-1]]))
    return sample[picked]


def nearest(v: np.ndarray, far: np.ndarray, centroids: np.ndarray, centre_far: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and exact squared distance of the nearest centroid (smaller number at ties), and how many distances were exact.

    `far` and `centre_far` are the distances of vectors and centroids to the pivots.
    """
    bound = np.zeros((len(v), len(centroids)))
    for k, own in enumerate(centre_far):
        bound[:, k] = (np.abs(far - own) - SLACK * (far + own)).max(axis=1)
    bound = np.square(np.maximum(bound, 0))
    first = bound.argmin(axis=1)
    d = squared(v, centroids[first])
    best, cluster, computed = d.copy(), first.copy(), len(v)
    for k, c in enumerate(centroids):
        rows = np.flatnonzero((first != k) & (bound[:, k] <= best))
        own = squared(v[rows], c)
        computed += len(rows)
        better = (own < best[rows]) | ((own == best[rows]) & (k < cluster[rows]))
        best[rows[better]], cluster[rows[better]] = own[better], k
    return cluster, best, computed


def _blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    for b in batches:
        if b.num_rows:
            v = b.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)
            far = b.column("far").flatten().to_numpy(zero_copy_only=False).reshape(len(v), -1) if "far" in b.schema.names else None
            yield b.column("vec_id"), v, far


def with_pivots(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """vec_id, v and far (the distances to the pivots), written once for all rounds."""

    def run(batches):
        for ids, v, _ in _blocks(batches, pivots.shape[1]):
            far = pa.array(list(to_pivots(v, pivots)), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(list(v.astype(np.int32)), pa.list_(pa.int32())), far], ["vec_id", "v", "far"])

    return materialise(rows.select("vec_id", "v").mapInArrow(run, "vec_id long, v array<int>, far array<double>"), "pivot-table")


def moved(table: DataFrame, pivots: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round; those without vectors stay."""
    dims = centroids.shape[1]
    centre_far = to_pivots(centroids, pivots)
    fields = [f"s{k}" for k in range(dims)]

    def run(batches):
        sums, counts = np.zeros((len(centroids), dims), np.int64), np.zeros(len(centroids), np.int64)
        for _, v, far in _blocks(batches, dims):
            cluster, *_ = nearest(v, far, centroids, centre_far)
            counts += np.bincount(cluster, minlength=len(centroids))
            for k in range(len(centroids)):
                sums[k] += v[cluster == k].sum(axis=0)
        has = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(has, pa.int32()), pa.array(counts[has]), *(pa.array(sums[has, k]) for k in range(dims))], ["cluster", "n", *fields])

    sums = table.mapInArrow(run, "cluster int, n long, " + ", ".join(f"{f} long" for f in fields))
    got = sums.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col(f).cast("decimal(20,0)")).alias(f) for f in fields]).collect()
    out = centroids.copy()
    for r in got:
        out[r.cluster] = [int(r[f]) // r.n for f in fields]
    return out


def assigned(table: DataFrame, pivots: np.ndarray, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster and squared distance of every vector."""
    centre_far = to_pivots(centroids, pivots)

    def run(batches):
        for ids, v, far in _blocks(batches, centroids.shape[1]):
            cluster, distance, _ = nearest(v, far, centroids, centre_far)
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster, pa.int32()), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return table.mapInArrow(run, "vec_id long, cluster int, distance long")


def _by_cluster(values: dict[int, Callable | object], kind: str) -> Column:
    out = F.lit(None).cast(kind)
    for k, v in values.items():
        out = F.when(F.col("cluster") == k, F.lit(v).cast(kind)).otherwise(out)
    return out


def cluster(vectors: DataFrame, centroids: int = 8, rounds: int = 10, dims: int = 64, seed: int = 3) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Kept are vectors of exactly `dims` components, none of them null, NaN or
    infinite; a component x becomes floor(1024 * x), held within 2^27 either
    way. Centroids start as the vectors with the smallest hash of seed and
    vec_id, of equal hashes those with the smaller components first; with fewer
    vectors there are fewer centroids. Repeated rows count each; a null vec_id
    hashes as empty and comes back as null. Sums of distances that don't fit a
    long are null. An empty table gives no rows; further columns are ignored.
    """
    own = whole(vectors, dims, seed)
    few = own.orderBy("name", "v").limit(max(SAMPLE, centroids)).collect()
    if not few:
        return own.sparkSession.createDataFrame(
            [], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    sample = np.array([r.v for r in few], np.int64)
    now, pivots = sample[:centroids], spread(sample[:SAMPLE], PIVOTS)
    table = with_pivots(own, pivots)
    for _ in range(rounds):
        before, now = now, moved(table, pivots, now)
        if (before == now).all():  # further rounds would find the same
            break
    rows = materialise(assigned(table, pivots, now), "pivot-clusters")
    got = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()
    fits = lambda n: n if n <= LONGEST else None
    names = {k: hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for k, c in enumerate(now)}
    return rows.select(
        "vec_id", "cluster", "distance", _by_cluster({r.cluster: fits(int(r.s)) for r in got}, "long").alias("cluster_inertia"),
        F.lit(fits(sum(int(r.s) for r in got))).cast("long").alias("inertia"), _by_cluster(names, "string").alias("centroid_sha256"))
