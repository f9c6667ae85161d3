"""Centroid clustering of integer vectors: rounds of exact assignment and exact means, with Orchard search for the nearest centroid.

Each centroid has a list of all others, nearest first. A search starts at some centroid and walks its list; when a centroid that is
closer to the vector turns up, it goes on with that one's list from the start. Centroids seen once are marked and not measured again. The
walk stops at an entry that is strictly farther from the list's centroid than twice the vector is: by the triangle inequality no later
entry can be closer, nor as close. All arithmetic is in 64-bit integers, so ties are real ties and go to the smaller number.

Vectors are read anew in every round, a few megabytes at a time. A task sends one row of sums per centroid, so a cluster that holds most
vectors costs no more than another; the driver gets one row per centroid, whose number the caller sets.

Rows whose array is null, has another length, or holds a null, NaN or infinite component are left out. Repeated rows count each time. A
table without a usable vector gives no centroids and no rows. Components must stay within :func:`most` after scaling (94 million for 64
components), as squared distances have to fit 64 bits; others raise an error.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tablecare.session import cut_lineage

BATCH = 8192
"""Vectors that are searched together."""


def most(dims: int) -> int:
    """Largest absolute component after scaling with which four times a squared distance of ``dims`` components fits 64 bits."""
    return math.isqrt((1 << 59) // dims) - 1


def usable(vector: Column, dims: int) -> Column:
    """Whether an array has ``dims`` components, none null, NaN or infinite; false for a null array."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return F.coalesce((F.size(vector) == dims) & finite, F.lit(False))


def whole_vectors(rows: DataFrame, vector: str, dims: int, scale: int) -> DataFrame:
    """The usable rows as a struct ``row`` of the other columns beside ``v``, the vector as integers ``floor(scale * x)``."""
    as_doubles = rows[vector].cast("array<double>")
    v = F.transform(as_doubles, lambda x: F.floor(F.lit(float(scale)) * x))
    others = [rows[c] for c in rows.columns if c != vector]
    packed = rows.select(F.struct(*(others or [F.lit(None).alias("none")])).alias("row"), F.when(usable(as_doubles, dims), v).alias("v"), F.array_max(F.transform(as_doubles, F.abs)).alias("size"))
    too_far = F.raise_error(F.lit(f"a component over {most(dims)} after scaling")).cast("array<bigint>")
    return packed.where(F.col("v").isNotNull()).select("row", F.when(F.col("size") * scale < most(dims), F.col("v")).otherwise(too_far).alias("v"))


def first_centroids(vectors: DataFrame, vec_id: str, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the smallest SHA-256 (hex) of ``seed:id``, in that order; equal ids by their components.

    A null id counts as the text ``null``. Fewer vectors give fewer centroids. Each task keeps its ``k`` best rows.
    """
    name = F.coalesce(F.col("row")[vec_id].cast("string"), F.lit("null"))
    drawn = vectors.select(F.sha2(F.concat(F.lit(f"{seed}:"), name), 256).alias("draw"), "v").orderBy("draw", "v").limit(k)
    found = [r["v"] for r in drawn.collect()]
    return np.array(found, np.int64) if found else np.zeros((0, 0), np.int64)


@dataclass(frozen=True)
class Orchard:
    """Centroids with their neighbour lists."""

    points: np.ndarray
    between: np.ndarray
    lists: np.ndarray

    @classmethod
    def of(cls, points: np.ndarray) -> Orchard:
        """Squared distances between all centroids, and of each the others by distance, then number; ``k`` squared entries."""
        between = np.stack([((points - p) ** 2).sum(1) for p in points])
        order = np.argsort(between, axis=1, kind="stable")
        lists = np.stack([row[row != i] for i, row in enumerate(order)]) if len(points) > 1 else np.zeros((len(points), 0), np.int64)
        return cls(points, between, lists)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of the nearest centroid of each vector, the smaller number among equals."""
        count, k = len(vectors), len(self.points)
        at = np.zeros(count, np.int64)
        best = ((vectors - self.points[0]) ** 2).sum(1)
        place = np.zeros(count, np.int64)
        seen = np.zeros((count, k), bool)
        seen[:, 0] = True
        open_ = np.arange(count) if k > 1 else np.zeros(0, np.int64)
        while len(open_):
            other = self.lists[at[open_], place[open_]]
            near = self.between[at[open_], other] <= 4 * best[open_]
            open_, other = open_[near], other[near]
            place[open_] += 1
            fresh = ~seen[open_, other]
            rows, tried = open_[fresh], other[fresh]
            seen[rows, tried] = True
            far = ((vectors[rows] - self.points[tried]) ** 2).sum(1)
            closer = (far < best[rows]) | ((far == best[rows]) & (tried < at[rows]))
            moved = rows[closer]
            at[moved], best[moved], place[moved] = tried[closer], far[closer], 0
            open_ = open_[place[open_] < k - 1]
        return at, best


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for first in range(0, batch.num_rows, BATCH):
            part = batch.slice(first, BATCH)
            v = part.column("v")
            yield part, v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), -1)


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``row``, cluster and distance (squared) of every vector of :func:`whole_vectors`, without a shuffle."""
    if not len(centroids):
        return vectors.where(F.lit(False)).select("row", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
    orchard = Orchard.of(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, v in _batches(batches):
            number, distance = orchard.nearest(v)
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(number, pa.int32()), pa.array(distance, pa.int64())], ["row", "cluster", "distance"])

    schema = vectors.select("row", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).schema
    return vectors.mapInArrow(run, schema)


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: of each its vectors' component-wise ``floor(sum / count)``, or itself if it has none.

    Tasks add up their own vectors first. Sums are exact; additions beyond 64 bits, as of 2**36 vectors with components of
    2**27, raise an error in Spark.
    """
    if not len(centroids):
        return centroids
    orchard, dims = Orchard.of(centroids), centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(centroids.shape, np.int64), np.zeros(len(centroids), np.int64)
        for _, v in _batches(batches):
            number, _ = orchard.nearest(v)
            counts += np.bincount(number, minlength=len(counts))
            for c in np.unique(number):
                sums[c] += v[number == c].sum(0)
        used = np.flatnonzero(counts)
        arrays = [pa.array(used, pa.int32()), pa.array(counts[used], pa.int64()), pa.array(list(sums[used]), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(arrays, ["cluster", "n", "sums"])

    parts = vectors.select("v").mapInArrow(run, "cluster int, n long, sums array<long>")
    added = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(dims)]).alias("sums")).collect()
    out = centroids.copy()
    for row in added:
        out[row["cluster"]] = [s // row["n"] for s in row["sums"]]
    return out


def fit(vectors: DataFrame, vec_id: str, k: int = 16, rounds: int = 3, seed: int = 1) -> np.ndarray:
    """The centroids after ``rounds`` rounds over :func:`whole_vectors`; ``k`` is bounded by what ``k`` squared distances may take."""
    centroids = first_centroids(vectors, vec_id, k, seed)
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    return centroids


def digest(centroid: np.ndarray) -> str:
    """SHA-256 (hex) of the components as decimal integers joined by commas."""
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", dims: int = 64, scale: int = 64, k: int = 16, rounds: int = 3, seed: int = 1) -> DataFrame:
    """Every usable row as a struct ``row`` (without the vector) beside cluster, distance, cluster_inertia, inertia, centroid_sha256.

    ``cluster_inertia`` and ``inertia`` are the sums of the squared distances in the cluster and in all. The assignment (ids and two
    numbers, no vectors) is written to the shared folder once; the sums are one row per centroid and come back by broadcast.
    """
    vectors = whole_vectors(rows, vector, dims, scale)
    centroids = fit(vectors, vec_id, k, rounds, seed)
    assigned = cut_lineage(assign(vectors, centroids))
    sums = {r["cluster"]: r["total"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    facts = [(c, total, sum(sums.values()), digest(centroids[c])) for c, total in sorted(sums.items())]
    known = rows.sparkSession.createDataFrame(facts, "number int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(known), F.col("cluster") == F.col("number")).drop("number")
