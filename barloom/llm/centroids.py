"""K-means over integer vectors, by partial-distance search.

Components are quantised to integers, so that every distance, sum and centroid
is exact and reruns agree.  A centroid's squared differences are accumulated
over the dimensions in the order of falling variance, a block at a time; a
vector abandons a centroid as soon as its partial distance is strictly above
the best found so far, and the survivors finish all dimensions.  Abandoning
strictly above keeps ties, which go to the smaller number.

A round is one pass over the vectors: a task adds up what it has read by
cluster and sends one row a cluster and dimension, whatever its input.  Vectors
are never shuffled; the driver holds the centroids and nothing else.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm._arrow import numbers
from barloom.llm._spark import stored

#: Dimensions added before the next look at who is still below the best.
BLOCK = 8
#: Quantised components are clamped to this, so that 64 squared differences fit a long.
LIMIT = 1 << 27
#: Longest sum of distances that is reported.
LARGEST = (1 << 63) - 1


def kept_vectors(table: DataFrame, id_col: str, vector_col: str, dimensions: int) -> DataFrame:
    """``(id, vector)`` of the rows whose vector has ``dimensions`` finite components."""
    vector = F.col(vector_col)
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return table.where((F.size(vector) == dimensions) & finite).select(F.col(id_col).alias("id"), vector.cast("array<double>").alias("vector"))


def quantised(components: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` as integers, clamped to ``LIMIT``."""
    return np.clip(np.floor(scale * components), -LIMIT, LIMIT).astype(np.int64)


def nearest(vectors: np.ndarray, centroids: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each vector's nearest centroid (ties: the smaller) and the squared distance to it.

    ``order``: the dimensions, the most telling ones first; it bears on the work only.
    """
    vectors, centroids = np.ascontiguousarray(vectors[:, order]), centroids[:, order]
    chosen, best = np.zeros(len(vectors), dtype=np.int32), np.full(len(vectors), LARGEST)
    for number, centroid in enumerate(centroids):
        alive, partial = np.arange(len(vectors)), np.zeros(len(vectors), dtype=np.int64)
        for at in range(0, len(order), BLOCK):
            gap = vectors[alive, at : at + BLOCK] - centroid[at : at + BLOCK]
            partial += np.einsum("ij,ij->i", gap, gap)
            on = partial <= best[alive]
            if not on.all():
                alive, partial = alive[on], partial[on]
        closer = partial < best[alive]  # an equal distance stays with the smaller number
        chosen[alive[closer]], best[alive[closer]] = number, partial[closer]
    return chosen, best


def _matrices(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        if batch.num_rows:
            flat = batch.column(batch.schema.get_field_index("vector")).flatten().to_numpy(zero_copy_only=False)
            yield batch, quantised(flat.reshape(batch.num_rows, -1), scale)


def dimension_order(kept: DataFrame, dimensions: int, scale: int) -> np.ndarray:
    """Dimensions by falling variance over all vectors."""

    def run(batches):
        n, total, squares = 0, np.zeros(dimensions), np.zeros(dimensions)
        for _, cells in _matrices(batches, scale):
            n, total, squares = n + len(cells), total + cells.sum(0), squares + (cells.astype(float) ** 2).sum(0)
        if n:
            columns = [numbers(range(dimensions)), numbers([n] * dimensions), numbers(total, float), numbers(squares, float)]
            yield pa.RecordBatch.from_arrays(columns, names=["dim", "n", "total", "squares"])

    sums = kept.select("vector").mapInArrow(run, "dim long, n long, total double, squares double").groupBy("dim").agg(F.sum("n"), F.sum("total"), F.sum("squares"))
    variance = np.zeros(dimensions)
    for dim, n, total, squares in sums.collect():  # one row a dimension
        variance[dim] = squares / n - (total / n) ** 2
    return np.argsort(-variance, kind="stable")


def first_centroids(kept: DataFrame, clusters: int, dimensions: int, scale: int, seed: int) -> np.ndarray:
    """The vectors with the smallest hashes of seed and id (ties: the smaller vector), in that order."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    rows = kept.select(key.alias("key"), "vector").orderBy("key", "vector").limit(clusters).collect()
    return quantised(np.array([r["vector"] for r in rows], dtype=float).reshape(len(rows), dimensions), scale)


def _moved(kept: DataFrame, centroids: np.ndarray, order: np.ndarray, scale: int) -> np.ndarray:
    """Every centroid at the floor of the mean of its vectors; those without any stay."""
    clusters, dimensions = centroids.shape

    def run(batches):
        counts, sums = np.zeros(clusters, dtype=np.int64), np.zeros((clusters, dimensions), dtype=np.int64)
        for _, cells in _matrices(batches, scale):
            chosen, _ = nearest(cells, centroids, order)
            counts += np.bincount(chosen, minlength=clusters)
            np.add.at(sums, chosen, cells)
        used = np.flatnonzero(counts)
        if len(used):
            columns = [np.repeat(used, dimensions), np.tile(np.arange(dimensions), len(used)), np.repeat(counts[used], dimensions), sums[used].ravel()]
            yield pa.RecordBatch.from_arrays([numbers(c) for c in columns], names=["cluster", "dim", "n", "total"])

    parts = kept.select("vector").mapInArrow(run, "cluster long, dim long, n long, total long")
    moved = centroids.copy()
    for cluster, dim, n, total in parts.groupBy("cluster", "dim").agg(F.sum("n"), F.sum(F.col("total").cast("decimal(38,0)"))).collect():
        moved[cluster, dim] = int(total) // n  # clusters x dimensions rows
    return moved


def cluster(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", clusters: int = 16, rounds: int = 3, dimensions: int = 64, scale: int = 64, seed: int = 1
) -> DataFrame:
    """One row per kept vector: ``id_col, cluster, distance, cluster_inertia, inertia, centroid_sha256``.

    Kept are vectors of exactly ``dimensions`` components, none null or
    non-finite; null vectors and all others give no row.  Fewer than
    ``clusters`` kept vectors make as many clusters; repeated rows are vectors
    of their own with equal results; a null id counts as an empty one in the
    choice of the first centroids.  Components beyond ``LIMIT`` are clamped and
    sums of distances beyond a long are reported as the largest long.  An
    empty table gives an empty result; other columns are ignored, whatever
    their names.
    """
    kept = kept_vectors(table, id_col, vector_col, dimensions)
    centroids = first_centroids(kept, clusters, dimensions, scale, seed)
    order = dimension_order(kept, dimensions, scale) if len(centroids) else np.arange(dimensions)
    for _ in range(rounds if len(centroids) else 0):
        centroids = _moved(kept, centroids, order, scale)

    def run(batches):
        for batch, cells in _matrices(batches, scale):
            chosen, best = nearest(cells, centroids, order)
            yield pa.RecordBatch.from_arrays([batch.column(0), numbers(chosen, np.int32), numbers(best)], names=["id", "cluster", "distance"])

    id_type = kept.schema["id"].dataType.simpleString()
    assigned = stored(kept.mapInArrow(run, f"id {id_type}, cluster int, distance long"), "clusters")
    inertias = {r["cluster"]: int(r["own"]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("own")).collect()}
    every = min(sum(inertias.values()), LARGEST)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    rows = [(i, min(own, LARGEST), every, digests[i]) for i, own in inertias.items()]  # one row a cluster
    found = table.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    joined = assigned.join(F.broadcast(found), "cluster")
    return joined.select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
