"""Centroid clustering whose centroids are filtered by n-simplex projection.

The distances of a vector to some pivots place it, as the apex of a simplex over them, in a space
of as many dimensions as there are pivots: the coordinates in the pivots' own plane and the height
above it. For two such apexes the distance of their vectors is at least the Euclidean distance of
the apexes, and at most that distance with one apex below the plane. The vectors' apexes are
computed once and kept with them; each round only projects the few centroids. A centroid whose
lower bound is above another's upper bound cannot be the nearest; those that remain are compared by
exact integers. Bounds are floating point and get a margin far above their rounding, so they never
decide between centroids, they only spare comparisons.

Rounds are Spark jobs over the written vectors: a task sums its vectors by centroid, the sums are
added by Spark, and the driver sees one row for each centroid and task's end: ``k`` sums in all.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow.scratch import ship_package, written

SCALE = 1024
#: Components up to this size have distances and sums that fit into 64 bits; larger ones are
#: compared as Python's integers.
EXACT = 1 << 27
#: Squared height, relative to the squared distance, below which a pivot adds no dimension.
FLAT = 1e-4
#: Share of the squared distances by which bounds are widened; their rounding is below 1e-9.
MARGIN = 1e-6


@dataclass
class Simplex:
    """Pivots (integers) and what places other vectors over them."""

    pivots: np.ndarray  # one row each
    lower: np.ndarray  # Cholesky factor of the pivots' Gram matrix, the first pivot as origin

    @classmethod
    def over(cls, candidates: np.ndarray) -> Simplex:
        """The simplex of those candidates that are no part of the others' plane, nearly."""
        chosen, lower = [0], np.zeros((0, 0))
        origin = candidates[0]
        for at in range(1, len(candidates)):
            own = candidates[at] - origin
            held = [candidates[i] - origin for i in chosen[1:]]
            row = substituted(lower, np.array([[float((own * one).sum()) for one in held]]))[0]
            length = float((own * own).sum())
            height = length - float((row * row).sum())
            if height > FLAT * length:
                grown = np.zeros((len(row) + 1, len(row) + 1))
                grown[:-1, :-1] = lower
                grown[-1, :-1], grown[-1, -1] = row, math.sqrt(height)
                chosen.append(at)
                lower = grown
        return cls(candidates[chosen], lower)

    def apexes(self, vectors: np.ndarray) -> np.ndarray:
        """The coordinates of each vector; the last one is the height over the pivots' plane."""
        squares = np.stack([squared(vectors, pivot).astype(float) for pivot in self.pivots], 1)
        base = np.array([float(((pivot - self.pivots[0]) ** 2).sum()) for pivot in self.pivots])
        first = squares[:, :1]
        inner = (first + base[1:] - squares[:, 1:]) / 2
        plane = substituted(self.lower, inner)
        height = np.sqrt(np.maximum(first[:, 0] - (plane ** 2).sum(1), 0))
        return np.concatenate([plane, height[:, None]], 1)


def substituted(lower: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """For each row the x with ``lower @ x = row``, one coordinate after the other.

    Done without the linear algebra library, whose threads may hang in forked workers.
    """
    found = np.zeros(rows.shape)
    for at in range(len(lower)):
        found[:, at] = (rows[:, at] - (found[:, :at] * lower[at, :at]).sum(axis=1)) / lower[at, at]
    return found


def squared(vectors: np.ndarray, point: np.ndarray) -> np.ndarray:
    """The exact squared distance of each vector to the point."""
    return ((vectors - point) ** 2).sum(axis=1)


def possible(apexes: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """For each vector's apex, which centroids' apexes may be the nearest."""
    plane = ((apexes[:, None, :-1] - centroids[None, :, :-1]) ** 2).sum(axis=2)
    height, top = apexes[:, -1:], centroids[None, :, -1]
    lower, upper = plane + (height - top) ** 2, plane + (height + top) ** 2
    margin = MARGIN * ((apexes ** 2).sum(1)[:, None] + (centroids ** 2).sum(1)[None, :] + 1)
    return lower - margin <= (upper + margin).min(axis=1, keepdims=True)


def nearest(vectors: np.ndarray, apexes: np.ndarray, points: np.ndarray,
            places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each vector's nearest point (the first of several) and its exact squared distance."""
    maybe = possible(apexes, places)
    cluster = np.full(len(vectors), -1)
    distance = np.zeros(len(vectors), vectors.dtype)
    for number, point in enumerate(points):
        rows = np.flatnonzero(maybe[:, number])
        own = squared(vectors[rows], point)
        better = (cluster[rows] < 0) | (own < distance[rows])
        cluster[rows[better]], distance[rows[better]] = number, own[better]
    return cluster, distance


def integers(column: pa.Array, size: int) -> np.ndarray:
    """The vectors of a list column, all of ``size`` integers, as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return safe(np.asarray(column.flatten(), np.int64).reshape(-1, size))


def safe(vectors: np.ndarray) -> np.ndarray:
    """The integers in a type whose squares and sums don't overflow."""
    large = len(vectors) and int(max(vectors.max(), -vectors.min())) > EXACT
    return vectors.astype(object) if large else vectors


def whole_vectors(table: DataFrame, vector: str, vec_id: str, size: int) -> DataFrame:
    """``row`` (all columns), ``vec`` (the id) and ``units`` (integers) of the usable vectors.

    Usable are vectors of ``size`` components, none null or non-finite. Components whose integers
    pass 62 bits have no distance that fits a long: they end the job with a message.
    """
    found = table.select(F.struct(*[table[f"`{name}`"] for name in table.columns]).alias("row"),
                         table[f"`{vec_id}`"].cast("string").alias("vec"),
                         F.transform(table[f"`{vector}`"], lambda x: x.cast("double"))
                         .alias("parts"))
    found = found.where((F.size("parts") == size) & F.forall(
        "parts", lambda x: x.isNotNull() & (F.abs(x) < F.lit(math.inf))))
    return found.select("row", "vec", F.transform("parts", lambda x: F.when(
        F.abs(x) <= F.lit(float(1 << 52)), F.floor(x * F.lit(float(SCALE))).cast("long"))
        .otherwise(F.raise_error(F.lit("a component is too large for whole distances"))
                   .cast("long"))).alias("units"))


def first_centroids(vectors: DataFrame, k: int, prefix: str) -> np.ndarray:
    """The k vectors whose ids have the least digests; equal ids in the order of their integers.

    A null id counts as an empty text.
    """
    digest = F.sha2(F.concat(F.lit(prefix), F.coalesce("vec", F.lit(""))), 256)
    rows = vectors.select(digest.alias("digest"), "units").orderBy("digest", "units").limit(k)
    return np.array([row["units"] for row in rows.collect()], np.int64)  # k rows


def clustered(table: DataFrame, k: int = 8, rounds: int = 10, size: int = 64,
              vector: str = "embedding", vec_id: str = "vec_id", prefix: str = "3:") -> DataFrame:
    """``row`` (all columns), ``cluster``, ``distance`` (squared) and the clusters' sums.

    Vectors of another number of components, or with a null or non-finite one, are left out; rows
    that repeat are vectors of their own. Fewer than k vectors make fewer centroids; no vectors
    give no rows. Ties go to the centroid of the smaller number, and an empty centroid stays where
    it is. Columns of the table may have the results' names: they are in ``row``.
    """
    ship_package(table.sparkSession)
    vectors = whole_vectors(table, vector, vec_id, size)
    centroids = safe(first_centroids(vectors, k, prefix).reshape(-1, size))
    fields = "cluster int, distance long, cluster_inertia long, inertia long, " \
             "centroid_sha256 string"
    if not len(centroids):
        none = table.sparkSession.createDataFrame([], T.StructType(
            [vectors.schema["row"], *T._parse_datatype_string(fields).fields]))
        return none
    simplex = Simplex.over(centroids)
    placed = written(_placed(vectors, simplex, size), "apexes", compression="zstd")
    for _ in range(rounds):
        centroids = moved(placed, simplex, centroids, size)
    final = written(_assigned(placed, simplex, centroids, size), "clusters")
    sums = final.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    held = {row["cluster"]: row["cluster_inertia"] for row in sums.collect()}  # k rows
    digests = [hashlib.sha256(",".join(map(str, point.tolist())).encode()).hexdigest()
               for point in centroids]
    of = [held.get(number, 0) for number in range(len(centroids))]

    def by_cluster(values, kind: str):
        return F.element_at(F.array(*map(F.lit, values)), F.col("cluster") + 1).cast(kind)

    return final.select("row", "cluster", "distance", by_cluster(of, "long").alias(
        "cluster_inertia"), F.lit(sum(of)).cast("long").alias("inertia"),
        by_cluster(digests, "string").alias("centroid_sha256"))


def _placed(vectors: DataFrame, simplex: Simplex, size: int) -> DataFrame:
    """The vectors with their apexes: the distances to the pivots, computed once."""
    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = simplex.apexes(integers(batch.column("units"), size)).astype(float)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("units"), _lists(found)],
                ["row", "units", "apex"])

    rows = vectors.select("row", "units")
    return rows.mapInArrow(places, T.StructType(
        [*rows.schema.fields, T.StructField("apex", T.ArrayType(T.DoubleType(), False))]))


def _lists(values: np.ndarray) -> pa.Array:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.reshape(-1)))


def _nearest(batch: pa.RecordBatch, simplex: Simplex, centroids: np.ndarray, places: np.ndarray,
             size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    vectors = integers(batch.column("units"), size)
    apexes = np.asarray(batch.column("apex").flatten(), float).reshape(len(vectors), -1)
    return vectors, *nearest(vectors, apexes, centroids, places)


def moved(placed: DataFrame, simplex: Simplex, centroids: np.ndarray, size: int) -> np.ndarray:
    """The centroids after a round: the floors of their vectors' means."""
    places = simplex.apexes(centroids).astype(float)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(centroids), np.int64)
        totals = np.zeros((len(centroids), size), object)
        for batch in batches:
            vectors, cluster, _ = _nearest(batch, simplex, centroids, places, size)
            for number in np.unique(cluster).tolist():
                own = vectors[cluster == number]
                counts[number] += len(own)
                totals[number] += own.sum(axis=0)
        some = np.flatnonzero(counts)
        at = np.repeat(some, size)
        yield pa.RecordBatch.from_pydict({
            "cluster": pa.array(at, pa.int32()),
            "place": pa.array(np.tile(np.arange(size), len(some)), pa.int32()),
            "members": pa.array(counts[at]),
            "total": pa.array([str(total) for total in totals[some].reshape(-1)], pa.string())})

    parts = placed.select("units", "apex").mapInArrow(
        sums, "cluster int, place int, members long, total string")
    found = parts.groupBy("cluster", "place").agg(
        F.sum("members").alias("members"),
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()  # k x size rows
    points = centroids.astype(object)
    for row in found:
        points[row["cluster"], row["place"]] = int(row["total"]) // row["members"]
    return safe(points.astype(np.int64))


def _assigned(placed: DataFrame, simplex: Simplex, centroids: np.ndarray, size: int) -> DataFrame:
    places = simplex.apexes(centroids).astype(float)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, cluster, distance = _nearest(batch, simplex, centroids, places, size)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(cluster, pa.int32()),
                 pa.array(distance.tolist(), pa.int64())], ["row", "cluster", "distance"])

    return placed.mapInArrow(assign, T.StructType(
        [placed.schema["row"], *T._parse_datatype_string("cluster int, distance long").fields]))
