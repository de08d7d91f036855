"""Clusters around integer centroids, with centroids ruled out by n-simplex projection.

Distances to p pivots, computed once per vector, place it as the apex of a simplex over the pivots: p - 1 coordinates
in their hull and a height above it. For a vector and a centroid, the Euclidean distance of their apexes is a lower bound of their
distance, and an upper bound with one height turned over. Centroids whose lower bound is above the least upper bound
are ruled out; the others are compared exactly, in integers. Bounds are floating point and have a margin, so
rounding never decides.

Vectors stay in tasks: a round sends back one sum per centroid and component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged

COMPONENTS = 64
SCALE = 1024  # a component x is the integer floor(SCALE * x)
CLUSTERS = 8
ROUNDS = 10
SEED = 3
PIVOTS = 16  # of the first OFFERED vectors in seeded order, each the one farthest from those before
OFFERED = 64
_LEAST_HEIGHT = 0.1  # of a pivot above the hull of those before it, as part of its distance to the first
_MARGIN = 1e-7  # of the squared lengths that a bound is computed from
_NARROW = 1 << 27  # components below it have squared distances that fit 64 bits
_LONG = (1 << 63) - 1
_PARTS = "cluster INT, place INT, total DECIMAL(38,0), members BIGINT"


class Simplex(NamedTuple):
    """Pivots and their coordinates: the first is the origin, each further one adds a dimension."""

    pivots: np.ndarray
    places: np.ndarray  # (pivots, pivots - 1)
    solve: np.ndarray  # inverse of the lower triangle of 2 * places[1:]

    def apexes(self, squared: np.ndarray) -> np.ndarray:
        """Coordinates of points, the height last, from their squared distances to the pivots."""
        known = squared[:, :1] - squared[:, 1:] + (self.places[1:] ** 2).sum(axis=1)
        inside = known @ self.solve.T
        height = np.sqrt(np.maximum(0, squared[:, 0] - (inside**2).sum(axis=1)))
        return np.column_stack([inside, height])


def squared_distances(vectors: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Of every vector to every other, in floating point; exact while squares stay below 2^53."""
    found = np.empty((len(vectors), len(others)))
    mine = vectors.astype(np.float64)
    for i, other in enumerate(others.astype(np.float64)):
        found[:, i] = ((mine - other) ** 2).sum(axis=1)
    return found


def simplex_of(vectors: np.ndarray, pivots: int = PIVOTS) -> Simplex:
    """A simplex over some of the vectors, each far from those before and well above their hull."""
    chosen = Simplex(vectors[:1], np.zeros((1, 0)), np.zeros((0, 0)))
    nearest = squared_distances(vectors, chosen.pivots)[:, 0]
    while len(chosen.pivots) < pivots and nearest.max(initial=0) > 0:
        at = int(nearest.argmax())
        squared = squared_distances(vectors[at : at + 1], chosen.pivots)
        apex = chosen.apexes(squared)[0]
        if apex[-1] > _LEAST_HEIGHT * np.sqrt(squared[0, 0]):
            places = np.vstack([np.column_stack([chosen.places, np.zeros(len(chosen.places))]), apex])
            taken = np.vstack([chosen.pivots, vectors[at]])
            chosen = Simplex(taken, places, np.linalg.inv(2 * places[1:]))
            nearest = np.minimum(nearest, squared_distances(vectors, vectors[at : at + 1])[:, 0])
        nearest[at] = 0
    return chosen


def possible(apexes: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """For every vector and centroid, by their apexes, whether no other centroid is nearer for certain."""
    mine, theirs = (apexes**2).sum(axis=1)[:, None], (centroids**2).sum(axis=1)[None, :]
    low = mine + theirs - 2 * apexes @ centroids.T
    high = low + 4 * apexes[:, -1:] * centroids[:, -1]
    margin = _MARGIN * (mine + theirs) + 1
    return low - margin <= (high + margin).min(axis=1, keepdims=True)


def is_wide(vectors: np.ndarray) -> bool:
    """Whether a component is so large that squared distances may not fit 64 bits."""
    return bool(vectors.max(initial=0) >= _NARROW or vectors.min(initial=0) <= -_NARROW)


def exact_squares(vectors: np.ndarray, centroid: list[int]) -> np.ndarray:
    """Squared distances in whole numbers; beyond 64 bits in Python's."""
    kind = object if is_wide(vectors) or max(map(abs, centroid)) >= _NARROW else np.int64
    return ((vectors.astype(kind) - np.array(centroid, kind)) ** 2).sum(axis=1)


def nearest(vectors: np.ndarray, apexes: np.ndarray, centroids: list[list[int]], simplex: Simplex) -> tuple:
    """Number and squared distance of each vector's nearest centroid; the smaller number on ties."""
    corners = simplex.apexes(squared_distances(np.array(centroids, np.float64), simplex.pivots))
    open_ = np.ones((len(vectors), len(centroids)), bool) if is_wide(vectors) else possible(apexes, corners)
    cluster = np.full(len(vectors), -1, np.int32)
    distance = np.zeros(len(vectors), np.int64)
    for number, centroid in enumerate(centroids):
        rows = np.flatnonzero(open_[:, number])
        if not len(rows):
            continue
        squares = exact_squares(vectors[rows], centroid)
        if squares.dtype == object and distance.dtype != object:
            distance = distance.astype(object)
        nearer = (cluster[rows] < 0) | (squares < distance[rows])
        cluster[rows[nearer]], distance[rows[nearer]] = number, squares[nearer]
    return cluster, distance


def _matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, width)


def projector(simplex: Simplex, width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds the apex to (id, vector) batches."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column(1), width, np.int64)
            apexes = simplex.apexes(squared_distances(vectors, simplex.pivots))
            ends = pa.array(np.arange(0, apexes.size + 1, apexes.shape[1]), pa.int32())
            columns = [*batch.columns, pa.ListArray.from_arrays(ends, pa.array(apexes.ravel()))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "vector", "apex"])

    return project


def summer(centroids: list[list[int]], simplex: Simplex) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums per centroid and component of (vector, apex) batches, once per task."""
    width = len(centroids[0])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, members = np.zeros((len(centroids), width), object), [0] * len(centroids)
        for batch in batches:
            vectors = _matrix(batch.column(0), width, np.int64)
            cluster, _ = nearest(vectors, _matrix(batch.column(1), len(simplex.pivots), np.float64), centroids, simplex)
            kind = object if is_wide(vectors) else np.int64
            for number in np.unique(cluster):
                mine = vectors[cluster == number]
                totals[number] += mine.astype(kind).sum(axis=0)
                members[number] += len(mine)
        rows = [(n, i, Decimal(int(totals[n, i])), members[n]) for n in range(len(centroids)) if members[n] for i in range(width)]
        kinds = (pa.int32(), pa.int32(), pa.decimal128(38, 0), pa.int64())
        columns = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(columns, names=["cluster", "place", "total", "members"])

    return add


def assigner(centroids: list[list[int]], simplex: Simplex) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``id, cluster, distance`` of (id, vector, apex) batches; a distance beyond 64 bits is null."""
    width = len(centroids[0])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column(1), width, np.int64)
            cluster, distance = nearest(vectors, _matrix(batch.column(2), len(simplex.pivots), np.float64), centroids, simplex)
            if distance.dtype == object:
                distance = [int(d) if d <= _LONG else None for d in distance]
            columns = [batch.column(0), pa.array(cluster), pa.array(distance, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "cluster", "distance"])

    return assign


def integer_vectors(vectors: DataFrame, vector: str, vec_id: str, width: int, scale: int) -> DataFrame:
    """``id, vector``: vectors of the right width without null or non-finite components, in whole numbers."""
    given = F.col(f"`{vector}`")
    numbers = F.transform(given, lambda x: x.cast("double"))
    sound = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.filter((F.size(given) == width) & sound)
    # Beyond a long, a component counts as the nearest long.
    whole = F.transform(numbers, lambda x: F.when(F.abs(x * scale) < 2.0**63, F.floor(x * scale)).otherwise(
        F.when(x < 0, F.lit(-_LONG - 1)).otherwise(F.lit(_LONG))
    ))
    return kept.select(F.col(f"`{vec_id}`").alias("id"), whole.alias("vector"))


def centroid_sha256(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def moved(rows: DataFrame, centroids: list[list[int]], simplex: Simplex) -> list[list[int]]:
    """The centroids after a round: exact floors of the means; an empty one stays."""
    parts = rows.select("vector", "apex").mapInArrow(summer(centroids, simplex), _PARTS)
    sums = parts.groupBy("cluster", "place").agg(F.sum("total").alias("total"), F.sum("members").alias("members"))
    after = [list(centroid) for centroid in centroids]
    for row in sums.collect():  # clusters x components rows
        after[row["cluster"]][row["place"]] = int(row["total"]) // row["members"]
    return after


def cluster(
    vectors: DataFrame,
    vector: str = "embedding",
    vec_id: str = "vec_id",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    seed: int = SEED,
    width: int = COMPONENTS,
    scale: int = SCALE,
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, centroid`` per kept vector.

    Vectors with ``width`` components, none null or non-finite, are kept; others have no row. Centroids start as the kept
    vectors with the smallest SHA-256 of ``seed:id``; rows that repeat an id stand in order of their
    components. Each round assigns every vector to the nearest centroid (squared distance, the smaller number on ties) and
    moves centroids to the floors of their means; empty ones stay. Fewer vectors than centroids make fewer centroids. Vectors with a
    null id are clustered but start no centroid; without any id there is no centroid and no row. Equal vectors lie in one
    cluster. Components beyond a long count as its ends; distances and sums beyond a long are null.
    Other columns are not read. An empty table gives an empty table.

    Every round reads the staged vectors once and returns ``clusters * width`` sums; centroids, pivots and their coordinates are
    the only data that every task gets, and their size does not depend on the table.
    """
    kind = vectors.select(F.col(f"`{vec_id}`")).schema[0].dataType.simpleString()
    whole = integer_vectors(vectors, vector, vec_id, width, scale)
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    seeded = whole.filter(F.col("id").isNotNull()).select(key.alias("key"), "vector").orderBy("key", "vector")
    first = [row["vector"] for row in seeded.limit(max(clusters, OFFERED)).collect()]
    schema = f"`{vec_id}` {kind}, cluster INT, distance BIGINT, cluster_inertia BIGINT, inertia BIGINT, centroid_sha256 STRING, centroid ARRAY<BIGINT>"
    if not first:
        return vectors.sparkSession.createDataFrame([], schema)
    simplex, centroids = simplex_of(np.array(first, np.int64)), first[:clusters]
    rows = staged(whole.mapInArrow(projector(simplex, width), f"id {kind}, vector ARRAY<BIGINT>, apex ARRAY<DOUBLE>"), "apexes")
    for _ in range(rounds):
        before, centroids = centroids, moved(rows, centroids, simplex)
        if centroids == before:  # every further round would be the same
            break
    assigned = staged(rows.mapInArrow(assigner(centroids, simplex), f"id {kind}, cluster INT, distance BIGINT"), "assigned")
    # Sums of longs in decimals; a null distance makes its sums null.
    total = F.when(F.count("distance") == F.count(F.lit(1)), F.sum(F.col("distance").cast("decimal(38,0)")))
    sums = {row["cluster"]: row["total"] for row in assigned.groupBy("cluster").agg(total.alias("total")).collect()}

    def fitting(value: int | None) -> int | None:
        return None if value is None or value > _LONG else int(value)

    inertia = None if None in sums.values() else fitting(sum(sums.values()))
    facts = [(n, fitting(sums[n]), inertia, centroid_sha256(centroids[n]), centroids[n]) for n in sorted(sums)]
    named = vectors.sparkSession.createDataFrame(facts, ", ".join(["cluster INT", *schema.split(", ")[3:]]))
    joined = assigned.join(F.broadcast(named), "cluster")  # one row per centroid
    return joined.withColumnRenamed("id", vec_id).select(F.col(f"`{vec_id}`"), "cluster", "distance", *named.columns[1:])
