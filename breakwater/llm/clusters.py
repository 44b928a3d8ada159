"""Clusters of vectors around centroids: bounds of an N-simplex projection, then exact integers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from breakwater.llm.tables import keep

DIMENSIONS, SCALE, CENTROIDS, ROUNDS, SEED = 64, 1024, 8, 10, 3
#: Pivots of the base simplex, and the vectors they are chosen from.
PIVOTS, CHOSEN_FROM = 16, 64
#: A pivot is taken if it stands this share of its distance above the simplex of those before.
LEAST_ALTITUDE = 0.05
#: Largest scaled component, so that squared distances are exact in 64 bits.
MOST = (1 << 25) - 1


def is_finite(vector: Column) -> Column:
    """Whether the vector is there and holds neither null nor non-finite components."""
    return vector.isNotNull() & F.forall(
        vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    )


def scaled(column: pa.ListArray, size: int, scale: int) -> np.ndarray:
    """floor(scale * x) of every component in double precision, one row per vector."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    whole = np.floor(scale * values)
    if len(whole) and np.abs(whole).max(initial=0) > MOST:
        raise ValueError(f"a component times {scale} is beyond {MOST}: squared distances would not fit")
    return whole.astype(np.int64)


def squared(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Exact squared distances of the points to one centre."""
    apart = points - centre
    return np.einsum("ij,ij->i", apart, apart)


class Simplex:
    """A base simplex of pivots. Distances to the pivots give a point's apex: its coordinates in the
    space of the pivots and its altitude above it."""

    def __init__(self, points: np.ndarray, most: int = PIVOTS):
        pivots, edges = points[:1], np.empty((0, points.shape[1]))
        for point in points[1:]:
            edge = (point - points[0]).astype(np.float64)
            grown = np.vstack([edges, edge])
            # The last diagonal entry of R is the altitude above the simplex so far.
            altitude = abs(np.linalg.qr(grown.T, mode="r")[-1, -1]) if len(grown) <= points.shape[1] else 0.0
            if len(pivots) < most and altitude > LEAST_ALTITUDE * np.linalg.norm(edge):
                pivots, edges = np.vstack([pivots, point]), grown
        self.pivots = pivots
        self.edges = np.array([squared(pivots[1:], pivots[0])], np.float64).reshape(1, -1)
        base = np.linalg.cholesky(edges @ edges.T) if len(edges) else np.empty((0, 0))
        self.inverse = np.linalg.inv(base) if len(edges) else base
        self.error = 1e-13 * (1 + (np.linalg.norm(self.inverse, 2) if len(edges) else 0.0))

    def distances(self, points: np.ndarray) -> np.ndarray:
        return np.stack([squared(points, p) for p in self.pivots], axis=1)

    def apexes(self, distances: np.ndarray) -> np.ndarray:
        """Coordinates, altitude, and what rounding may have changed about them, for each row of
        squared distances to the pivots."""
        d = distances.astype(np.float64)
        along = (d[:, :1] + self.edges - d[:, 1:]) / 2  # products with the edges from the first pivot
        flat = along @ self.inverse.T
        altitude = np.sqrt(np.maximum(d[:, 0] - (flat * flat).sum(axis=1), 0))
        rounding = self.error * (d.max(axis=1) + 1)
        rounding = rounding + np.sqrt(2 * np.sqrt(d[:, 0]) * rounding)  # a small altitude is a root
        return np.column_stack([flat, altitude, rounding])


def candidates(apexes: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Which centres can be nearest: those whose lower bound is not above the least upper bound."""
    flat = apexes[:, None, :-2] - centres[None, :, :-2]
    base = (flat * flat).sum(axis=2)
    up, over = apexes[:, None, -2], centres[None, :, -2]
    lower, upper = base + (up - over) ** 2, base + (up + over) ** 2
    reach = np.sqrt((apexes[:, :-1] ** 2).sum(axis=1))[:, None] + np.sqrt((centres[:, :-1] ** 2).sum(axis=1))[None, :]
    slack = 4 * (reach + 1) * (apexes[:, None, -1] + centres[None, :, -1])
    return lower - slack <= (upper + slack).min(axis=1, keepdims=True)


def nearest(points: np.ndarray, apexes: np.ndarray, centres: np.ndarray, tops: np.ndarray, measured: bool):
    """(cluster, squared distance) of every point. Only centres that the bounds leave are compared,
    ties go to the smaller number. Unless ``measured``, a point with one centre left is not
    measured: its distance is 0."""
    possible = candidates(apexes, tops)
    least = np.full(len(points), np.iinfo(np.int64).max)
    cluster = possible.argmax(axis=1)
    open_ = np.ones(len(points), bool) if measured else possible.sum(axis=1) > 1
    for k, centre in enumerate(centres):
        at = np.flatnonzero(possible[:, k] & open_)
        far = squared(points[at], centre)
        closer = far < least[at]
        least[at[closer]], cluster[at[closer]] = far[closer], k
    return cluster, np.where(open_, least, 0)


def cluster_vectors(
    vectors: DataFrame,
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    seed: int = SEED,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """Assigns vectors to centroids that move to the floored mean of their vectors, in exact integers.

    Vectors of ``dimensions`` components, none null or non-finite, take part; a component x counts as
    floor(scale * x). The first centroids are the vectors with the smallest SHA-256 of
    ``seed:vec_id``. Every vector's squared distances to the pivots, a bounded sample of the vectors, are taken
    once and kept as its apex; each round the apexes of the few centroids give bounds on all
    distances, and only centroids within the bounds are compared in 64-bit integers. Each task adds up its
    vectors by cluster, so a round shuffles one row per task and cluster.

    Returns one row per vector that takes part: vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256.
    Ties go to the smaller centroid; empty centroids stay. Repeated ids are vectors of their own,
    ordered by their components where they start a centroid; null ids come last. With fewer vectors
    than centroids there are as many centroids as vectors; an empty table gives no rows; other columns are
    ignored. A scaled component of 2^25 or more is refused with ValueError.
    """
    named = vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{embedding}`").alias("embedding"))
    kind = named.schema["vec_id"].dataType.simpleString()
    whole = named.where(is_finite(F.col("embedding")) & (F.size("embedding") == dimensions))

    def integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = scaled(batch.column("embedding"), dimensions, scale).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array([p.tobytes() for p in points], pa.binary())], names=["vec_id", "point"]
            )

    points = keep(whole.mapInArrow(integers, f"vec_id {kind}, point binary"), "points")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = points.orderBy(order.asc_nulls_last(), "point").limit(max(centroids, CHOSEN_FROM)).collect()
    start = _points([r.point for r in first], dimensions)
    if not len(start):
        return _result(points.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), start)
    simplex = Simplex(start)
    width = len(simplex.pivots) + 1

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apexes = simplex.apexes(simplex.distances(_points(batch.column("point").to_pylist(), dimensions)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([a.tobytes() for a in apexes], pa.binary())], names=["vec_id", "point", "apex"]
            )

    cached = keep(points.mapInArrow(project, f"vec_id {kind}, point binary, apex binary"), "apexes")

    def assigned(batch: pa.RecordBatch, centres: np.ndarray, tops: np.ndarray, measured: bool):
        own = _points(batch.column("point").to_pylist(), dimensions)
        apexes = np.frombuffer(b"".join(batch.column("apex").to_pylist()), np.float64).reshape(-1, width)
        return own, *nearest(own, apexes, centres, tops, measured)

    centres = start[:centroids]
    for _ in range(rounds):
        centres = _moved(cached, centres, simplex.apexes(simplex.distances(centres)), assigned)
    tops = simplex.apexes(simplex.distances(centres))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, cluster, distance = assigned(batch, centres, tops, True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())],
                names=["vec_id", "cluster", "distance"],
            )

    return _result(keep(cached.mapInArrow(measure, f"vec_id {kind}, cluster int, distance long"), "assigned"), centres)


def _points(raw: list[bytes], size: int) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(r) for r in raw), np.int32).reshape(-1, size).astype(np.int64)


def _moved(cached: DataFrame, centres: np.ndarray, tops: np.ndarray, assigned) -> np.ndarray:
    """The centroids after a round: the floored mean of their vectors, the old place without any."""
    count, size = centres.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(count, np.int64), np.zeros((count, size), np.int64)
        for batch in batches:
            own, cluster, _ = assigned(batch, centres, tops, False)
            for k in np.unique(cluster):
                of = own[cluster == k]
                n[k] += len(of)
                sums[k] += of.sum(axis=0)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(n[used]), pa.array(sums[used].tolist(), pa.list_(pa.int64()))],
            names=["cluster", "n", "sums"],
        )

    parts = cached.mapInArrow(add, "cluster int, n long, sums array<long>")
    totals = parts.groupBy("cluster").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(size)]).alias("sums")
    )
    moved = centres.copy()
    for row in totals.collect():  # one row per centroid
        moved[row.cluster] = [s // row.n for s in row.sums]
    return moved


def _result(rows: DataFrame, centres: np.ndarray) -> DataFrame:
    """Distances summed over clusters and over all, next to each row; one row per centroid is broadcast."""
    spark = rows.sparkSession
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres.tolist()]
    named = spark.createDataFrame(list(enumerate(digests)), "cluster int, centroid_sha256 string")
    # Sums are taken in decimals, which don't run over.
    own = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s"))
    whole = F.sum("s").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    sums = own.select("cluster", F.col("s").cast("long").alias("cluster_inertia"), whole.cast("long").alias("inertia"))
    return (
        rows.join(F.broadcast(sums), "cluster")
        .join(F.broadcast(named), "cluster")
        .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    )

