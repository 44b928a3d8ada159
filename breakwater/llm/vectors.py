"""Near-duplicate vectors by a pivot-permutation index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from breakwater.llm.components import components, smallest_ids
from breakwater.llm.tables import keep

COSINE = 0.95
#: Reference points for each square root of the number of vectors, and their bounds.
PIVOTS_PER_ROOT, LEAST_PIVOTS, MOST_PIVOTS = 4, 32, 4096
#: Nearest reference points that describe a vector, and how many of them a candidate shares.
NEAREST, SHARED = 10, 2
#: Mean cosine of the reference points from which twice as many describe a vector.
ONE_DIRECTION = 0.5
#: Times that the next keys are read to fill up for reference points left out.
PAGES = 8
#: Vectors on one side of a tile of a long pivot list.
TILE = 1024


def _unit(values) -> np.ndarray | None:
    """The vector in double precision and unit length; None if it can't link with anything."""
    if values is None or not len(values) or any(v is None for v in values):
        return None
    x = np.array(values, np.float64)
    if not np.isfinite(x).all() or not (top := np.abs(x).max()):
        return None
    x /= top  # so that squares neither overflow nor vanish
    return x / np.sqrt(x @ x)


def _classes(vectors: DataFrame, vec_id: str, embedding: str) -> tuple[DataFrame, DataFrame]:
    """Each row with the key of its vector (null for those without), and one row per key."""
    rows = vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{embedding}`").alias("embedding"))
    kind = rows.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = [_unit(v) for v in batch.column("embedding").to_pylist()]
            keys = [None if u is None else xxhash.xxh3_128_hexdigest(u.tobytes()) for u in units]
            raw = [None if u is None else u.tobytes() for u in units]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(keys, pa.string()), pa.array(raw, pa.binary())],
                names=["vec_id", "key", "unit"],
            )

    keyed = keep(rows.mapInArrow(run, f"vec_id {kind}, key string, unit binary"), "vectors")
    classes = (
        keyed.where("key IS NOT NULL")
        .groupBy("key")
        .agg(F.any_value("unit").alias("unit"), F.count(F.lit(1)).alias("copies"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    return keyed.select("vec_id", "key"), keep(classes, "classes")


def fit_pivots(classes: DataFrame, count: int, cosine: float = COSINE) -> dict[int, np.ndarray]:
    """Reference points by dimension: distinct vectors in the order of their keys, at most 4096, none
    near another one, so that a dense group has few of them, which its members share. How near is
    measured from the mean of the first ones, so that a direction shared by all vectors leaves out none.

    For each that is left out a next key is looked at, up to ``PAGES`` times ``count`` keys. A
    dimension without enough of them is filled up with seeded random directions.
    """
    by_size: dict[int, np.ndarray] = {}
    middle: dict[int, np.ndarray] = {}
    left, rest = count, classes
    for _ in range(PAGES):
        got = rest.orderBy("key").limit(count).select("key", "unit").collect()
        fresh: dict[int, list[np.ndarray]] = {}
        for row in got:
            x = np.frombuffer(bytes(row.unit), np.float64)
            fresh.setdefault(len(x), []).append(x)
        for size, some in fresh.items():
            known = by_size.get(size, np.empty((0, size)))
            mean = middle.setdefault(size, np.mean(some, axis=0) if len(some) > 1 else np.zeros(size))
            by_size[size] = _apart(known, np.stack(some), 2 * cosine - 1, left, mean)
            left -= len(by_size[size]) - len(known)
        if not left or len(got) < count:
            break
        rest = classes.where(F.col("key") > got[-1].key)
    return {d: x if len(x) >= 2 * NEAREST else np.concatenate([x, _directions(d)]) for d, x in by_size.items()}


def _apart(known: np.ndarray, fresh: np.ndarray, near: float, most: int, mean: np.ndarray) -> np.ndarray:
    """``known`` and up to ``most`` of ``fresh``, each below the cosine ``near``, seen from ``mean``, to
    all taken before."""

    def seen(x: np.ndarray) -> np.ndarray:
        away = x - mean
        return away / np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-300)

    for at in range(0, len(fresh), TILE):
        block = fresh[at : at + TILE]
        block = block[(seen(block) @ seen(known).T < near).all(axis=1)]
        close, taken = seen(block) @ seen(block).T >= near, []
        for k in range(len(block)):
            if len(taken) < most and not close[k, taken].any():
                taken.append(k)
        known, most = np.concatenate([known, block[taken]]), most - len(taken)
    return known


def _described_by(points: np.ndarray) -> int:
    """How many nearest points describe a vector. Where all vectors share a direction, near ones
    differ more in the order of their points, so more are needed to share ``SHARED`` of them."""
    mean = points.mean(axis=0)
    return min(len(points), NEAREST * (1 if mean @ mean < ONE_DIRECTION else 2))


def _directions(size: int) -> np.ndarray:
    x = np.random.default_rng(size).standard_normal((LEAST_PIVOTS, size))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def near_vectors(
    vectors: DataFrame, cosine: float = COSINE, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """Links vectors whose cosine, in double precision, is ``cosine`` or more.

    Equal directions are compared once, with their number of copies. A vector is described by
    its nearest reference points in order; every vector is entered in the inverted list of each
    of them; vectors that share enough points are compared, in the list of the smallest point
    they share, so that a link counts once. Lists longer than a tile are compared tile by tile.
    The reference points are a bounded sample, thinned where vectors are dense (see
    ``fit_pivots``), so that a large group of near copies meets in long lists; all vectors are
    indexed.
    What is linked is certain, some links can be missed: vectors that share too few points.

    Returns one row per row: vec_id, n_links (other rows linked directly), component_id (the
    smallest vec_id reachable), kept (vec_id = component_id). Vectors that are null, empty, zero
    or hold a null or non-finite component, and vectors of different dimension, link with
    nothing. Rows of one vec_id are counted each; an empty table gives no rows; other columns,
    labels too, are ignored.
    """
    rows, classes = _classes(vectors, vec_id, embedding)
    total = classes.count()
    count = int(min(MOST_PIVOTS, max(LEAST_PIVOTS, PIVOTS_PER_ROOT * total**0.5)))
    links = _links(_lists(classes, count, cosine), cosine)
    counts = links.groupBy("node").agg(F.sum("n").alias("_n"))
    stars = links.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    if stars.isEmpty():
        labels = stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
    else:
        labels = components(stars)
    classes = keep(
        classes.join(counts, "node", "left").select(
            F.col("key").alias("_key"), "node", (F.coalesce("_n", F.lit(0)) + F.col("copies") - 1).alias("n_links")
        ),
        "counted",
    )
    noted = keep(rows.join(classes, F.col("key") == F.col("_key"), "left").drop("_key"), "noted")
    found = smallest_ids(noted, labels, "node", "vec_id")
    return found.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        "component_id",
        F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def _lists(classes: DataFrame, count: int, cosine: float) -> DataFrame:
    """Rows of the inverted lists, in tiles: size, pivot, i, j, side, node, copies, unit, near."""
    pivots = classes.sparkSession.sparkContext.broadcast(fit_pivots(classes, count, cosine))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pivots.value
        for batch in batches:
            near, sizes = [], []
            units = [np.frombuffer(u.as_py(), np.float64) for u in batch.column("unit")]
            for size in {len(u) for u in units}:
                points = known.setdefault(size, _directions(size))
                of = [k for k, u in enumerate(units) if len(u) == size]
                similar = np.stack([units[k] for k in of]) @ points.T
                take = _described_by(points)
                first = np.argpartition(-similar, take - 1, axis=1)[:, :take]
                rank = np.argsort(-np.take_along_axis(similar, first, 1), axis=1, kind="stable")
                ordered = np.take_along_axis(first, rank, 1)
                near += list(zip(of, ordered.tolist(), strict=True))
            near = [points for _, points in sorted(near)]
            sizes = [len(u) for u in units]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("node", "copies", "unit")),
                    pa.array(sizes, pa.int32()),
                    pa.array(near, pa.list_(pa.int32())),
                ],
                names=["node", "copies", "unit", "size", "near"],
            )

    described = keep(
        classes.select("node", "copies", "unit").mapInArrow(
            describe, "node long, copies long, unit binary, size int, near array<int>"
        ),
        "described",
    )
    entries = described.select("size", F.explode("near").alias("pivot"), "node")
    lengths = keep(
        entries.groupBy("size", "pivot").agg(F.count(F.lit(1)).alias("length")).where("length > 1"), "lengths"
    )
    parts = F.expr(f"cast(ceil(length / {TILE}) as int)")
    listed = (
        described.withColumn("pivot", F.explode("near"))
        # Lengths of all lists, at most MOST_PIVOTS of each dimension.
        .join(lengths, ["size", "pivot"])
        .withColumn("parts", parts)
        .withColumn("side", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        .withColumn("_other", F.explode(F.expr("sequence(0, parts - 1)")))
        .withColumn("i", F.least("side", "_other"))
        .withColumn("j", F.greatest("side", "_other"))
    )
    return listed.select("size", "pivot", "i", "j", "side", "node", "copies", "unit", "near")


def _links(lists: DataFrame, cosine: float) -> DataFrame:
    """Per tile and vector: node, n (copies linked), root (smallest node it is connected to)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ("size", "pivot", "i", "j")):
            if out := _tile(group, cosine):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in out], names=["node", "n", "root"]
                )

    order = ["size", "pivot", "i", "j"]
    dealt = lists.repartition(*order).sortWithinPartitions(*order, "node")
    return keep(dealt.mapInArrow(run, "node long, n long, root long"), "found")


def _groups(batches: Iterator[pa.RecordBatch], key: tuple) -> Iterator[pa.Table]:
    """Rows of equal key, of batches sorted by it."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in key], 1)
        edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:], strict=False):
            if held and tuple(keys[a]) != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = tuple(keys[a])
    if held:
        yield pa.Table.from_batches(held)


def _tile(group: pa.Table, cosine: float):
    first = group.slice(0, 1).to_pylist()[0]
    x = np.frombuffer(b"".join(group.column("unit").to_pylist()), np.float64).reshape(group.num_rows, -1)
    node, copies, side = (group.column(c).to_numpy() for c in ("node", "copies", "side"))
    # Shared points: the product of 0/1 rows over the points that occur here.
    near = np.array(group.column("near").to_pylist())
    points, at = np.unique(near, return_inverse=True)
    has = np.zeros((len(x), len(points)), np.float32)
    has[np.arange(len(x))[:, None], at.reshape(near.shape)] = 1
    linked = has @ has.T >= SHARED
    linked &= x @ x.T >= cosine
    # A pair belongs to the list of its smallest shared point: none smaller may be shared.
    smaller = has[:, : np.searchsorted(points, first["pivot"])]
    linked &= smaller @ smaller.T == 0
    if first["i"] != first["j"]:
        linked &= side[:, None] != side[None, :]
    np.fill_diagonal(linked, False)
    some = np.flatnonzero(linked.any(axis=1))
    if not len(some):
        return None
    linked = linked[np.ix_(some, some)]
    root = node[some].copy()
    while True:
        least = np.minimum(root, np.where(linked, root[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (least == root).all():
            break
        root = least
    return node[some], linked @ copies[some], root
