"""Codes of vectors by a codebook for each part: Hilbert-sorted blocks with boxes and sums."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from breakwater.llm.clusters import is_finite, scaled
from breakwater.llm.tables import attach, keep, partitions

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Parts in one block, and bits of a component in its place on the curve.
BLOCK, CURVE_BITS = 256, 8

BLOCKS = "part int, n int, low binary, high binary, sums binary, members binary, points binary"


def bounds(size: int, parts: int = PARTS) -> list[int]:
    """Where the parts of a vector begin, and its end; sizes that don't divide differ by one."""
    return [size * p // parts for p in range(parts + 1)]


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve through a grid of 2^bits cells a side, as rows of 0/1 digits.

    The transposed axes are found by Skilling's exchange and inversion of bits, for all points at once.
    """
    x = points.astype(np.int64).T.copy()
    size = len(x)
    for level in range(bits - 1, 0, -1):
        side, low = 1 << level, (1 << level) - 1
        for k in range(size):
            inverted = (x[k] & side) != 0
            swapped = np.where(inverted, 0, (x[0] ^ x[k]) & low)
            x[0] = np.where(inverted, x[0] ^ low, x[0] ^ swapped)
            x[k] ^= swapped
    for k in range(1, size):
        x[k] ^= x[k - 1]
    turned = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, 0, -1):
        turned ^= np.where((x[-1] >> level) & 1, (1 << level) - 1, 0)
    x ^= turned
    # The digits of a place are the highest bits of all components, then the next lower ones.
    levels = np.arange(bits - 1, -1, -1)
    return ((x[None, :, :] >> levels[:, None, None]) & 1).reshape(bits * size, -1).T.astype(np.uint8)


def shortlists(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """For each box, which entries can be nearest to a point inside: those whose least distance to the box
    isn't above the smallest of all greatest distances."""
    below, above = low[:, None, :] - entries[None, :, :], entries[None, :, :] - high[:, None, :]
    least = np.maximum(np.maximum(below, above), 0)
    most = np.maximum(np.abs(below), np.abs(above))
    least, most = (least * least).sum(axis=2), (most * most).sum(axis=2)
    return least <= most.min(axis=1, keepdims=True)


def nearest(points: np.ndarray, entries: np.ndarray, listed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of each point, exact; ties go to the lower index."""
    some = np.flatnonzero(listed)
    apart = points[:, None, :] - entries[None, some, :]
    far = np.einsum("ijk,ijk->ij", apart, apart)
    best = far.argmin(axis=1)
    return some[best], far[np.arange(len(far)), best]


def compress(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """Replaces each part of a vector by the index of the nearest entry of that part's codebook.

    Vectors that are null or hold a null or non-finite component are left out; a component x
    counts as floor(scale * x). Each codebook starts as the parts of the vectors of smallest id
    and moves ``rounds`` times to the floored means. The parts at one position are sorted along a Hilbert
    curve by a range shuffle and cut into blocks, which hold their smallest and largest components,
    sums and points. In each round the distances of the entries to a block's box leave a shortlist; a block
    with one entry left is added by its sums, the others are compared in 64-bit integers. A round shuffles one row per task,
    position and entry; the codebooks are all that reaches the driver.

    Returns one row per vector: vec_id, code (two hex digits a part), error (squared distances,
    summed), label_error (errors of equal labels, summed; nulls are one label), codebooks_sha256.
    Repeated ids are vectors of their own, ordered by their components where they start a codebook; null
    ids come last. With fewer vectors than entries there are as many entries as vectors. A size that
    doesn't divide gives parts that differ by one component. Vectors of another size than the commonest (of
    equally common ones the larger) get null as code and error. An empty table gives no rows; other
    columns are ignored. A scaled component of 2^25 or more is refused with ValueError.
    """
    named = vectors.select(
        F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{label}`").alias("label"), F.col(f"`{embedding}`").alias("embedding")
    )
    kept = named.where(is_finite(F.col("embedding"))).withColumn("size", F.size("embedding"))
    ids, kind = named.schema["vec_id"].dataType.simpleString(), named.schema["label"].dataType.simpleString()

    def integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, raw = batch.column("size").to_numpy(), [b""] * batch.num_rows
            for size in np.unique(sizes[sizes > 0]).tolist():
                at = np.flatnonzero(sizes == size)
                for k, p in zip(at, scaled(batch.column("embedding").take(pa.array(at)), size, scale), strict=True):
                    raw[k] = p.astype(np.int32).tobytes()
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("vec_id", "label", "size")), pa.array(raw, pa.binary())],
                names=["vec_id", "label", "size", "point"],
            )

    rows = keep(
        kept.mapInArrow(integers, f"vec_id {ids}, label {kind}, size int, point binary").withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "points",
    )
    common = rows.groupBy("size").count().orderBy(F.desc("count"), F.desc("size")).first()
    size = common["size"] if common else 0
    cut = bounds(size, parts)
    usual = rows.where(F.col("size") == size)
    first = usual.orderBy(F.col("vec_id").asc_nulls_last(), "point").limit(entries).collect()
    start = np.stack([_ints(r.point, size)[0] for r in first]) if first else np.empty((0, size), np.int64)
    books = [start[:, a:b] for a, b in zip(cut, cut[1:], strict=False)]
    if first:
        blocks = _blocks(usual, cut)
        for _ in range(rounds):
            books = _moved(blocks, books)
        coded = _coded(blocks, books)
    else:
        coded = rows.select("row", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    digest = hashlib.sha256(",".join(str(v) for book in books for v in book.ravel().tolist()).encode()).hexdigest()

    noted = keep(rows.select("row", "vec_id", "label").join(coded, "row", "left"), "coded")
    sums = keep(
        noted.groupBy("label").agg(
            F.count(F.lit(1)).alias("_n"), F.sum(F.col("error").cast("decimal(20,0)")).cast("long").alias("label_error")
        ),
        "labels",
    )
    return attach(noted, sums, ["label"], "_n", rows.count()).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )


def _ints(raw: bytes, size: int) -> np.ndarray:
    return np.frombuffer(bytes(raw), np.int32).reshape(-1, max(size, 1))[:, :size].astype(np.int64)


def _blocks(rows: DataFrame, cut: list[int]) -> DataFrame:
    """Blocks of parts that lie together on the curve, written down: see ``BLOCKS``."""
    size, parts = cut[-1], len(cut) - 1
    low, high = _extent(rows, size)
    span = np.maximum(high - low, 1)

    def parted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = _ints(b"".join(batch.column("point").to_pylist()), size) if size else np.empty((batch.num_rows, 0), np.int64)
            for p in range(parts):
                a, b = cut[p], cut[p + 1]
                bits = max(1, min(CURVE_BITS, 64 // max(b - a, 1)))
                grid = (whole[:, a:b] - low[a:b]) * ((1 << bits) - 1) // span[a:b]
                places = np.packbits(hilbert(grid, bits), axis=1) if b > a else np.zeros((len(whole), 1), np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(whole), p, np.int32)),
                        pa.array([k.tobytes() for k in places], pa.binary()),
                        batch.column("row"),
                        pa.array([v.tobytes() for v in whole[:, a:b].astype(np.int32)], pa.binary()),
                    ],
                    names=["part", "place", "row", "point"],
                )

    order = ["part", "place", "row"]  # the row splits a place that very many parts share
    dealt = (
        rows.select("row", "point")
        .mapInArrow(parted, "part int, place binary, row long, point binary")
        .repartitionByRange(partitions(rows.sparkSession), *order)
        .sortWithinPartitions(*order)
    )

    def cut_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch.select(["part", "row", "point"]))
            if sum(h.num_rows for h in held) < BLOCK:
                continue
            whole, held = _full_blocks(pa.Table.from_batches(held), cut, False)
            yield from whole
        if held:
            yield from _full_blocks(pa.Table.from_batches(held), cut, True)[0]

    return keep(dealt.mapInArrow(cut_blocks, BLOCKS), "blocks")


def _full_blocks(table: pa.Table, cut: list[int], last: bool):
    """The blocks of sorted rows, and the rows left for the next ones."""
    part = table.column("part").to_numpy()
    edges = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)]
    out, rest = [], []
    for a, b in zip(edges, edges[1:], strict=False):
        for at in range(a, b, BLOCK):
            some = table.slice(at, min(BLOCK, b - at))
            if not last and b == len(part) and some.num_rows < BLOCK:
                rest = some.combine_chunks().to_batches()
                continue
            width = cut[part[a] + 1] - cut[part[a]]
            points = _ints(b"".join(some.column("point").to_pylist()), width) if width else np.empty((len(some), 0), np.int64)
            members = some.column("row").to_numpy().astype(np.int64)
            out.append(
                (
                    part[a],
                    len(points),
                    *(v.astype(np.int64).tobytes() for v in (points.min(axis=0), points.max(axis=0), points.sum(axis=0))),
                    members.tobytes(),
                    points.astype(np.int32).tobytes(),
                )
            )
    if not out:
        return [], rest
    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
    columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
    names = ["part", "n", "low", "high", "sums", "members", "points"]
    return [pa.RecordBatch.from_arrays(columns, names=names)], rest


def _extent(rows: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest value of every component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            points = _ints(b"".join(batch.column("point").to_pylist()), size)
            if len(points):
                found = [np.min([*found[:1], points.min(axis=0)], axis=0), np.max([*found[1:], points.max(axis=0)], axis=0)]
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(size), pa.int32()), *(pa.array(f, pa.int64()) for f in found)], names=["at", "low", "high"]
            )

    if not size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends = rows.mapInArrow(run, "at int, low long, high long").groupBy("at").agg(F.min("low"), F.max("high"))
    got = np.array(sorted(map(tuple, ends.collect())), np.int64)  # one row per component
    return got[:, 1], got[:, 2]


def _decided(batch: pa.RecordBatch, books: list[np.ndarray]):
    """For each block of a batch: its fields and the shortlist of entries."""
    parts = batch.column("part").to_numpy()
    blocks = batch.to_pylist()
    for p in np.unique(parts).tolist():
        of, entries = [b for b, q in zip(blocks, parts, strict=True) if q == p], books[p]
        size = entries.shape[1]
        boxes = [_longs([b[end] for b in of], size) for end in ("low", "high")]
        for block, listed in zip(of, shortlists(*boxes, entries), strict=True):
            yield p, block, entries, listed


def _longs(raw: list[bytes], size: int) -> np.ndarray:
    return np.frombuffer(b"".join(raw), np.int64).reshape(len(raw), size)


def _members(block: dict, entries: np.ndarray) -> np.ndarray:
    size = entries.shape[1]
    return _ints(block["points"], size) if size else np.empty((block["n"], 0), np.int64)


def _moved(blocks: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after a round; entries without parts stay."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(b), np.int64) for b in books]
        sums = [np.zeros(b.shape, np.int64) for b in books]
        for batch in batches:
            for p, block, entries, listed in _decided(batch, books):
                if listed.sum() == 1:
                    k = int(listed.argmax())
                    counts[p][k] += block["n"]
                    sums[p][k] += _longs([block["sums"]], entries.shape[1])[0]
                    continue
                points = _members(block, entries)
                entry, _ = nearest(points, entries, listed)
                for k in np.unique(entry):
                    of = points[entry == k]
                    counts[p][k] += len(of)
                    sums[p][k] += of.sum(axis=0)
        used = [(p, k, counts[p][k], sums[p][k].tolist()) for p in range(len(books)) for k in np.flatnonzero(counts[p])]
        if used:
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
            columns = [pa.array(c, t) for c, t in zip(zip(*used, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "n", "sums"])

    width = max(b.shape[1] for b in books)
    small = blocks.select("part", "n", "low", "high", "sums", "points")
    found = small.mapInArrow(add, "part int, entry int, n long, sums array<long>")
    totals = found.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(width)]).alias("sums")
    )
    moved = [b.copy() for b in books]
    for row in totals.collect():  # one row per part and entry
        book = moved[row.part]
        book[row.entry] = [s // row.n for s in row.sums[: book.shape[1]]]
    return moved


def _coded(blocks: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """row, code, error of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p, block, entries, listed in _decided(batch, books):
                entry, far = nearest(_members(block, entries), entries, listed)
                columns = [np.frombuffer(block["members"], np.int64), np.full(len(entry), p, np.int32)]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, columns), pa.array(entry, pa.int32()), pa.array(far, pa.int64())],
                    names=["row", "part", "entry", "far"],
                )

    found = blocks.select("part", "n", "low", "high", "members", "points").mapInArrow(
        run, "row long, part int, entry int, far long"
    )
    each = [
        F.lower(F.lpad(F.hex(F.max(F.when(F.col("part") == p, F.col("entry")))), 2, "0")) for p in range(len(books))
    ]
    return found.groupBy("row").agg(F.concat(*each).alias("code"), F.sum("far").alias("error"))
