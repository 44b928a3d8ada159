"""Jaccard join of word n-gram sets by signature trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from breakwater.llm.bpe import slices
from breakwater.llm.components import components, smallest_ids
from breakwater.llm.tables import bit_filter, discard, filter_bits, keep, marked
from breakwater.llm.vectors import _groups as groups

#: Words in a shingle and the similarity, as a fraction, from which documents link.
WORDS, SIMILARITY = 5, (4, 5)
#: Bits of a signature, children of a tree node, documents on one side of a tile.
BITS, FAN_OUT, TILE = 1024, 16, 1024
#: Other lists of its class that a list knows at most: fewer let a pair be proposed more often, none is missed.
EARLIER = 16
#: Places of the sketch that says how frequent shingles are, and of one slice of it.
PLACE_BITS = 26
PLACES, SLICE = 1 << PLACE_BITS, 1 << 16


class Shingles:
    """Shingle hashes of texts. Nothing is remembered: hashing a word takes less than finding it."""

    def __init__(self, words: int):
        self.words = words
        self.factors = [np.uint64(f | 1) for f in np.random.default_rng(7).integers(1 << 62, 1 << 63, words).tolist()]

    def all(self, text: str) -> tuple[list[bytes], np.ndarray]:
        """The words and the shingles at each place. Only A to Z are lower-cased and only ASCII
        white space separates words."""
        words = text.encode().lower().split()
        if not words:
            return words, np.zeros(0, np.uint64)
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        size = min(self.words, len(words))
        x = np.full(len(words) - size + 1, size, np.uint64)
        for k in range(size):
            x = x * self.factors[k] + h[k : len(h) - size + 1 + k]
            x ^= x >> np.uint64(29)
        return words, x

    def of(self, text: str) -> tuple[str | None, np.ndarray]:
        """A key of the word sequence (null without words) and the distinct shingles, ascending."""
        words, x = self.all(text)
        x.sort()
        distinct = np.append(x[1:] != x[:-1], True) if len(x) else np.zeros(0, bool)
        return (xxhash.xxh3_128_hexdigest(b" ".join(words)) if words else None), x[distinct]


def _sketch(docs: DataFrame, words: int) -> list[bytes]:
    """How often shingles occur, as a sketch over all of them: the documents, by task 255 at most, that
    have each of ``PLACES`` hash values, as a level of six steps to a doubling.

    Levels only settle an order, on which the results don't depend: candidates are looked up by the
    shingles that seem rarest. Tasks count into an array of fixed size and send it in compressed
    slices, as gaps between places that are not empty; the driver gets one byte a place, compressed too.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, counts = Shingles(words), np.zeros(PLACES, np.uint8)
        for batch in batches:
            for text in batch.column("text"):
                at = _places(own.all(text.as_py())[1])
                counts[at] = np.minimum(counts[at], 254) + 1  # a place once for each document
        for k, part in enumerate(counts.reshape(-1, SLICE)):
            at = np.flatnonzero(part)
            if len(at):
                gaps = np.diff(at, prepend=0).astype(np.uint16)
                data = np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 2).T).tobytes() + part[at].tobytes()
                data = pa.compress(data, codec="zstd", asbytes=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int32()), pa.array([len(at)], pa.int32()), pa.array([data])],
                    names=["slice", "n", "data"],
                )

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, n, data in zip(*(batch.column(c).to_pylist() for c in ("slice", "n", "data")), strict=True):
                planes = np.frombuffer(pa.decompress(data, 3 * n, "zstd", asbytes=True), np.uint8).reshape(3, n)
                at = np.cumsum(planes[0].astype(np.int64) + (planes[1].astype(np.int64) << 8))
                if k not in sums:
                    sums[k] = np.zeros(SLICE, np.uint32)
                sums[k][at] += planes[2]
        for k, part in sums.items():
            levels = np.minimum(255, 6 * np.log2(part + 1)).astype(np.uint8)
            data = pa.compress(levels.tobytes(), codec="zstd", asbytes=True)
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([data])], names=["slice", "data"])

    sent = docs.select("text").mapInArrow(counted, "slice int, n int, data binary")
    sums = sent.repartition("slice").mapInArrow(added, "slice int, data binary")
    sketch = [b""] * (PLACES // SLICE)
    for row in sums.collect():
        sketch[row.slice] = bytes(row.data)
    return sketch


def _unpacked(sketch: list[bytes]) -> np.ndarray:
    """The level of each place."""
    levels = np.zeros((len(sketch), SLICE), np.uint8)
    for own, data in zip(levels, sketch, strict=True):
        if data:
            own[:] = np.frombuffer(pa.decompress(data, SLICE, "zstd"), np.uint8)
    return levels.ravel()


def _levels(docs: DataFrame, words: int) -> np.ndarray:
    return _unpacked(_sketch(docs, words))


def lighter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches that hold a few MB of text."""
    for batch in batches:
        for at in slices(batch.column("text")):
            yield batch.slice(*at)


def _places(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(64 - PLACE_BITS)).astype(np.int64)


def _described(docs: DataFrame, words: int, similarity: tuple[int, int]) -> DataFrame:
    """Per row: doc_id, key, n_shingles, prefix (shingles one of which a linked document shares)
    and signature. The sketch is sent compressed, and only a task that runs has its levels: workers
    keep what is sent to them until their next task, also while they wait."""
    some, of = similarity
    sent = docs.sparkSession.sparkContext.broadcast(_sketch(docs, words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, levels = Shingles(words), _unpacked(sent.value)
        for batch in lighter(batches):
            keys, sizes, prefixes, signatures = [], [], [], []
            for text in batch.column("text"):
                key, x = own.of(text.as_py())
                n = len(x)
                # Linked sets share at least the fraction of the larger one.
                take = n - (some * n + of - 1) // of + 1 if n else 0
                rarest = np.argsort(levels[_places(x)], kind="stable")[:take]  # ties in the order of x
                bits = np.zeros(BITS, np.uint8)
                bits[(x >> np.uint64(20)).astype(np.int64) % BITS] = 1
                keys.append(key)
                sizes.append(n)
                prefixes.append(x[rarest].view(np.int64))
                signatures.append(np.packbits(bits).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(keys, pa.string()),
                    pa.array(sizes, pa.int64()),
                    pa.array(prefixes, pa.list_(pa.int64())),
                    pa.array(signatures, pa.binary()),
                ],
                names=["doc_id", "key", "n_shingles", "prefix", "signature"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, key string, n_shingles long, prefix array<long>, signature binary"
    described = keep(docs.mapInArrow(run, schema), "described")
    sent.destroy()
    return described


def similar(
    docs: DataFrame,
    words: int = WORDS,
    similarity: tuple[int, int] = SIMILARITY,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Groups documents that links lead together; two link when intersection / union of their
    sets of word shingles is at least ``similarity`` (a fraction of integers).

    Equal word sequences are one class. Classes that can link share a shingle of their prefix,
    the rarest part of the set; for each such shingle a signature tree over its classes is
    traversed against itself, nodes holding OR-combined bitmaps and size ranges, and pairs of
    nodes whose largest possible overlap is too small are left. What remains is verified on
    whole sets. A first traversal proposes one link for each class, so that a second one, over
    everything, has to propose only pairs that are not yet connected. Classes of a shingle too
    frequent for one tile are compared tile by tile. No pair is missed.

    Returns doc_id, n_shingles, component_id (smallest doc_id reachable, itself included). A
    text of fewer words is one shingle; without words or text a row links with nothing and is its
    own component. Rows of one doc_id are rows each; an empty table gives no rows; other columns
    are ignored.
    """
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )
    described = _described(rows, words, similarity)
    classes = keep(
        described.where("key IS NOT NULL")
        .groupBy("key")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.any_value("n_shingles").alias("n"),
            F.any_value("prefix").alias("prefix"),
            F.any_value("signature").alias("signature"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    tiles = _tiles(classes)
    pairs = _candidates(tiles, None, similarity)
    sets = _sets(rows, classes, _nodes(pairs), words)
    links = _verified(pairs, sets, similarity)
    discard(pairs)
    labels = _labels(links)
    alone = classes.select("node", F.col("node").alias("label"))
    labelled = _labelled(alone, labels)
    pairs = _candidates(tiles, labelled, similarity)
    discard(tiles, labelled)
    further = _sets(rows, classes, _nodes(pairs).join(sets, "node", "left_anti"), words)
    rest = _verified(pairs, sets.unionByName(further), similarity)
    discard(pairs, sets, further)
    if not rest.isEmpty():
        discard(labels)
        labels = _labels(links.unionByName(rest))
    discard(links, rest)
    named = classes.select(F.col("key").alias("_key"), "node")
    noded = keep(
        described.join(named, F.col("key") == F.col("_key"), "left").select("doc_id", "n_shingles", "node"), "noded"
    )
    discard(described, classes)
    return smallest_ids(noded, labels, "node", "doc_id").select("doc_id", "n_shingles", "component_id")


def _labels(links: DataFrame) -> DataFrame:
    if links.isEmpty():
        return keep(links.select(F.col("a").alias("node"), F.col("b").alias("component")), "labels")
    return components(links)


def _labelled(alone: DataFrame, labels: DataFrame) -> DataFrame:
    return keep(
        alone.join(labels, "node", "left").select("node", F.coalesce("component", "label").alias("label")), "labelled"
    )


def _tiles(classes: DataFrame) -> DataFrame:
    """(shingle, i, j, side, node, n, signature, earlier): the classes that share a prefix shingle, and
    other such shingles of each class, whose tiles propose its pairs already."""
    entries = classes.select("node", F.explode("prefix").alias("shingle"))
    shared = (
        entries.groupBy("shingle")
        .agg(
            F.count(F.lit(1)).alias("length"),
            F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("_x"),
            F.bit_xor(F.xxhash64(F.lit(2), "node")).alias("_y"),
        )
        .where("length > 1")
    )
    # Of shingles shared by the very same classes one is enough.
    lists = keep(shared.groupBy("length", "_x", "_y").agg(F.min("shingle").alias("shingle")), "lists")
    # Most entries are in no list; a filter keeps them out of the shuffle.
    bits = filter_bits(lists.count())
    some = bit_filter(lists, ["shingle"], bits)
    entries = marked(entries, some, ["shingle"], bits).where("marked").select("node", "shingle")
    listed = keep(entries.join(lists.select("shingle", "length"), "shingle"), "listed")
    # Of each class its lists, the longest first; a list knows some of those before it.
    own = listed.groupBy("node").agg(F.sort_array(F.collect_list(F.struct(-F.col("length"), "shingle"))).alias("_own"))
    signed = own.join(classes.select("node", "n", "signature"), "node").select(
        "node", "n", "signature", F.col("_own.shingle").alias("_all"), F.posexplode("_own").alias("_at", "_list")
    )
    tiles = keep(
        signed.withColumn("shingle", F.col("_list.shingle"))
        .withColumn("earlier", F.slice("_all", F.lit(1), F.least(F.col("_at"), F.lit(EARLIER))))
        .withColumn("_parts", F.expr(f"cast(ceil(-_list.col1 / {TILE}) as int)"))
        .withColumn("side", F.pmod(F.xxhash64("node"), F.col("_parts")).cast("int"))
        .withColumn("_other", F.explode(F.expr("sequence(0, _parts - 1)")))
        .select(
            "shingle", F.least("side", "_other").alias("i"), F.greatest("side", "_other").alias("j"),
            "side", "node", "n", "signature", "earlier",
        ),
        "tiles",
    )
    discard(lists, some, listed)
    return tiles


def _nodes(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()


def _bitmap(x: np.ndarray) -> bytes:
    """One bit for each shingle among 8 to 16 times as many, a power of two."""
    size = 1 << max(6, (8 * len(x) - 1).bit_length())
    bits = np.zeros(size, np.uint8)
    bits[(x >> np.uint64(20)).astype(np.int64) & (size - 1)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _most_shared(a: bytes, b: bytes, n_a: int, n_b: int) -> int:
    """The largest possible overlap of two sets with these bitmaps; the longer is folded."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    size = min(len(x), len(y))
    x, y = (np.bitwise_or.reduce(z.reshape(-1, size), axis=0) for z in (x, y))
    ones = [int(np.bitwise_count(z).sum()) for z in (x & y, x, y)]
    return ones[0] + min(n_a - ones[1], n_b - ones[2])


def _sets(rows: DataFrame, classes: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """(node, n, bitmap, shingles) of classes, made anew from the text of their first row. A filter of
    the ids keeps the texts of other rows out of the shuffle."""
    needed = keep(
        nodes.join(classes.select("node", "key", F.col("doc_id").alias("_doc")), "node").select("_doc", "key", "node"),
        "needed",
    )
    bits = filter_bits(needed.count())
    ids = bit_filter(needed.select(F.col("_doc").alias("doc_id")), ["doc_id"], bits)
    chosen = marked(rows, ids, ["doc_id"], bits).where("marked")
    chosen = chosen.join(needed, F.col("doc_id").eqNullSafe(F.col("_doc")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Shingles(words)
        for batch in lighter(batches):
            nodes, sizes, bitmaps, sets = [], [], [], []
            for text, key, node in zip(*(batch.column(c) for c in ("text", "key", "node")), strict=True):
                found, x = own.of(text.as_py())
                if found == key.as_py():  # rows of one id can differ
                    nodes.append(node.as_py())
                    sizes.append(len(x))
                    bitmaps.append(_bitmap(x))
                    sets.append(x.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(nodes, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(bitmaps, pa.binary()),
                    pa.array(sets, pa.list_(pa.int64())),
                ],
                names=["node", "n", "bitmap", "shingles"],
            )

    made = chosen.select("text", "key", "node").mapInArrow(
        run, "node long, n long, bitmap binary, shingles array<long>"
    )
    made = keep(made, "sets")
    discard(needed, ids)
    # A class has several sets only where rows repeat both id and text.
    repeated = made.groupBy("node").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    if repeated.isEmpty():
        return made
    single = keep(made.dropDuplicates(["node"]), "sets")
    discard(made)
    return single


def _verified(pairs: DataFrame, sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """The pairs whose sets are similar: by bitmaps those that can be, by their exact
    intersection those that are."""
    some, of = similarity

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = zip(*(batch.column(c).to_pylist() for c in ("_a", "_b", "_n", "_m")), strict=True)
            good = [(of + some) * _most_shared(a, b, n, m) >= some * (n + m) for a, b, n, m in values]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    def sides(pairs: DataFrame, column: str) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
        """The column for the nodes of either end; filters keep the others out of the shuffle."""
        bits, filters, ends = filter_bits(pairs.count()), [], []
        for end, value, size in (("a", "_a", "_n"), ("b", "_b", "_m")):
            filters.append(bit_filter(pairs.select(end), [end], bits))
            named = sets.select(F.col("node").alias(end), F.col(column).alias(value), F.col("n").alias(size))
            ends.append(marked(named, filters[-1], [end], bits).where("marked").drop("marked"))
        return *ends, filters

    one, two, filters = sides(pairs, "bitmap")
    possible_pairs = keep(pairs.join(one, "a").join(two, "b").mapInArrow(possible, "a long, b long"), "possible")
    discard(*filters)
    one, two, filters = sides(possible_pairs, "shingles")
    both = possible_pairs.join(one, "a").join(two, "b").withColumn("_same", F.size(F.array_intersect("_a", "_b")))
    union = F.size("_a") + F.size("_b") - F.col("_same")
    links = keep(both.where(F.col("_same") * of >= union * some).select("a", "b"), "similar")
    discard(possible_pairs, *filters)
    return links


def _candidates(tiles: DataFrame, labels: DataFrame | None, similarity: tuple[int, int]) -> DataFrame:
    """Distinct pairs (a, b) of classes of different label that the trees leave. Without labels every
    class has its own, and of each class in a tile only the pair with the smallest other class is taken."""
    spanning = labels is None

    def new(group: pa.Table, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """False for pairs whose classes have an earlier shingle in common."""
        earlier = dict(zip(group.column("node").to_pylist(), map(set, group.column("earlier").to_pylist()), strict=True))
        pairs = zip(a.tolist(), b.tolist(), strict=True)
        return np.fromiter((earlier[x].isdisjoint(earlier[y]) for x, y in pairs), bool, len(a))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ("shingle", "i", "j")):
            a, b = _traverse(group, similarity)
            if spanning and len(a):
                a, at = np.unique(a, return_index=True)
                b = b[at]
            elif len(a):
                first = new(group, a, b)
                a, b = a[first], b[first]
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    order = ["shingle", "i", "j"]
    named = tiles.drop("earlier").withColumn("label", F.col("node")) if spanning else tiles.join(labels, "node")
    dealt = named.repartition(*order).sortWithinPartitions(*order, "n", "node")
    found = dealt.mapInArrow(run, "a long, b long")
    return keep(found.distinct(), "candidates")


class Tree:
    """Levels of nodes over classes in order of size, the classes themselves first."""

    def __init__(self, signatures: np.ndarray, sizes: np.ndarray, labels: np.ndarray):
        pops = np.bitwise_count(signatures).sum(axis=1).astype(np.int64)
        # Bitmap, smallest and largest size, most shingles beyond the bits, smallest and largest label.
        self.levels = [(signatures, sizes, sizes, sizes - pops, labels, labels)]
        while len(self.levels[-1][0]) > 1:
            bits, least, most, beyond, low, high = self.levels[-1]
            at = np.arange(0, len(bits), FAN_OUT)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(bits, at, axis=0),
                    np.minimum.reduceat(least, at),
                    np.maximum.reduceat(most, at),
                    np.maximum.reduceat(beyond, at),
                    np.minimum.reduceat(low, at),
                    np.maximum.reduceat(high, at),
                )
            )

    def children(self, level: int, nodes: np.ndarray) -> np.ndarray:
        """Of each node its children on the level below, -1 beyond the last."""
        below = nodes[:, None] * FAN_OUT + np.arange(FAN_OUT)
        return np.where(below < len(self.levels[level - 1][0]), below, -1)


def _traverse(group: pa.Table, similarity: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (larger node, smaller node) of a tile that no bound excludes, ascending by both."""
    some, of = similarity
    signatures = np.frombuffer(b"".join(group.column("signature").to_pylist()), np.uint64).reshape(group.num_rows, -1)
    node, sizes, labels, side = (group.column(c).to_numpy() for c in ("node", "n", "label", "side"))
    i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
    left = np.flatnonzero(side == i)
    right = np.flatnonzero(side == j)
    trees = [Tree(signatures[at], sizes[at], labels[at]) for at in (left, right)]
    heights = [len(t.levels) - 1 if len(t.levels[0][0]) else -1 for t in trees]
    if min(heights) < 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    x = np.zeros(1, np.int64)
    y = np.zeros(1, np.int64)
    while True:
        x, y = _possible(trees, heights, x, y, some, of, i == j)
        if not len(x) or heights == [0, 0]:
            break
        parts = []
        for k in range(0, len(x), 4096):  # pairs expand to 256 times as many at most
            cx, cy, below = x[k : k + 4096], y[k : k + 4096], list(heights)
            cx, cy = cx[:, None, None], cy[:, None, None]
            if heights[0] >= max(heights):
                cx = trees[0].children(heights[0], cx[:, 0, 0])[:, :, None]
                below[0] -= 1
            if heights[1] >= max(heights):
                cy = trees[1].children(heights[1], cy[:, 0, 0])[:, None, :]
                below[1] -= 1
            cx, cy = (c.ravel() for c in np.broadcast_arrays(cx, cy))
            real = (cx >= 0) & (cy >= 0)
            parts.append(_possible(trees, below, cx[real], cy[real], some, of, i == j))
        heights = below
        x, y = (np.concatenate(p) for p in zip(*parts, strict=True))
    a, b = node[left[x]], node[right[y]]
    a, b = np.maximum(a, b), np.minimum(a, b)
    order = np.lexsort((b, a))
    return a[order], b[order]


def _possible(trees, heights, x, y, some, of, same: bool):
    """Leaves pairs whose largest possible overlap is large enough, and whose labels differ."""
    bits, least, most, beyond, low, high = trees[0].levels[heights[0]]
    bits2, least2, most2, beyond2, low2, high2 = trees[1].levels[heights[1]]
    if same:  # a tree against itself: each pair once
        once = x <= y if heights[0] else x < y
        x, y = x[once], y[once]
    differ = (low[x] != high[x]) | (low2[y] != high2[y]) | (low[x] != low2[y])
    x, y = x[differ], y[differ]
    needed = some * (least[x] + least2[y])
    fits = (of + some) * np.minimum(most[x], most2[y]) >= needed
    x, y, needed = x[fits], y[fits], needed[fits]
    good = np.zeros(len(x), bool)
    for k in range(0, len(x), 1 << 15):
        at = slice(k, k + (1 << 15))
        shared = np.bitwise_count(bits[x[at]] & bits2[y[at]]).sum(axis=1).astype(np.int64)
        overlap = shared + np.minimum(beyond[x[at]], beyond2[y[at]])
        good[at] = (of + some) * overlap >= needed[at]
    return x[good], y[good]
