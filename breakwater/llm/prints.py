"""Document fingerprints from prefix polynomial hashes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from breakwater.llm.tables import keep, partitions

#: Two moduli with a base each; products of residues fit in 64 bits.
MODULI = ((2147483647, 911382323), (2147483629, 972663749))
#: Code points in a span, and spans in a fingerprint.
SPAN, KEPT = 24, 64
#: Parts of the order per shuffle partition.
RANGES = 4

_powers: list[np.ndarray] = []


def _grown(n: int) -> list[np.ndarray]:
    """For each modulus: powers of its base and of the base's inverse, n of them at least."""
    if not _powers or _powers[0].shape[1] < n:
        size, fresh = 1 << max(12, n.bit_length()), []
        for p, base in MODULI:
            rows = []
            for b in (base, pow(base, -1, p)):
                got = np.ones(1, np.uint64)
                while len(got) < size:
                    got = np.concatenate([got, got * np.uint64(pow(b, len(got), p)) % np.uint64(p)])
                rows.append(got)
            fresh.append(np.stack(rows))
        _powers[:] = fresh
    return _powers


class Prefixes:
    """Modular prefix arrays of a text; every span's hash is a difference of two entries."""

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)
        self.n = n = len(codes)
        self.sums = []
        for (p, _), powers in zip(MODULI, _grown(n + 1), strict=True):
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(codes * powers[0, :n] % np.uint64(p), out=sums[1:])
            self.sums.append(sums % np.uint64(p))

    def spans(self, start: np.ndarray | int, length: int) -> np.ndarray:
        """The hash of each span of ``length`` code points from ``start``, of 62 bits."""
        start = np.atleast_1d(start)
        out = []
        for (p, _), powers, sums in zip(MODULI, _grown(self.n + 1), self.sums, strict=True):
            diff = sums[start + length] + np.uint64(p) - sums[start]
            out.append(diff % np.uint64(p) * powers[1][start] % np.uint64(p))
        return out[0] << np.uint64(31) | out[1]

    def windows(self, length: int) -> np.ndarray:
        """The hash of every span of that length."""
        last = self.n - length + 1
        out = []
        for (p, _), powers, sums in zip(MODULI, _grown(self.n + 1), self.sums, strict=True):
            diff = sums[length:] + np.uint64(p) - sums[:last]
            out.append(diff % np.uint64(p) * powers[1, :last] % np.uint64(p))
        return out[0] << np.uint64(31) | out[1]

    def same(self, i: int, other: Prefixes, j: int, length: int) -> bool:
        """Whether the span from i equals the other text's span from j."""
        return self.spans(i, length)[0] == other.spans(j, length)[0]

    def extension(self, i: int, other: Prefixes, j: int) -> int:
        """The length of the longest common extension from i and j, by binary search."""
        low, high = 0, min(self.n - i, other.n - j)
        while low < high:
            mid = (low + high + 1) // 2
            if self.same(i, other, j, mid):
                low = mid
            else:
                high = mid - 1
        return low

    def fingerprint(self) -> str:
        """The number of code points and the whole text's hash, then the smallest distinct span
        hashes, mixed to 32 bits, in hexadecimal. A shorter text is one span, an empty one none."""
        mixed = np.zeros(0, np.uint64)
        if self.n:
            x = self.windows(min(SPAN, self.n))
            x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(32)
            most = 4 * KEPT
            if len(x) > most:  # most spans differ, so that few need sorting
                few = np.unique(np.partition(x, most)[:most])
                x = few if len(few) >= KEPT else x
            mixed = np.unique(x)[:KEPT]
        whole = int(self.spans(0, self.n)[0])
        return f"{self.n:x}-{whole:016x}-" + "".join(f"{v:08x}" for v in mixed.tolist())


def likeness(a: str, b: str) -> float:
    """How alike two texts are by their fingerprints alone, from 0 to 1.

    1 for equal fingerprints. Else the share of spans that both texts have, among the smallest
    span hashes of the two: an estimate of the Jaccard similarity of their span sets.
    """
    if a == b:
        return 1.0
    x, y = _span_set(a), _span_set(b)
    least = sorted(x | y)[:KEPT]
    return sum(v in x and v in y for v in least) / len(least) if least else 0.0


def _span_set(fingerprint: str) -> set[str]:
    spans = fingerprint.rpartition("-")[2]
    return {spans[k : k + 8] for k in range(0, len(spans), 8)}


def edited(text: str, following: str) -> str:
    """The text with its last half (rounded down) replaced by the start of the next document."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def in_order(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, text, part) in ascending order inside each part, and from part to part.

    One range shuffle, of which the number of parts is a setting. Repeated rows tie on id and
    text; their place in the input sets them apart, so that they spread over parts as others do.
    """
    order = [F.col("doc_id"), F.col("_mix"), F.col("_row")]
    return (
        docs.select(
            F.col(f"`{doc_id}`").alias("doc_id"),
            F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
        )
        .withColumn("_mix", F.xxhash64("text"))
        .withColumn("_row", F.monotonically_increasing_id())
        .repartitionByRange(partitions(docs.sparkSession) * RANGES, *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text", F.spark_partition_id().alias("part"))
    )


#: What a comparison writes down of a document, digests as bytes.
COMPARED = (
    "n_chars long, edited_chars long, edited_sha256 binary, print binary, edited_print binary, "
    "near_edited double, near_next double, common_edited long, common_next long"
)


def compare_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints every whole text and its edited text, and compares.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and
    near_next (likeness to the edited text's and the next document's fingerprint), common_edited
    and common_next (code points that the text shares with them from its start, found by
    binary search). Null texts count as empty; a null doc_id is the smallest; documents of the
    same id follow each other by a hash of their text; a single document is its own next. An
    empty table gives no rows, other columns are ignored. A task holds two documents at a time.

    Each part of the order is compared in one task, which leaves its first and its last text
    beside the results. These, two for each part, are then compared from part to part. The
    first results are written, since the parts could be cut elsewhere when computed again.
    """
    rows = in_order(docs, doc_id, text)
    own_id = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}"

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            kind, out = batch.schema.field("doc_id").type, []
            for doc, own, part in zip(*(batch.column(c) for c in ("doc_id", "text", "part")), strict=True):
                now = _described(doc.as_py(), own.as_py())
                if held is None:
                    out.append(_end(now, part.as_py(), True))
                else:
                    out.append((*_row(held, now), None, None, None))
                held, at = now, part.as_py()
            if out:
                yield _batch(out, kind, ENDS)
        if held is not None:
            yield _batch([_end(held, at, False)], kind, ENDS)

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c) for c in ("doc_id", "text", "following"))
            for doc, own, following in zip(*columns, strict=True):
                row = _row(_described(doc.as_py(), own.as_py()), _described(None, following.as_py()))
                yield _batch([row], batch.schema.field("doc_id").type)

    written = keep(rows.mapInArrow(inside, f"{own_id}, {COMPARED}, part int, first boolean, text string"), "compared")
    ends = written.where(F.col("part").isNotNull()).select("doc_id", "text", "part", "first")
    firsts = ends.where("first").select(F.col("part").alias("_next"), F.col("text").alias("following"))
    # Numbers of parts only; the last is followed by the first, parts may be empty.
    order = Window.orderBy("part")
    turn = ends.where("first").select(
        "part",
        F.coalesce(F.lead("part").over(order), F.first("part").over(order)).alias("_next"),
    )
    lasts = ends.where(~F.col("first")).join(turn, "part").join(firsts, "_next")
    met = lasts.select("doc_id", "text", "following").mapInArrow(across, f"{own_id}, {COMPARED}")
    both = written.where(F.col("part").isNull()).drop("part", "first", "text").unionByName(met)
    return both.select(
        "doc_id",
        "n_chars",
        F.lower(F.hex("edited_sha256")).alias("edited_sha256"),
        _shown("n_chars", "print").alias("fingerprint"),
        _shown("edited_chars", "edited_print").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        "common_edited",
        "common_next",
    )


def _shown(n_chars: str, digest: str) -> Column:
    """The text form of a fingerprint that was written as bytes."""
    digits = F.hex(digest)
    return F.lower(
        F.concat_ws("-", F.hex(n_chars), F.substring(digits, 1, 16), F.substr(digits, F.lit(17)))
    )


def _packed(fingerprint: str) -> bytes:
    return bytes.fromhex("".join(fingerprint.split("-")[1:]))


def _described(doc: object, text: str) -> tuple:
    prefixes = Prefixes(text)
    return doc, text, prefixes, prefixes.fingerprint()


def _end(own: tuple, part: int, first: bool) -> tuple:
    """A row that holds the first or the last text of a part in place of a comparison."""
    return (own[0], *[None] * 9, part, first, own[1])


def _row(own: tuple, following: tuple) -> tuple:
    new = _described(None, edited(own[1], following[1]))
    return (
        own[0],
        len(own[1]),
        len(new[1]),
        hashlib.sha256(new[1].encode()).digest(),
        _packed(own[3]),
        _packed(new[3]),
        likeness(own[3], new[3]),
        likeness(own[3], following[3]),
        own[2].extension(0, new[2], 0),
        own[2].extension(0, following[2], 0),
    )


_long, _bytes, _real = pa.int64(), pa.binary(), pa.float64()
_KINDS = [_long, _long, _bytes, _bytes, _bytes, _real, _real, _long, _long]
#: The further columns of a part's first and last text.
ENDS = {"part": pa.int32(), "first": pa.bool_(), "text": pa.string()}


def _batch(rows: list[tuple], id_type: pa.DataType, more: dict[str, pa.DataType] = {}) -> pa.RecordBatch:
    names = ["doc_id", *(c.split()[0] for c in COMPARED.split(", ")), *more]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), [id_type, *_KINDS, *more.values()], strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=names)
