"""Token-id files: interleaved range asymmetric numeral blocks under static tables.

A frame holds the ids of some whole documents. One frequency table serves all its blocks. A
block codes its ids on parallel lanes (id i on lane i mod lanes), each with a 64-bit state that
takes and gives 32-bit words. Blocks are independent; each has the lane states at its start and
at checkpoints inside, and a checksum.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from breakwater.llm.bpe import TWO_SPACES, Memory, slices
from breakwater.llm.tables import folder, partitions

LANES = 1024
#: Steps of all lanes in a block, and from one checkpoint to the next.
STEPS, CHECKPOINT = 256, 128
#: Ids after which a frame is closed, at the end of a document.
FRAME = 1 << 21
#: A state stays in [LOW, LOW << 32).
LOW = 1 << 31
MAGIC = b"ranF"
#: Words that the library is given on lines of one text, and how many words such a text has.
PLAIN, LINES = re.compile(r" [\w!-~]+"), 512
#: Pieces remembered with their ids in each worker; the same number of older ones stays at hand.
REMEMBERED = 600_000


def table(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct ids, their frequencies, and the number of bits of the frequencies' sum."""
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts)
    seen = counts[symbols]
    bits = int(min(20, max(8, np.ceil(np.log2(len(symbols) * 16)))))
    total = 1 << bits
    freqs = np.maximum(1, seen * total // seen.sum())
    # What rounding has left over or taken too much goes to the largest.
    rest = total - int(freqs.sum())
    for k in np.argsort(-freqs, kind="stable"):
        step = rest if rest > 0 else max(rest, 1 - int(freqs[k]))
        freqs[k] += step
        rest -= step
        if not rest:
            break
    return symbols.astype(np.uint32), freqs.astype(np.uint32), bits


def _block(at: np.ndarray, freq: np.ndarray, low: np.ndarray, bits: int, lanes: int) -> bytes:
    """Codes places in the table; the words come out in the order in which they are read."""
    n = len(at)
    steps = -(-n // lanes)
    x = np.full(lanes, LOW, np.uint64)
    words, points, length = [], {}, 0
    most = np.uint64(LOW >> bits << 32)
    for k in range(steps - 1, -1, -1):
        s = at[k * lanes : (k + 1) * lanes]
        f, y = freq[s], x[: len(s)]
        full = y >= most * f
        w = (y[full] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        y = np.where(full, y >> np.uint64(32), y)
        x[: len(s)] = ((y // f) << np.uint64(bits)) + y % f + low[s]
        words.append(w)
        length += len(w)
        if k % CHECKPOINT == 0:
            points[k] = (x.copy(), length)
    data = np.concatenate(words[::-1]) if words else np.zeros(0, np.uint32)
    marks = b"".join(
        struct.pack("<I", length - at_end) + x.tobytes() for x, at_end in (points[k] for k in sorted(points))
    )
    body = struct.pack("<III", n, lanes, len(points)) + marks + data.tobytes()
    return struct.pack("<II", len(body), zlib.crc32(body)) + body


def encode(ids: np.ndarray) -> bytes:
    """A frame of ids."""
    if not len(ids):
        return MAGIC + struct.pack("<BII", 0, 0, 0)
    symbols, freqs, bits = table(ids)
    freq = freqs.astype(np.uint64)
    low = np.cumsum(freq) - freq
    packed = zlib.compress(symbols.tobytes() + freqs.tobytes(), 1)
    places = np.zeros(int(symbols[-1]) + 1, np.int64)
    places[symbols] = np.arange(len(symbols))
    at = places[ids]
    lanes = max(1, min(LANES, len(ids) // 64))
    size = lanes * STEPS
    blocks = [_block(at[i : i + size], freq, low, bits, lanes) for i in range(0, len(at), size)]
    return MAGIC + struct.pack("<BII", bits, len(symbols), len(packed)) + packed + b"".join(blocks)


class Frame:
    """Reads a frame whole, by block, or from the checkpoint before a place in a block."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a frame of token ids")
        self.bits, n, size = struct.unpack_from("<BII", data, 4)
        raw = zlib.decompress(data[13 : 13 + size]) if size else b""
        self.symbols = np.frombuffer(raw, np.uint32, n)
        self.freq = np.frombuffer(raw, np.uint32, n, 4 * n).astype(np.uint64)
        self.low = np.cumsum(self.freq) - self.freq
        self.at = np.repeat(np.arange(n, dtype=np.int32), self.freq.astype(np.int64))
        self.blocks, k = [], 13 + size
        while k < len(data):
            length, crc = struct.unpack_from("<II", data, k)
            body = data[k + 8 : k + 8 + length]
            if len(body) != length or zlib.crc32(body) != crc:
                raise ValueError(f"block {len(self.blocks)} is damaged")
            self.blocks.append(body)
            k += 8 + length

    def read(self, block: int, start: int = 0, end: int | None = None) -> np.ndarray:
        """Ids start to end of a block, decoded from the last checkpoint before them."""
        body = self.blocks[block]
        n, lanes, points = struct.unpack_from("<III", body)
        end = n if end is None else min(end, n)
        mark = 4 + 8 * lanes
        first = start // lanes // CHECKPOINT
        skip = struct.unpack_from("<I", body, 12 + first * mark)[0]
        x = np.frombuffer(body, np.uint64, lanes, 16 + first * mark).copy()
        words = np.frombuffer(body, np.uint32, -1, 12 + points * mark)
        mask, out, k = np.uint64((1 << self.bits) - 1), [], first * CHECKPOINT
        begin = k * lanes
        while k * lanes < end:
            y = x[: n - k * lanes]
            slot = y & mask
            s = self.at[slot.astype(np.int64)]
            y = self.freq[s] * (y >> np.uint64(self.bits)) + slot - self.low[s]
            need = np.flatnonzero(y < LOW)
            y[need] = (y[need] << np.uint64(32)) | words[skip : skip + len(need)]
            skip += len(need)
            x[: len(y)] = y
            out.append(s)
            k += 1
        got = np.concatenate(out) if out else np.zeros(0, np.int32)
        return self.symbols[got[start - begin : end - begin]]

    def ids(self) -> np.ndarray:
        parts = [self.read(k) for k in range(len(self.blocks))]
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def write(
    docs: DataFrame, tokenizer: str, end_id: int, path: str, doc_id: str = "doc_id", text: str = "text"
) -> None:
    """Encodes whole texts and writes their ids in ascending doc_id order to ``path``.

    One range shuffle puts the texts in order (null ids first, ties by text); each task then
    encodes its range and writes frames of whole documents, as rows of Parquet files: part,
    frame, first (ids of the part before it), n_tokens, doc_ids, lengths, data. Null texts
    count as empty and have the end id only; repeated rows are written each, an empty table
    gives an empty file, other columns are left out. A task holds one frame and a batch.
    """
    with open(tokenizer) as file:
        sent = docs.sparkSession.sparkContext.broadcast(Library(file.read()))
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    placed = rows.repartitionByRange(
        partitions(docs.sparkSession), "doc_id", F.substring("text", 1, 64)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = sent.value
        part, frame, first, schema = TaskContext.get().partitionId(), 0, 0, None
        held, docs_held, n = [], [], 0

        def closed() -> pa.RecordBatch:
            data = encode(np.concatenate(held))
            lengths = [[len(i) for i in held]]
            values = [[part], [frame], [first], [n], [docs_held], lengths, [data]]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(values, schema, strict=True)],
                names=["part", "frame", "first", "n_tokens", "doc_ids", "lengths", "data"],
            )

        for batch in batches:
            ids_kind = batch.column("doc_id").type
            schema = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(ids_kind), pa.list_(pa.int64()), pa.binary()]
            for at in slices(batch.column("text")):
                own = batch.slice(*at)
                coded = library.encode(own.column("text"))
                for doc, ids in zip(own.column("doc_id").to_pylist(), coded, strict=True):
                    held.append(np.append(ids, np.uint32(end_id)))
                    docs_held.append(doc)
                    n += len(held[-1])
                    if n >= FRAME:
                        yield closed()
                        frame, first = frame + 1, first + n
                        held, docs_held, n = [], [], 0
        if held:
            yield closed()

    out = placed.sortWithinPartitions("doc_id", "text").mapInArrow(
        run,
        f"part int, frame int, first long, n_tokens long, doc_ids array<{kind}>, lengths array<long>, data binary",
    )
    out.write.option("compression", "none").parquet(path)


class Library:
    """The tokenizers library behind a memory of pieces, which a worker keeps for all its tasks.

    A text with the string of an added token is encoded whole, by the library as it comes; in the
    pieces of all others there are none. The library runs on the task's own core.
    """

    def __init__(self, spec: str):
        self.spec = spec
        self._fresh()

    def __getstate__(self):
        return {"spec": self.spec}

    def __setstate__(self, state):
        self.spec = state["spec"]
        self._fresh()

    def _fresh(self) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_str(self.spec)
        self.added = [t.content for t in self.own.get_added_tokens_decoder().values()]
        self.memory = Memory(self._learn, REMEMBERED)
        ids = self._ids(["\n"])[0]
        self.line_end = int(ids[0]) if len(ids) == 1 else None

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text."""
        whole, spaced, plain = [], [], []
        strings = texts.to_pylist()
        for k, text in enumerate(strings):
            marked = any(mark in text for mark in self.added)
            (whole if marked else spaced if TWO_SPACES.search(text) else plain).append(k)
        found = dict(zip(whole, self._ids([strings[k] for k in whole]), strict=True))
        coded = self.memory.encode([strings[k] for k in spaced])
        found.update((k, np.frombuffer(ids, "<u4")) for k, ids in zip(spaced, coded, strict=True))
        found.update(zip(plain, self._plain(texts.take(pa.array(plain, pa.int64()))), strict=True))
        return [found[k] for k in range(len(strings))]

    def _plain(self, texts: pa.Array) -> list[np.ndarray]:
        """The same for texts without white space beside other white space, whose pieces are the words
        between blanks, each but a text's first with the blank before it. Each distinct piece is
        looked up once; its ids are copied to all its places."""
        if not len(texts):
            return []
        lists = pc.split_pattern(texts, " ")
        words = lists.flatten().dictionary_encode()
        edges, index = lists.offsets.to_numpy(), words.indices.to_numpy().astype(np.int64)
        names, n = words.dictionary.to_pylist(), len(words.dictionary)
        opening, at = np.unique(index[edges[:-1]], return_inverse=True)
        index[edges[:-1]] = n + at
        pieces = [" " + w for w in names] + [names[k] for k in opening.tolist()]
        known = self.memory.known(set(pieces))
        coded = [known[p] for p in pieces]
        sizes = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        starts, takes = np.cumsum(sizes) - sizes, sizes[index]
        ends = np.cumsum(takes)
        places = np.repeat(starts[index] - ends + takes, takes) + np.arange(ends[-1])
        ids = np.frombuffer(b"".join(coded), "<u4")[places]
        cuts = np.r_[0, ends][edges].tolist()
        return [ids[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(c.ids, "<u4") for c in self.own.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[str]) -> list[bytes]:
        """Words without white space inside are encoded many at a time, one to a line, and told
        apart by the id of the line's end; the others, and lines that don't come apart, by themselves."""
        known: dict[str, bytes] = {}
        if self.line_end is not None:
            plain = [p for p in new if PLAIN.fullmatch(p)]
            lines = [plain[i : i + LINES] for i in range(0, len(plain), LINES)]
            for words, ids in zip(lines, self._ids(["\n".join(of) for of in lines]), strict=True):
                ends = (4 * np.flatnonzero(ids == self.line_end)).tolist()
                if len(ends) == len(words) - 1:
                    coded = ids.tobytes()
                    cuts = zip([0, *(e + 4 for e in ends)], [*ends, len(coded)], strict=True)
                    known.update(zip(words, [coded[a:b] for a, b in cuts], strict=True))
        rest = [p for p in new if p not in known]
        known.update(zip(rest, [ids.tobytes() for ids in self._ids(rest)], strict=True))
        return [known[p] for p in new]


def read(spark: SparkSession, path: str) -> DataFrame:
    """Reads written files back: doc_id, start (ids of all documents before), ids (binary,
    little-endian unsigned 32-bit integers, with the end id)."""
    frames = spark.read.parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One number for each file's part.
    bases = (
        frames.groupBy("part")
        .agg(F.sum("n_tokens").alias("_n"))
        .select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    )
    rows = frames.join(F.broadcast(bases), "part").select(
        (F.col("_base") + F.col("first")).alias("start"), "doc_ids", "lengths", "data"
    )
    kind = rows.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                lengths = np.array(row.column("lengths")[0].as_py(), np.int64)
                ends = np.cumsum(lengths)
                ids = Frame(row.column("data")[0].as_py()).ids().astype("<u4")
                parts = [ids[e - n : e].tobytes() for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        row.column("doc_ids")[0].values,
                        pa.array(row.column("start")[0].as_py() + ends - lengths, pa.int64()),
                        pa.array(parts, pa.binary()),
                    ],
                    names=["doc_id", "start", "ids"],
                )

    return rows.mapInArrow(run, f"doc_id {kind}, start long, ids binary")


def fresh_path(spark: SparkSession) -> str:
    return f"{folder(spark)}/token-ids-{uuid.uuid4().hex}"
