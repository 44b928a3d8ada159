"""Byte-level BPE encoding and decoding with a two-tier lookup.

The first tier is a minimal perfect hash over the vocabulary that gives the id of a pre-token
that is a token itself. Only the others go to the second tier, which merges bytes in a linked
list by a heap of ranked pairs.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys in a bucket of the perfect hash, on average.
LOAD = 4
#: Displacements tried at once for a bucket.
TRIES = 512
#: Pieces remembered with their ids in each worker; the same number of older ones stays at hand.
REMEMBERED = 200_000
#: Bytes of text that are cut into pieces at a time.
PART = 1 << 20
TWO_SPACES = re.compile(r"\s\s")


class PerfectHash:
    """A minimal perfect hash of byte strings by hash, displace and check.

    Buckets are placed from the fullest to the emptiest: a bucket takes the first displacement
    that moves its keys to free slots; buckets of one key take the slots left over, which are
    named directly (as negative displacements). There are as many slots as keys.
    """

    def __init__(self, keys: list[bytes], values: list[int]):
        n = len(keys)
        self.buckets = max(1, n // LOAD)
        h = _hashes(keys)
        bucket = self._bucket(h)
        self.moves = np.zeros(self.buckets, np.int64)
        order = np.argsort(bucket, kind="stable")
        starts = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        sizes = np.diff(starts)
        free, tries = np.ones(n, bool), np.arange(TRIES, dtype=np.uint64)[:, None]
        slots = np.zeros(n, np.int64)
        for b in np.argsort(-sizes, kind="stable"):
            of = order[starts[b] : starts[b + 1]]
            if len(of) < 2:
                break
            base = np.uint64(0)
            while True:
                to = _moved(h[of], tries + base, n)
                ranked = np.sort(to, axis=1)
                good = free[to].all(axis=1) & (ranked[:, 1:] != ranked[:, :-1]).all(axis=1)
                if good.any():
                    k = int(good.argmax())
                    break
                base += np.uint64(TRIES)
            self.moves[b] = k + int(base)
            slots[of] = to[k]
            free[to[k]] = False
        left = np.flatnonzero(free)
        for b, slot in zip(np.flatnonzero(sizes == 1), left, strict=True):
            self.moves[b] = -slot - 1
            slots[order[starts[b]]] = slot
        self.keys: list[bytes] = [b""] * n
        self.values = np.zeros(n, np.int64)
        for slot, key, value in zip(slots.tolist(), keys, values, strict=True):
            self.keys[slot], self.values[slot] = key, value

    def _bucket(self, h: np.ndarray) -> np.ndarray:
        return ((h >> np.uint64(32)) % np.uint64(self.buckets)).astype(np.int64)

    def find(self, keys: list[bytes]) -> list[int]:
        """The value of each key, -1 for those that are not there."""
        n = len(self.keys)
        if not keys or not n:
            return [-1] * len(keys)
        h = _hashes(keys)
        move = self.moves[self._bucket(h)]
        slot = np.where(move < 0, -move - 1, _moved(h, np.maximum(move, 0).astype(np.uint64), n))
        own = self.keys
        return [
            v if own[s] == k else -1
            for k, s, v in zip(keys, slot.tolist(), self.values[slot].tolist(), strict=True)
        ]


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))


def _moved(h: np.ndarray, move: np.ndarray, n: int) -> np.ndarray:
    """The slots of hashes under displacements: both are mixed into a new hash."""
    x = h + move * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return ((x ^ (x >> np.uint64(32))) % np.uint64(n)).astype(np.int64)


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one pre-token: the pair of lowest rank, leftmost first, is joined again and again.

    A part is known by where it starts; ``end`` links it to the next one, ``back`` to the one
    before. A heap entry holds rank, start and length of a pair and is passed over if one of
    its parts has been joined meanwhile.
    """
    n, get = len(piece), ranks.get
    end, back = list(range(1, n + 1)), list(range(-1, n))
    heap = []
    for i in range(n - 1):
        if (r := get(piece[i : i + 2])) is not None:
            heap.append(r << 64 | i << 32 | 2)
    heapq.heapify(heap)
    while heap:
        entry = heapq.heappop(heap)
        i, length = entry >> 32 & 0xFFFFFFFF, entry & 0xFFFFFFFF
        j = end[i]
        if j < 0 or j >= n or end[j] - i != length:
            continue
        k = end[i] = end[j]
        end[j] = -1
        if k < n:
            back[k] = i
            if (r := get(piece[i : end[k]])) is not None:
                heapq.heappush(heap, r << 64 | i << 32 | end[k] - i)
        if (h := back[i]) >= 0 and (r := get(piece[h:k])) is not None:
            heapq.heappush(heap, r << 64 | h << 32 | k - h)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class Memory:
    """Ids of whole texts by pieces; pieces met lately are remembered, others go to ``learn``.

    ``learn`` gives the ids of each piece as little-endian unsigned 32-bit integers. Two
    generations of pieces are kept, so that memory is bounded and frequent pieces stay.
    """

    def __init__(self, learn, remembered: int = REMEMBERED):
        self.learn, self.remembered = learn, remembered
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [pieces(t) for t in texts]
        young = self.known(set().union(*cut))
        return [b"".join([young[p] for p in of]) for of in cut]

    def known(self, wanted: set[str]) -> dict[str, bytes]:
        """The pieces that are remembered, those wanted among them."""
        if len(self.young) > self.remembered:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        needed = wanted.difference(young)
        if old:
            kept = needed.intersection(old)
            young.update((p, old[p]) for p in kept)
            needed -= kept
        if needed:
            new = list(needed)
            young.update(zip(new, self.learn(new), strict=True))
        return young


class Codec:
    """A vocabulary of ranks with its pattern: whole texts to ids and back."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern, self.ranks = pattern, ranks
        self.table = PerfectHash(list(ranks), list(ranks.values()))
        self._fresh()

    def __getstate__(self):
        return {"pattern": self.pattern, "ranks": self.ranks, "table": self.table}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._fresh()

    def _fresh(self) -> None:
        self.split = regex.compile(self.pattern)
        self.memory = Memory(self._learn)
        self.tokens = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token

    @classmethod
    def load(cls, path: str, pattern: str) -> Codec:
        """From a file that has a token in base64 and its rank on each line."""
        lines = (line.split() for line in Path(path).read_bytes().splitlines() if line)
        return cls({base64.b64decode(token): int(rank) for token, rank in lines}, pattern)

    def _learn(self, new: list[str]) -> list[bytes]:
        tokens = [[t.encode() for t in self.split.findall(p)] for p in new]
        distinct = list({t for of in tokens for t in of})
        found = self.table.find(distinct)
        known = {
            t: v.to_bytes(4, "little") if v >= 0 else _packed(merge(t, self.ranks))
            for t, v in zip(distinct, found, strict=True)
        }
        return [b"".join([known[t] for t in of]) for of in tokens]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        return self.memory.encode(texts)

    def decode(self, ids: bytes) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


def _packed(ids: list[int]) -> bytes:
    return b"".join([i.to_bytes(4, "little") for i in ids])


def pieces(text: str) -> list[str]:
    """Cuts a text before each single blank that stands between two characters that are no white
    space. Every pattern match ends there, so that the pieces can be matched one by one."""
    words = text.split(" ")
    if not TWO_SPACES.search(text):
        return [words[0], *[" " + w for w in words[1:]]]
    out, held = [], words[0]
    for word in words[1:]:
        if word and held and not word[0].isspace() and not held[-1].isspace():
            out.append(held)
            held = " " + word
        else:
            held += " " + word
    out.append(held)
    return out


def encode_documents(
    docs: DataFrame, vocabulary: str, pattern: str, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Encodes every whole text and decodes the ids again.

    Returns doc_id, ids (binary, little-endian unsigned 32-bit integers) and decoded (binary).
    Null texts count as empty and have no ids. Each pattern match is encoded by itself, without
    special tokens. Repeated rows are encoded one by one, an empty table gives no rows, other
    columns are ignored. No row leaves its task; the vocabulary is read once, by the driver.
    """
    codec = docs.sparkSession.sparkContext.broadcast(Codec.load(vocabulary, pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec.value
        for batch in batches:
            for at in slices(batch.column("text"), PART):
                part = batch.slice(*at)
                ids = own.encode(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(ids, pa.binary()),
                        pa.array([own.decode(i) for i in ids], pa.binary()),
                    ],
                    names=["doc_id", "ids", "decoded"],
                )

    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids binary, decoded binary")


def slices(texts: pa.Array, most: int = 1 << 22) -> list[tuple[int, int]]:
    """Offset and length of parts of a batch that hold a few MB of text, or one longer text."""
    sizes = np.array(pc.binary_length(texts).to_pylist(), np.int64)
    part = np.cumsum(sizes) // most
    cuts = np.flatnonzero(np.diff(part)) + 1
    edges = [0, *cuts.tolist(), len(sizes)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False) if b > a]


def digests(
    docs: DataFrame, vocabulary: str, pattern: str, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document: doc_id, n_tokens, and the SHA-256 of the ids and of the decoded bytes."""
    return encode_documents(docs, vocabulary, pattern, doc_id, text).select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
