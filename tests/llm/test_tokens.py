"""Byte-level BPE and token files against the libraries themselves."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from breakwater.llm import bpe, queries, tokenfiles

PATH = P.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = "doc_id long, text string, ids string, lang string"
ROWS = [
    (3, "A cat's  two\n\n cats, 12345 times \t", "x", None),
    (1, None, None, "en"),
    (2, "", "y", "en"),
    (None, "no id", "y", "en"),
    (2, "same id", "z", "en"),
    (2, "same id", "z", "en"),
    (9, "ça va 中文字 🙂 " * 9000, "z", "fr"),
    (8, "x" * 3000 + " <|endoftext|> ", "z", "fr"),
]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec.load(PATH, P.PATTERN)


def test_perfect_hash_is_minimal_and_complete(codec):
    table = codec.table
    assert len(table.keys) == len(codec.ranks) == len(set(table.keys))
    assert table.find(list(codec.ranks)) == list(codec.ranks.values())
    assert table.find([b"", b"not a token at all", b"\xff\xfe\xfd"]) == [-1, -1, -1]
    assert bpe.PerfectHash([], []).find([b"a"]) == [-1]


def test_random_texts_as_the_library(codec, library):
    some, letters = random.Random(1), "ab  \n\t'sSte12.é中 　\x1c\x85!🙂"
    for _ in range(2000):
        text = "".join(some.choice(letters) for _ in range(some.randint(0, 30)))
        ids = codec.encode([text])[0]
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_query_over_documents(spark, medium_dir, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{medium_dir}/documents.parquet").collect()}
    rows = queries.op3_bpe(spark, medium_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(np.array(ids, "<u4").tobytes()))
        assert r.decoded_sha256 == sha(texts[r.doc_id].encode())


def test_odd_rows_are_encoded(spark, library):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    got = sorted(map(str, bpe.digests(docs, PATH, P.PATTERN).collect()))
    want = []
    for doc, text, *_ in ROWS:
        ids = library.encode_ordinary(text or "")
        want.append((doc, len(ids), sha(np.array(ids, "<u4").tobytes()), sha((text or "").encode())))
    kept = bpe.digests(docs, PATH, P.PATTERN)
    assert got == sorted(map(str, spark.createDataFrame(want, kept.schema).collect()))
    assert bpe.digests(docs.limit(0), PATH, P.PATTERN).count() == 0


@pytest.mark.parametrize("n, kinds", [(0, 1), (1, 1), (63, 5), (1000, 1), (5000, 50000), (300_000, 50000)])
def test_frames_give_back_their_ids(n, kinds):
    some = np.random.default_rng(n)
    ids = np.minimum(some.zipf(1.3, n), kinds).astype(np.uint32)
    data = tokenfiles.encode(ids)
    frame = tokenfiles.Frame(data)
    assert np.array_equal(frame.ids(), ids)
    if n > 200_000:
        assert len(data) < 2 * n
        size = tokenfiles.LANES * tokenfiles.STEPS
        for a, b in ((0, 10), (70_000, 70_005), (size - 3, size), (131_000, 131_072)):
            assert np.array_equal(frame.read(1, a, b), ids[size + a : size + b])
        spoilt = bytearray(data)
        spoilt[-5] ^= 1
        with pytest.raises(ValueError, match="damaged"):
            tokenfiles.Frame(bytes(spoilt))


def expected(pairs):
    own = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    start, out = 0, []
    for doc, text in pairs:
        ids = np.array([*own.encode(text, add_special_tokens=False).ids, queries.END_ID], "<u4")
        out.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_files_over_documents(spark, medium_dir):
    docs = spark.read.parquet(f"{medium_dir}/documents.parquet")
    pairs = sorted((r.doc_id, r.text or "") for r in docs.collect())
    got = queries.op10_token_files(spark, medium_dir).collect()
    assert sorted(map(tuple, got)) == expected(pairs)


def test_files_of_odd_rows(spark):
    marked = ["hello <|endoftext|> there", "<|endoftext|>", " <|endoftext|><|endoftext|>x", "<|endoftext", "a\n<|endoftext|>\n b"]
    rows = [*ROWS, *((100 + k, t, *ROWS[0][2:]) for k, t in enumerate(marked))]
    docs = spark.createDataFrame(rows, SCHEMA)

    def stored(rows):
        path = tokenfiles.fresh_path(spark)
        tokenfiles.write(rows, P.path("byte_bpe_50k.json"), 2, path)
        return [tuple(r) for r in tokenfiles.read(spark, path).orderBy("start").collect()]

    got = [(d, s, len(i) // 4, zlib.crc32(i)) for d, s, i in stored(docs)]
    pairs = [(d, t or "") for d, t, *_ in rows]
    assert got == expected(sorted(pairs, key=lambda p: (p[0] is not None, p[0] or 0, p[1].encode())))
    assert stored(docs.where(F.lit(False))) == []


def test_texts_of_a_batch_as_the_library(monkeypatch):
    own = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    library = tokenfiles.Library(own.to_str())
    some, words = random.Random(4), ["", "", "a", "cat", "Cat's", "12345", "é中", "🙂", "\x1c", "\x85", "x\n", "\ty", "<|endoftext|>"]
    texts = [" ".join(some.choices(words, k=some.randint(1, 9))) for _ in range(1500)]
    texts += ["plain words only", " plain words only", "plain words only ", "", " ", "plain", *ROWS[6][1].split("é")]
    asked = []
    memory = library.memory.known
    monkeypatch.setattr(library.memory, "known", lambda wanted: asked.append(len(wanted)) or memory(wanted))
    for batch in (texts, texts[1490:], ["plain words " * 5000 + "end"], []):
        ids = library.encode(pa.array(batch, pa.string()).slice(0))
        assert [i.tolist() for i in ids] == [own.encode(t, add_special_tokens=False).ids for t in batch]
    assert asked[-2] <= 4 or asked[-1] <= 4  # each distinct piece is asked for once
