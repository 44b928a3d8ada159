"""Exact duplicates against a plain version."""

import hashlib
from collections import Counter, defaultdict

import pytest

from breakwater.llm import exact, tables

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, length int, digest string, row long, kept string, marked int"


def rows():
    long = "Long text " * 60_000
    texts = [None, "", None, "A", "a", "Ä", "ä", "İ", "same", "SAME", "Same", "sam", "bame", long, long.upper(), long[:-1] + "x"]
    texts += [" ", "  ", "x" * 300 + "y", "x" * 300 + "z", "x" * 300 + "Y"]  # equal openings
    out = [(k, t) for k, t in enumerate(texts)]
    out += [(8, "same"), (8, "same"), (None, "same"), (None, "lone"), (None, "lone"), (99, None), (99, None)]
    out += [(1000 + k, "Hot") for k in range(300)] + [(2000 + k, f"{k:03}") for k in range(200)]  # one hot group, one hot length
    return [(i, t, 1, "d", 2, "k", 3) for i, t in out]


def plain(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[(t or "").translate(UPPER)].append(i)
    kept, out = Counter(), []
    for t, ids in groups.items():
        top = max(ids, key=lambda i: (i is not None, i))
        kept[(top, t)] += 1
        out += [(i, top, len(ids), hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(map(str, out)), Counter({(i, hashlib.sha256(t.encode()).hexdigest()): n for (i, t), n in kept.items()})


@pytest.mark.parametrize("share, opening, bits", [(tables.HOT_SHARE, exact.OPENING, tables.LEAST_BITS), (1, 2, 1 << 15), (10**9, 0, 1 << 16)])
def test_copies_of_odd_texts(spark, monkeypatch, share, opening, bits):
    monkeypatch.setattr(tables, "HOT_SHARE", share)
    monkeypatch.setattr(exact, "OPENING", opening)
    monkeypatch.setattr(tables, "LEAST_BITS", bits)
    docs = spark.createDataFrame(rows(), SCHEMA)
    digest = exact.F.sha2(exact.normalised("text"), 256).alias("sha")
    got = exact.deduplicate(docs, carry=[digest]).collect()
    want, kept = plain(rows())
    assert sorted(str((r.doc_id, r.keep_id, r.group_size, r.sha)) for r in got) == want
    assert Counter((r.doc_id, r.sha) for r in got if r.kept) == kept
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_nothing_and_one(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    assert exact.deduplicate(docs.limit(0)).count() == 0
    assert [tuple(r) for r in exact.deduplicate(docs.where("doc_id = 11")).collect()] == [(11, 11, 1, True)]


def test_a_full_filter_costs_nothing_but_hashes(spark, monkeypatch):
    """Bits that are all taken let every row through; the groups stay right."""
    monkeypatch.setattr(tables, "LEAST_BITS", 1)
    monkeypatch.setattr(tables, "MOST_BITS", 1)
    got = exact.deduplicate(spark.createDataFrame(rows(), SCHEMA)).collect()
    assert sorted(str((r.doc_id, r.keep_id, r.group_size)) for r in got) == sorted(
        str(tuple(__import__("ast").literal_eval(s)[:3])) for s in plain(rows())[0]
    )


def test_texts_are_not_shuffled(spark, medium_dir):
    """Only fixed-size columns reach an exchange."""
    docs = spark.read.parquet(f"{medium_dir}/documents.parquet")
    plan = exact.deduplicate(docs)._jdf.queryExecution().toString()
    assert "documents.parquet" not in plan  # what is joined was written: ids, lengths, hashes
    assert exact.deduplicate(docs).columns == ["doc_id", "keep_id", "group_size", "kept"]
