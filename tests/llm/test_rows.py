"""Sharding, mixing, chat formatting and fingerprints: laws on whole tables, odd rows."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from compare import connect, differences

from breakwater.llm import chat, prints, queries, sharding, tables

SCHEMA = "doc_id long, text string, source string, size long, shard int, bucket int"
ROWS = [
    (1, None, None, 1, 1, 1),
    (1, "", "", 1, 1, 1),
    (None, "no id", "a", 1, 1, 1),
    (2, "same", "a", 1, 1, 1),
    (2, "same", "a", 1, 1, 1),
    (5, "ä" * 40_000, "a", 1, 1, 1),
    (6, "x", "b", 1, 1, 1),
]


@pytest.mark.parametrize("name", sorted(queries.statements()))
def test_query_equals_sql(name, spark, medium_dir):
    sql = queries.statements()[name]
    assert differences(queries.queries()[name](spark, medium_dir), connect(medium_dir), sql) is None


def laws(rows, shards):
    """Slots without gaps, counts at most one apart, each source spread evenly."""
    slots, sources = defaultdict(list), defaultdict(Counter)
    for r in rows:
        slots[r.shard].append(r.slot)
        sources[r.source][r.shard] += 1
    assert set(slots) <= set(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots[k]) for k in range(shards)]
    assert max(counts) - min(counts) <= 1
    for own in sources.values():
        each = sum(own.values()) / shards
        assert all(abs(own[k] - each) <= 2 for k in range(shards))


def test_shards_hold_the_mixture(spark, medium_dir):
    rows = queries.op1_sharding(spark, medium_dir).collect()
    laws(rows, sharding.SHARDS)
    docs = {r.doc_id: r.text.encode() for r in spark.read.parquet(f"{medium_dir}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    assert all((r.size, r.text_crc32) == (len(docs[r.doc_id]) + 16, zlib.crc32(docs[r.doc_id])) for r in rows)
    assert sorted(rows) == sorted(queries.op1_sharding(spark, medium_dir).collect())


def test_odd_rows_are_sharded(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    rows = sharding.interleave(docs, 3).collect()
    laws(rows, 3)
    assert Counter((r.doc_id, r.source) for r in rows) == Counter((r[0], r[2]) for r in ROWS)
    assert sharding.interleave(docs.limit(0)).count() == 0
    assert sharding.interleave(docs).count() == len(ROWS)


@pytest.mark.parametrize("share", [0, 3, 1000], ids=["none hot", "one hot", "all hot"])
def test_snapshots_collapse(spark, monkeypatch, share):
    monkeypatch.setattr(chat, "HOT_SHARE", share)
    monkeypatch.setattr(tables, "HOT_SHARE", share)
    said = [("user", "hi"), ("bot", None), (None, ""), ("user", "more")]
    logs = {1: said[:2], 2: said, 3: said, 4: said[:3], 5: [("user", "other")], None: said[:1], 6: [("bot", "")]}
    rows = [(c, k * 10, r, t, c, 0) for c, turns in logs.items() for k, (r, t) in enumerate(turns)]
    rows += [(7, None, "a", "tie", 7, 0), (7, None, "a", "tie", 7, 0)]
    rows += [(8, k, "u", f"turn {k}", 8, 0) for k in range(600)] + [(9, k, "u", f"turn {k}", 9, 0) for k in range(299)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, place long, part int")
    got = defaultdict(str)
    for r in sorted(chat.render(turns).collect()):
        assert r.n_chars == len(r.text)
        got[r.conv_id] += r.text

    def plain(said):
        return "".join(f"<|im_start|>{r or 'unknown'}\n{t or ''}<|im_end|>\n" for r, t in said)

    want = {2: said, 5: logs[5], 6: logs[6], 7: [("a", "tie")] * 2, 8: [("u", f"turn {k}") for k in range(600)]}
    assert got == {c: plain(s) for c, s in want.items()}
    kept = defaultdict(list)
    for r in sorted(chat.maximal(turns).collect(), key=lambda r: (r.conv_id, r.place)):
        assert r.turns == len(want[r.conv_id])
        kept[r.conv_id].append((r.role, r.text))
    assert kept == want
    assert chat.render(turns.limit(0)).count() == 0


def test_spans_and_extensions():
    a, b = prints.Prefixes("the cat sat on a mat 🙂"), prints.Prefixes("a cat sat on the mat")
    assert a.same(3, b, 1, 8) and not a.same(3, b, 1, 13)
    assert a.extension(3, b, 1) == len(" cat sat on ")
    assert a.extension(0, a, 0) == a.n
    assert prints.Prefixes("").fingerprint().startswith("0-")
    assert prints.likeness("0-0-", "1-5-0000000a") == 0.0


def edits(rows):
    own = sorted(rows, key=lambda r: r[0])
    out = {}
    for k, (doc, text) in enumerate(own):
        following, half = own[(k + 1) % len(own)][1], len(text) // 2
        new = text[: len(text) - half] + following[:half]
        out[doc] = (len(text), hashlib.sha256(new.encode()).hexdigest())
    return out


def test_fingerprints_over_documents(spark, medium_dir):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{medium_dir}/documents.parquet").collect()}
    rows = queries.op9_fingerprints(spark, medium_dir).collect()
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in rows} == edits(docs.items())
    by_text = defaultdict(set)
    for r in rows:
        by_text[docs[r.doc_id]].add(r.fingerprint)
    assert all(len(f) == 1 for f in by_text.values())
    assert len({f for fs in by_text.values() for f in fs}) == len(by_text)
    long = [r for r in rows if r.n_chars > 400]
    assert sum(r.near_edited > r.near_next for r in long) >= 0.99 * len(long)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    for r in rows:
        assert r.common_edited >= r.n_chars - r.n_chars // 2


def plain_print(text):
    """The fingerprint from each span's own polynomial, in Python's integers."""
    codes = [ord(c) + 1 for c in text]
    powers = [[pow(base, k, p) for k in range(max(prints.SPAN, len(codes)))] for p, base in prints.MODULI]

    def value(span):
        high, low = (sum(map(int.__mul__, span, own)) % p for own, (p, _) in zip(powers, prints.MODULI))
        return high << 31 | low

    size, found = min(prints.SPAN, len(codes)), set()
    for k in range(len(codes) - size + 1) if codes else ():
        x = value(codes[k : k + size])
        x = (x ^ x >> 31) * 0x9E3779B97F4A7C15 % 2**64
        found.add((x ^ x >> 29) * 0xD6E8FEB86659FD93 % 2**64 >> 32)
    return f"{len(codes):x}-{value(codes):016x}-" + "".join(f"{v:08x}" for v in sorted(found)[: prints.KEPT])


def spans_of(text):
    """All spans of a text: what the likeness of two fingerprints estimates."""
    return {text[k : k + prints.SPAN] for k in range(max(1, len(text) - prints.SPAN + 1))} if text else set()


def test_fingerprints_equal_plain_ones(spark, small_dir):
    table = spark.read.parquet(f"{small_dir}/documents.parquet")
    texts = sorted((r.doc_id, r.text or "") for r in table.collect())
    got = {r.doc_id: r for r in queries.op9_fingerprints(spark, small_dir).collect()}
    off = []
    for k, (doc, text) in enumerate(texts):
        following = texts[(k + 1) % len(texts)][1]
        new = prints.edited(text, following)
        if len(text) < 800:
            assert (got[doc].fingerprint, got[doc].edited_fingerprint) == (plain_print(text), plain_print(new))
        assert got[doc].common_next == next((i for i, (a, b) in enumerate(zip(text, following)) if a != b), min(len(text), len(following)))
        for other, near in ((new, got[doc].near_edited), (following, got[doc].near_next)):
            both = spans_of(text) | spans_of(other)
            off.append(abs(near - (len(spans_of(text) & spans_of(other)) / len(both) if both else 1.0)))
    assert max(off) < 0.35 and sum(off) / len(off) < 0.05


@pytest.mark.parametrize("n", [1, 2, 50, 400])
def test_next_documents_over_parts(spark, n):
    """A third of all rows are one row, ids tie, parts may be empty."""
    rows = sorted((k // 3 if k % 3 else 0, f"text {k // 3}" if k % 3 else "same") for k in range(n))
    got = prints.compare_edits(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    groups = defaultdict(set)
    for doc, text in rows:
        groups[doc].add(text)
    single = [k for k, (doc, _) in enumerate(rows) if len(groups[doc]) == 1 and len(groups[rows[(k + 1) % n][0]]) == 1]
    want = Counter()
    for k in single:
        want[rows[k][0], hashlib.sha256(prints.edited(rows[k][1], rows[(k + 1) % n][1]).encode()).hexdigest()] += 1
    have = Counter((r.doc_id, r.edited_sha256) for r in got)
    assert not want - have


def test_odd_rows_are_fingerprinted(spark):
    docs = spark.createDataFrame([r for r in ROWS if r[0] != 1], SCHEMA)
    rows = prints.compare_edits(docs).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in ROWS if r[0] != 1)
    twin = [r for r in rows if r.doc_id == 2]
    assert max(r.near_next for r in twin) == 1.0
    assert prints.compare_edits(docs.limit(0)).count() == 0
    single = prints.compare_edits(docs.where("doc_id = 6")).collect()[0]
    assert (single.near_next, single.n_chars) == (1.0, 1)
    nothing = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert [r.near_next for r in prints.compare_edits(nothing).collect()] == [1.0, 1.0]
