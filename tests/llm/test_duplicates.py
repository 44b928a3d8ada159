"""Near duplicates and repeated strings against brute force."""

import hashlib
import os
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from breakwater.llm import jaccard, queries, suffixes, vectors
from breakwater.llm.components import components

LENGTH = suffixes.LENGTH


def documents(spark, folder):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]


def without_repeats(texts):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[k : k + LENGTH] for d in data for k in range(len(d) - LENGTH + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, int)
        for k in range(len(d) - LENGTH + 1):
            if seen[d[k : k + LENGTH]] > 1:
                gone[k] += 1
                gone[k + LENGTH] -= 1
        gone = np.cumsum(gone)[: len(d)] > 0
        kept = bytes(np.frombuffer(d, np.uint8)[~gone])
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_array():
    some = random.Random(2)
    for _ in range(1500):
        letters = some.choice([b"a", b"ab", b"abc", bytes(range(60))])
        text = bytes(some.choice(letters) for _ in range(some.randint(0, 60)))
        if some.random() < 0.3:
            text = text[:9] * some.randint(1, 6)
        assert suffixes.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_repeats_over_documents(spark, medium_dir):
    pairs = documents(spark, medium_dir)
    want = {i: row for (i, _), row in zip(pairs, without_repeats([t for _, t in pairs]), strict=True)}
    rows = queries.op5_suffixes(spark, medium_dir).collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows}
    assert len(rows) == len(want)
    assert {i: got[i] for i in want if got[i] != want[i]} == {}
    assert sum(r[1] for r in want.values()) > 0


def odd_texts():
    some = random.Random(5)

    def prose(n):
        return "".join(some.choice("abcdefgh é\n") for _ in range(n))

    passage, other = prose(700), prose(260)
    texts = [None, "", "short", "a" * 1000, "a" * 230, "ab" * 400, prose(90) * 9, passage]
    texts += [prose(150) + passage[:400] + prose(120) for _ in range(9)]
    texts += [prose(150) + passage[200:] + other + prose(10) for _ in range(7)]
    texts += [other, other + "x", prose(30_000) + other[5:] + prose(5000), passage, passage]
    return texts


@pytest.mark.parametrize("hot", [suffixes.HOT, 3])
def test_repeats_of_odd_texts(spark, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "HOT", hot)
    texts = odd_texts()
    rows = [(None if k == 4 else k // 2, t, "x", "y") for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, spans string")
    got = sorted(map(str, map(tuple, suffixes.digests(docs).collect())))
    assert got == sorted(str((i, *w)) for (i, *_), w in zip(rows, without_repeats(texts), strict=True))
    assert suffixes.digests(docs.limit(0)).count() == 0


def test_contexts_that_are_copies_are_sorted(monkeypatch):
    some, seen, plain = random.Random(6), [], suffixes.suffix_array
    monkeypatch.setattr(suffixes, "suffix_array", lambda text: seen.append(text) or plain(text))
    passage = bytes(some.choice(b"abcdefgh") for _ in range(260))
    contexts = [(0, b"x" * 40 + passage, 1, 140), (1, b"y" * 30 + passage, 1, 130)]
    assert sorted(suffixes.repeated_windows([contexts])) == [(0, 40, 300), (1, 30, 290)]
    assert len(seen) == 1 and passage in seen[0]


def groups(pairs, words, some, of):
    sets = []
    for _, text in pairs:
        w = (text or "").encode().lower().split()
        spans = [tuple(w)] if 0 < len(w) < words else [tuple(w[k : k + words]) for k in range(len(w) - words + 1)]
        sets.append(frozenset(spans))
    holders = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            holders[x].append(k)
    common = Counter((a, b) for held in holders.values() for i, b in enumerate(held) for a in held[:i])
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), n in common.items():
        if of * n >= some * (len(sets[a]) + len(sets[b]) - n):
            root[find(a)] = find(b)
    least = {}
    for k, (doc, _) in enumerate(pairs):
        r = find(k)
        least[r] = min((v for v in (least.get(r), doc) if v is not None), default=None)
    return sorted((str((doc, len(sets[k]), least[find(k)]))) for k, (doc, _) in enumerate(pairs))


def test_similar_documents(spark, medium_dir):
    pairs = documents(spark, medium_dir)
    got = queries.op7_jaccard(spark, medium_dir).collect()
    assert sorted(str(tuple(r)) for r in got) == groups(pairs, 4, 85, 100)
    docs = spark.read.parquet(f"{medium_dir}/documents.parquet")
    assert sorted(str(tuple(r)) for r in jaccard.similar(docs).collect()) == groups(pairs, 5, 4, 5)


@pytest.mark.parametrize("tile", [jaccard.TILE, 8])
def test_similar_odd_documents(spark, monkeypatch, tile):
    monkeypatch.setattr(jaccard, "TILE", tile)
    some = random.Random(3)
    base = [some.choice("abcdefghijkl") * some.randint(1, 3) for _ in range(60)]
    texts = [None, "", " \t\n", "one", "ONE ", "two words", "Two\x0bWords", "É é", "é É", "word " * 20_000]
    for _ in range(60):
        own = list(base)
        for _ in range(some.randint(0, 3)):
            own[some.randrange(60)] = some.choice("mnop")
        texts.append(" ".join(own))
    texts += [" ".join(base[k:]) for k in range(12)] + [texts[-1]] * 3
    rows = [(k, t, "n", 7) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string, label int")
    got = sorted(str(tuple(r)) for r in jaccard.similar(docs, 4, (85, 100)).collect())
    assert got == groups([(i, t) for i, t, *_ in rows], 4, 85, 100)
    assert jaccard.similar(docs.limit(0)).count() == 0


def test_components_of_paths_stars_and_rings(spark):
    some = random.Random(4)
    links = [(k, k + 1) for k in range(100, 140)] + [(200, k) for k in range(201, 260)]
    links += [(299, k) for k in range(270, 299)] + [(300 + k, 300 + (k + 7) % 30) for k in range(30)] + [(5, 5)]
    some.shuffle(links)
    got = dict(tuple(r) for r in components(spark.createDataFrame(links, "a long, b long")).collect())
    want = {k: 100 for k in range(100, 141)} | {k: 200 for k in range(200, 260)}
    assert got == want | {k: 270 for k in range(270, 300)} | {k: 300 for k in range(300, 330)}


def linked(ids, vectors_):
    units = [vectors._unit(v) for v in vectors_]
    n = len(ids)
    near = [[j for j in range(n) if i != j and _cosine(units[i], units[j]) >= vectors.COSINE] for i in range(n)]
    label = list(range(n))
    while True:
        new = [min(label[i], *(label[j] for j in near[i])) if near[i] else label[i] for i in range(n)]
        if new == label:
            break
        label = new
    least = [min(ids[k] for k in range(n) if label[k] == label[i]) for i in range(n)]
    return [(ids[i], len(near[i]), least[i], ids[i] == least[i]) for i in range(n)]


def _cosine(a, b):
    return -1 if a is None or b is None or len(a) != len(b) else a @ b


def found_and_wanted(spark, x):
    """Directed links that the operator finds of each vector, and all there are."""
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = np.concatenate([(unit[k : k + 1200] @ unit.T >= vectors.COSINE).sum(axis=1) for k in range(0, len(x), 1200)]) - 1
    df = spark.createDataFrame([(k, v) for k, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    found = np.array([r.n_links for r in vectors.near_vectors(df).orderBy("vec_id").collect()])
    assert (found <= want).all()
    return found, want


@pytest.mark.parametrize("mutual", [0.7, 0.85])
@pytest.mark.parametrize("n", [2400, 9600])
def test_pairs_of_vectors_that_share_a_direction(spark, n, mutual):
    """Pairs of cosine 0.952 among vectors that are all ``mutual`` apart."""
    some = np.random.default_rng(n)
    rest = some.standard_normal((2, n // 2, 63))
    rest /= np.linalg.norm(rest, axis=2, keepdims=True)
    rest[1] -= (rest[0] * rest[1]).sum(axis=1, keepdims=True) * rest[0]
    rest[1] /= np.linalg.norm(rest[1], axis=1, keepdims=True)
    inner = (0.952 - mutual) / (1 - mutual)
    rest[1] = inner * rest[0] + (1 - inner**2) ** 0.5 * rest[1]
    x = np.concatenate([np.full((n, 1), mutual**0.5), (1 - mutual) ** 0.5 * rest.reshape(n, 63)], axis=1)
    found, want = found_and_wanted(spark, x)
    assert want.sum() >= n
    assert found.sum() >= 0.97 * want.sum()


@pytest.mark.parametrize("n", [2400, 9600])
def test_links_inside_a_dense_group(spark, n):
    some = np.random.default_rng(n)
    x = some.standard_normal((n, 64))
    x[: n // 3] = 8 * x[0] / np.linalg.norm(x[0]) + 0.2 * x[: n // 3]
    x[n // 3 : n // 2] = x[n // 2 : n // 2 + n // 2 - n // 3] + 0.15 * some.standard_normal((n // 2 - n // 3, 64))
    found, want = found_and_wanted(spark, x)
    for part in (slice(0, n // 3), slice(n // 3, n)):  # the group, pairs
        assert found[part].sum() >= 0.97 * want[part].sum() > 0


@pytest.mark.parametrize("tile", [vectors.TILE, 8])
def test_odd_vectors(spark, monkeypatch, tile):
    monkeypatch.setattr(vectors, "TILE", tile)
    some = np.random.default_rng(1)
    base = some.standard_normal((6, 5))
    rows = [base[k % 6] + 0.05 * some.standard_normal(5) for k in range(50)]
    rows += [base[0], base[0], 2 * base[0], base[1] * 1e-200, base[1] * 1e200]
    rows = [r.tolist() for r in rows]
    rows += [None, [], [0.0] * 5, [1.0, None, 0, 0, 0], [float("nan")] * 5, [1.0, float("inf"), 0, 0, 0], [1.0, 2.0], [2.0, 4.0]]
    table = [(k, [None if v is None else float(v) for v in r] if r is not None else None, "a") for k, r in enumerate(rows)]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>, unit string")
    got = [tuple(r) for r in vectors.near_vectors(df).orderBy("vec_id").collect()]
    assert got == linked([t[0] for t in table], [t[1] for t in table])
    assert vectors.near_vectors(df.limit(0)).count() == 0


def test_rare_shingles_are_told_apart():
    """Places of their own for nearly all shingles of a table as large as the check's."""
    x = np.random.default_rng(5).integers(0, 1 << 64, 3_000_000, np.uint64, endpoint=False)
    assert len(np.unique(jaccard._places(x))) > 0.95 * len(x)


def test_sketch_counts_documents(spark):
    rows = [(k, "a b c d") for k in range(600)] + [(700, "e f g h"), (701, "e f g h e f g h"), (702, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").fillna("").coalesce(1)
    levels, own = jaccard._levels(docs, 4), jaccard.Shingles(4)
    often, twice = (jaccard._places(own.of(t)[1])[0] for t in ("a b c d", "e f g h"))
    assert (levels[often], levels[twice]) == (int(6 * np.log2(256)), int(6 * np.log2(3)))
    assert np.count_nonzero(levels) == 5


def test_grouping_sorts_a_shorter_text(monkeypatch):
    lengths, grouped = [], suffixes._grouped
    monkeypatch.setattr(suffixes, "_grouped", lambda codes: lengths.append(len(codes)) or grouped(codes))
    some = random.Random(8)
    texts = [b"", b"a", b"b" * 700, b"ab" * 300 + b"a", "ça va 中文 ".encode() * 40]
    texts += [bytes(some.choices(letters, k=500)) for letters in (b"ab", b"abc\xff", bytes(range(256))) for _ in range(20)]
    for text in texts:
        assert suffixes.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])
        assert lengths[-1] <= len(text) // 2 + 1


@pytest.mark.parametrize("hot", [3, suffixes.HOT])
def test_tables_of_repeats_are_deleted(spark, monkeypatch, hot):
    kept = []
    monkeypatch.setattr(suffixes, "HOT", hot)
    keep = suffixes.keep
    monkeypatch.setattr(suffixes, "keep", lambda df, name: kept.append(keep(df, name)) or kept[-1])
    docs = spark.createDataFrame(list(enumerate(odd_texts())), "doc_id long, text string")
    rows = suffixes.remove_repeats(docs)
    left = [t._kept_in for t in kept if os.path.exists(t._kept_in.removeprefix("file:"))]
    assert len(kept) > 7 and left == [kept[-1]._kept_in]
    assert rows.count() == docs.count()


def test_workers_hold_little_between_tasks(spark, monkeypatch):
    """What is sent to workers is small, is gone afterwards, and tells the level of each place."""
    sent, kind = [], type(spark.sparkContext)
    broadcast = kind.broadcast
    monkeypatch.setattr(kind, "broadcast", lambda self, value: sent.append((value, broadcast(self, value))) or sent[-1][1])
    rows = [(k, " ".join(f"w{(7 * k + j) % 3000}" for j in range(90))) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert jaccard._described(docs, 4, (85, 100)).count() == 400
    ((sketch, handle),) = sent
    assert sum(map(len, sketch)) < jaccard.PLACES // 16
    assert not os.path.exists(handle._path)
    own = jaccard.Shingles(4)
    at = [jaccard._places(own.of(t)[1]) for _, t in rows]
    holders = np.bincount(np.concatenate(at))
    levels = jaccard._unpacked(sketch)
    assert np.count_nonzero(levels) == np.count_nonzero(holders)
    assert all(np.array_equal(levels[x], (6 * np.log2(holders[x] + 1)).astype(np.uint8)) for x in at)
    assert not [v for v in vars(own).values() if isinstance(v, dict)]  # nothing grows with the words met


def test_batches_are_cut_by_their_text():
    texts = ["a" * 3_000_000, "b", "", "c" * 3_000_000, "d"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array(texts)], names=["doc_id", "text"])
    lots = list(jaccard.lighter(iter([batch, batch.slice(0, 0)])))
    assert len(lots) == 2 and pa.Table.from_batches(lots).to_pylist() == batch.to_pylist()
