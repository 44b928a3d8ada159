"""Clusters and codes of vectors against plain versions in Python's integers."""

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from breakwater.llm import clusters, codes, queries

SCHEMA = "vec_id long, embedding array<double>, label int, point int, row string, cluster int, error long"


def whole(vector, scale, size=None):
    """The scaled integers, or None for vectors that take no part."""
    if vector is None or (size is not None and len(vector) != size):
        return None
    if any(v is None or not math.isfinite(v) for v in vector):
        return None
    return [math.floor(scale * float(v)) for v in vector]


def far(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def step(points, centres):
    of = [min(range(len(centres)), key=lambda k: (far(p, centres[k]), k)) for p in points]
    moved = []
    for k, centre in enumerate(centres):
        own = [p for p, c in zip(points, of, strict=True) if c == k]
        moved.append([sum(v) // len(own) for v in zip(*own, strict=True)] if own else centre)
    return of, moved


def plain_clusters(rows, count=8, rounds=10, size=64):
    kept = [(i, p) for i, v, *_ in rows if (p := whole(v, 1024, size)) is not None]
    raw = {id(p): np.array(p, np.int32).tobytes() for _, p in kept}
    order = sorted(
        kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", raw[id(r[1])])
    )
    centres = [p for _, p in order[:count]]
    points = [p for _, p in kept]
    for _ in range(rounds):
        _, centres = step(points, centres)
    of, _ = step(points, centres) if points else ([], None)
    apart = [far(p, centres[k]) for p, k in zip(points, of, strict=True)]
    sums = defaultdict(int)
    for k, d in zip(of, apart, strict=True):
        sums[k] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return [(i, k, d, sums[k], sum(apart), sha[k]) for (i, _), k, d in zip(kept, of, apart, strict=True)]


def plain_codes(rows):
    kept = [(i, lab, p) for i, v, lab, *_ in rows if (p := whole(v, 4096)) is not None]
    sizes = [len(p) for *_, p in kept]
    size = max(sizes, key=lambda s: (sizes.count(s), s)) if sizes else 0
    used = [r for r in kept if len(r[2]) == size]
    first = sorted(used, key=lambda r: (r[0] is None, r[0] or 0, np.array(r[2], np.int32).tobytes()))[:16]
    cut = [size * p // 8 for p in range(9)]
    books, indexes, errors = [], defaultdict(str), defaultdict(int)
    for a, b in zip(cut, cut[1:], strict=False):
        book, points = [p[a:b] for *_, p in first], [p[a:b] for *_, p in used]
        for _ in range(6):
            _, book = step(points, book)
        of, _ = step(points, book) if points else ([], None)
        for r, (k, p) in enumerate(zip(of, points, strict=True)):
            indexes[r] += f"{k:02x}"
            errors[r] += far(p, book[k])
        books += book
    sha = hashlib.sha256(",".join(str(v) for entry in books for v in entry).encode()).hexdigest()
    found = iter(range(len(used)))
    out = []
    for i, lab, p in kept:
        r = next(found) if len(p) == size else None
        out.append((i, lab, None if r is None else indexes[r], None if r is None else errors[r]))
    sums = defaultdict(lambda: None)
    for _, lab, _, e in out:
        if e is not None:
            sums[lab] = (sums[lab] or 0) + e
    return [(i, c, e, sums[lab], sha) for i, lab, c, e in out]


def odd_rows(size=64):
    some = np.random.default_rng(8)
    base = some.standard_normal((5, size))
    rows = [(k, (base[k % 5] + 0.2 * some.standard_normal(size)).tolist(), k % 3) for k in range(90)]
    rows += [(100 + k, base[0].tolist(), None) for k in range(40)]  # copies
    rows += [(7, base[1].tolist(), 1), (7, base[2].tolist(), 1), (7, base[2].tolist(), 1), (None, base[3].tolist(), None)]
    rows += [(200, [0.0] * size, 5), (201, [0.0] * size, 5), (202, [-1e3] * size, 5), (203, [1e3] + [1e-300] * (size - 1), 5)]
    bad = [None, [], [None] + [0.0] * (size - 1), [math.nan] * size, [math.inf] + [0.0] * (size - 1), [1.0, 2.0], [1.0] * (size + 1)]
    rows += [(300 + k, v, 9) for k, v in enumerate(bad)]
    return [(*r, 1, "x", 2, 3) for r in rows]


def found(df):
    return sorted(map(str, map(tuple, df.collect())))


@pytest.mark.parametrize("take", [None, 5, 1, 0])
def test_odd_vectors_are_clustered(spark, take):
    rows = odd_rows()[:take]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(clusters.cluster_vectors(df)) == sorted(map(str, plain_clusters(rows)))


@pytest.mark.parametrize("size, block", [(64, codes.BLOCK), (64, 4), (21, 8), (5, 3)])
def test_odd_vectors_are_coded(spark, monkeypatch, size, block):
    monkeypatch.setattr(codes, "BLOCK", block)
    rows = odd_rows(size)
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(codes.compress(df)) == sorted(map(str, plain_codes(rows)))


@pytest.mark.parametrize("take", [6, 1, 0])
def test_few_vectors_are_coded(spark, take):
    rows = odd_rows()[:take]
    assert found(codes.compress(spark.createDataFrame(rows, SCHEMA))) == sorted(map(str, plain_codes(rows)))


def test_components_beyond_exact_distances_are_refused(spark):
    df = spark.createDataFrame([(1, [1e30] * 64, 0)], "vec_id long, embedding array<double>, label int")
    for operator in (clusters.cluster_vectors, codes.compress):
        with pytest.raises(Exception, match="would not fit"):
            operator(df).collect()


def test_whole_tables_equal_plain_versions(spark, medium_dir):
    table = spark.read.parquet(f"{medium_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    rows = [tuple(r) for r in table.collect()]
    assert found(queries.op11_clusters(spark, medium_dir)) == sorted(map(str, plain_clusters(rows)))
    assert found(queries.op12_codes(spark, medium_dir)) == sorted(map(str, plain_codes(rows)))


@pytest.mark.parametrize("spread, scale", [(0.05, 1), (3.0, 1), (1e-3, 5000), (0.0, 1)])
def test_simplex_bounds_keep_the_nearest(spread, scale):
    some = np.random.default_rng(11)
    middle = some.standard_normal((10, 64)) * scale
    points = np.floor(1024 * (middle[some.integers(0, 10, 4000)] + spread * some.standard_normal((4000, 64)))).astype(np.int64)
    simplex = clusters.Simplex(points[:64])
    centres = points[some.integers(0, 4000, 8)]
    apexes, tops = (simplex.apexes(simplex.distances(x)) for x in (points, centres))
    exact = np.stack([clusters.squared(points, c) for c in centres], axis=1)
    possible = clusters.candidates(apexes, tops)
    assert possible[exact == exact.min(axis=1, keepdims=True)].all()
    cluster, distance = clusters.nearest(points, apexes, centres, tops, True)
    assert (cluster == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
    if spread == 0.05:  # clear groups: bounds leave out most centres
        assert possible.mean() < 0.5


def test_curve_visits_neighbours():
    for size, bits in ((2, 4), (3, 3), (8, 1), (1, 5)):
        side = 1 << bits
        grid = np.stack(np.meshgrid(*[np.arange(side)] * size, indexing="ij"), axis=-1).reshape(-1, size)
        places = codes.hilbert(grid, bits)
        order = np.lexsort(places.T[::-1])
        assert len({p.tobytes() for p in places}) == len(grid)
        assert (np.abs(np.diff(grid[order], axis=0)).sum(axis=1) == 1).all()


def test_boxes_leave_short_lists():
    some = np.random.default_rng(12)
    points = some.integers(-50, 50, (300, 4)) + some.integers(0, 3, (300, 1)) * 1000
    points = points[np.argsort(points[:, 0], kind="stable")]
    entries = np.array([[0] * 4, [1000] * 4, [2000] * 4, [1000] * 4])
    lengths = []
    for at in range(0, 300, 25):
        own = points[at : at + 25]
        listed = codes.shortlists(own.min(axis=0)[None], own.max(axis=0)[None], entries)[0]
        exact = ((own[:, None] - entries) ** 2).sum(axis=2)
        entry, distance = codes.nearest(own, entries, listed)
        assert (entry == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
        lengths.append(listed.sum())
    assert sum(n <= 2 for n in lengths) >= 8  # all but the blocks across two groups
