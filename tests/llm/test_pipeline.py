"""The pipeline, stage by stage, against plain versions of what each stage decides."""

from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from test_duplicates import groups, without_repeats

import corpus_pipeline as pipeline
from breakwater.llm import bpe, mixing, queries, toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
INSULTS = set("trash clown idiot scum worthless moron pathetic loser disgusting stupid".split())


@pytest.fixture(scope="module")
def tables(spark, medium_dir, tmp_path_factory):
    """The input and the result of each stage, as lists of rows."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{medium_dir}/documents.parquet")
    out = [docs.collect()]
    for name, stage in pipeline.STAGES:
        stage(spark, docs, medium_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out.append(docs.collect())
    return out


def test_columns_stay(tables):
    for rows in tables[:-1]:
        assert sorted(rows[0].asDict()) == sorted(COLUMNS)


def test_toxic_documents_go(tables):
    before, after = ({r.doc_id: r.text or "" for r in rows} for rows in tables[:2])
    words = {i: len(INSULTS & set(t.lower().replace(".", " ").replace(",", " ").split())) for i, t in before.items()}
    assert not [i for i, n in words.items() if n >= 3 and i in after]
    english = {r.doc_id for r in tables[0] if r.lang == "en"}  # the words above are English
    clean = [i for i, n in words.items() if not n and i in english]
    assert len([i for i in clean if i not in after]) <= 0.01 * len(clean)


def test_one_of_each_group_stays(tables):
    want = [eval(g) for g in groups([(r.doc_id, r.text) for r in tables[1]], 5, 4, 5)]
    assert sorted(r.doc_id for r in tables[2]) == sorted({g[2] for g in want})


def test_repeated_strings_go(tables):
    want = without_repeats([r.text for r in tables[2]])
    after = {r.doc_id: r for r in tables[3]}
    assert len(after) == len(want)
    for r, (size, removed, *_) in zip(tables[2], want, strict=True):
        text = after[r.doc_id].text
        assert after[r.doc_id].n_chars == len(text)
        assert size - removed - 6 <= len(text.encode()) <= size - removed
        assert removed or text == r.text


def test_sources_meet_their_targets(tables):
    words = defaultdict(int)
    for r in tables[4]:
        words[r.source] += len(r.text.split())
    own = Counter()
    for r in tables[3]:
        own[r.source] += len(r.text.split())
    total, weights = sum(own.values()), {s: 1 + k % 3 for k, s in enumerate(sorted(own))}
    targets = {s: total * w / sum(weights.values()) for s, w in weights.items()}
    for s, target in targets.items():
        longest = max(len(r.text.split()) for r in tables[3] if r.source == s)
        assert target - 1 <= words[s] <= target + longest
    assert {r.doc_id for r in tables[4]} <= {r.doc_id for r in tables[3]}


def test_tokens_of_all_rows(tables):
    assert Counter(r.doc_id for r in tables[5]) == Counter(r.doc_id for r in tables[4])
    assert all(len(r.ids) == 4 * r.n_tokens for r in tables[5])


def test_held_out_accuracy(spark, medium_dir):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{medium_dir}/labels.parquet").collect()}
    rows = queries.op4_toxicity(spark, medium_dir).collect()
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(y == p for y, p in held) >= 0.9 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_odd_rows_run_through(spark, tmp_path):
    rows = [(1, None, None, None, None), (1, "", "en", "a", 0), (2, "same " * 90, "en", "a", 1)] * 2
    rows += [(None, "same " * 90, "de", None, 1), (7, "word " * 30_000, "de", "b", 5), (8, "idiot trash", "x", "b", 2)]
    rows += [(k, f"plain words number {k} here", "en", "c", 9) for k in range(20, 40)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, key string"
    extra = [(*r, "clash") for r in rows]
    spark.createDataFrame(extra, schema).write.parquet(f"{tmp_path}/documents.parquet")
    marks = spark.createDataFrame([(8, 1), (8, 0), (7, 0), (None, 1), (30, None)], "doc_id long, toxic int")
    marks.write.parquet(f"{tmp_path}/labels.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() > 0
    empty = tmp_path / "empty"
    spark.createDataFrame([], schema).write.parquet(f"{empty}/documents.parquet")
    marks.limit(0).write.parquet(f"{empty}/labels.parquet")
    assert pipeline.run(spark, str(empty)).count() == 0


@pytest.mark.parametrize("extra", [["Position"], ["_toxicity"], ["_row", "_doc", "position_", "_id", "kept", "size", "positions"]])
def test_columns_of_our_names_stay(spark, tmp_path, extra):
    rows = [(k, f"plain words number {k} here", "ab"[k % 2], *(f"{c} {k}" for c in extra)) for k in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in extra))
    spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    before = docs.columns
    for name, stage in pipeline.STAGES[:-1]:
        docs = pipeline.keep(stage(spark, docs, str(tmp_path)), name)
        assert docs.columns == before
    got = [tuple(r) for r in docs.collect()]
    assert got and set(got) <= set(rows)


def test_columns_of_any_kind_stay(spark, tmp_path):
    rows = [(k, f"plain words number {k} here", "ab"[k % 2], {"k": k}, k / 2) for k in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, m map<string,int>, `a.b` double")
    spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    before = docs.columns
    for name, stage in pipeline.STAGES[:-1]:
        docs = pipeline.keep(stage(spark, docs, str(tmp_path)), name)
        assert docs.columns == before
    got = [tuple(r) for r in docs.collect()]
    assert got and all(r in rows for r in got)


def test_only_cut_characters_go_with_repeats(spark):
    one, two = ("".join(chr(97 + (k * k * m) % 23) + str(k) for k in range(120)) for m in (3, 5))
    texts = [f"keep \ufffd one é{one}é tail one", f"other \ufffd two ĩ{one}ã end two", f"x \ufffd é{two}1", f"y \ufffd ĩ{two}2"]
    docs = spark.createDataFrame([(k, t, 0) for k, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    got = [tuple(r) for r in pipeline.repeats_out(spark, docs, "").orderBy("doc_id").collect()]
    want = ["keep \ufffd one  tail one", "other \ufffd two  end two", "x \ufffd 1", "y \ufffd 2"]
    assert got == [(k, t, len(t)) for k, t in enumerate(want)]


def test_untrained_scores_are_zero(spark):
    docs = spark.createDataFrame([(1, "idiot"), (None, None), (1, "idiot")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [tuple(r)[2:] for r in toxicity.classify(docs, none).collect()] == [(0.0, 0)] * 3


def test_targets_stop_at_three_times(spark):
    rows = [(1, "a b", "s1"), (2, "c " * 600, "s2"), (3, None, "s3"), (4, "d", None), (4, "d", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {(r.source, r.doc_id): r for r in mixing.schedule(docs).collect()}
    assert (got["s1", 1].target, got["s1", 1].taken, len(got["s1", 1].positions)) == (6.0, 6, 3)
    assert got["s3", 3].target == got["s3", 3].taken == 0
    assert got[None, 4].target == 6.0
    assert got["s2", 2].taken == 604 - 12
    assert mixing.curriculum(docs).count() == 3 + 1 + 6
    assert mixing.schedule(docs.limit(0)).count() == 0


def test_memories_of_workers_are_bounded():
    """Two workers and the JVM of an executor share 3,000 MB; each keeps what it remembers for all its tasks."""
    memory = bpe.Memory(lambda new: [b"1234"] * len(new))
    features = toxicity.Features()
    for k in range(60):
        words = [f"{k}x{j}" for j in range(10_000)]
        assert len(memory.known(set(words))) >= len(words)
        features.of(" ".join(words))
        assert len(memory.young) + len(memory.old) <= 430_000
        assert len(features.known) <= 110_001
    assert [n for _, n in bpe.slices(pa.array(["a" * 400_000] * 6), bpe.PART)] == [2, 3, 1]
