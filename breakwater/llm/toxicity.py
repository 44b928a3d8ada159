"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Features are hashed to so many bits.
BITS = 20
#: Labelled documents that the classifier is fitted on at most: those with the smallest hashes.
FITTED_ON = 8000
#: Learning rate, smoothing, L1 and L2 of the proximal step; passes over the sample.
ALPHA, BETA, L1, L2, PASSES = 0.5, 1.0, 6.0, 0.3, 3
#: A document is called toxic from this score on.
THRESHOLD = 0.3
#: Labels of the documents with this remainder of the id's CRC are never learned.
HELD_OUT, FOLDS = 2, 4
#: Words whose hashes a worker remembers.
REMEMBERED = 100_000

WORD = re.compile(r"\w+")
BIAS = 0


class Features:
    """Indices of a text's features: words, pairs of neighbours, and pairs that skip a word."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def of(self, text: str) -> np.ndarray:
        words = WORD.findall(text.lower())
        if len(self.known) > REMEMBERED:
            self.known = {}
        known = self.known
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        pairs = h[:-1] * np.uint64(3) + h[1:] * np.uint64(5)
        skips = h[:-2] * np.uint64(7) + h[2:] * np.uint64(11)
        x = np.concatenate([h, pairs, skips])
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
        return (x >> np.uint64(64 - BITS)).astype(np.int64) | 1 << BITS


def fit(examples: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Indices and weights that are not zero, after passes over (features, label) in order.

    The bias starts from the share of label 1, held low where there are few examples.
    """
    size = 2 << BITS
    z, n = np.zeros(size), np.zeros(size)
    toxic = sum(y for _, y in examples)
    prior = float(np.log((toxic + 1) / (len(examples) - toxic + 10)))
    for _ in range(PASSES):
        for x, y in examples:
            zx, nx = z[x], n[x]
            l1 = np.where(x == BIAS, 0.0, L1)
            root = np.sqrt(nx)
            w = np.where(
                np.abs(zx) <= l1, 0.0, -(zx - np.sign(zx) * l1) / ((BETA + root) / ALPHA + L2)
            )
            g = _sigmoid(prior + w.sum()) - y
            z[x] = zx + g - (np.sqrt(nx + g * g) - root) / ALPHA * w
            n[x] = nx + g * g
    l1 = np.full(size, L1)
    l1[BIAS] = 0.0
    w = np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))
    w[BIAS] += prior
    at = np.flatnonzero(w)
    return at, w[at]


def _sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -35, 35))))


def train(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    fitted_on: int = FITTED_ON,
) -> tuple[np.ndarray, np.ndarray]:
    """Fits the weights on a bounded sample of the labelled rows that aren't held out.

    The sample is the ``fitted_on`` labelled ids of the smallest hash; of rows that repeat an id
    one counts, with the smallest text and label. Fitting takes the sample in hash order in one
    task, which holds the sample's features; weights that L1 leaves, at most 2^20, go to the
    driver. Labels other than 0 and 1 and null ids are passed over.
    """
    key = F.col("doc_id").cast("string")
    marked = (
        labels.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("_label"))
        .where(F.col("doc_id").isNotNull() & F.col("_label").isin(0, 1))
        .where(F.crc32(key.cast("binary")) % FOLDS != HELD_OUT)
        .groupBy("doc_id")
        .agg(F.min("_label").alias("_label"))
        .withColumn("_mix", F.xxhash64(key))
    )
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )
    present = rows.select("doc_id").distinct()
    sample = marked.join(present, "doc_id", "left_semi").orderBy("_mix", "doc_id").limit(fitted_on)
    chosen = rows.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "_label", "_mix").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, examples = Features(), []
        for batch in batches:
            for own, y in zip(batch.column("text"), batch.column("_label"), strict=True):
                x = np.unique(features.of(own.as_py()))
                examples.append((np.concatenate([[BIAS], x]), y.as_py()))
        if examples:
            at, weights = fit(examples)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(weights)], names=["at", "weight"])

    ordered = chosen.repartition(1).sortWithinPartitions("_mix", "doc_id").select("text", "_label")
    got = ordered.mapInArrow(run, "at long, weight double").toPandas()
    return got["at"].to_numpy(np.int64), got["weight"].to_numpy(np.float64)


def score(
    docs: DataFrame,
    weights: tuple[np.ndarray, np.ndarray],
    doc_id: str = "doc_id",
    text: str = "text",
    name: str = "_toxicity",
) -> DataFrame:
    """Every row of ``docs`` with all its columns and its score from 0 to 1, by a ``name`` that must
    not be among them.

    The text alone makes the score; a null text counts as empty. A feature counts once however
    often it occurs. Without weights, as when nothing was labelled, every score is 0. The
    weights, of bounded number, are broadcast. No row leaves its task.
    """
    at, values = weights
    sent = docs.sparkSession.sparkContext.broadcast((at, values))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, value = sent.value
        dense = np.zeros(2 << BITS)
        dense[index] = value
        features = Features()
        for batch in batches:
            scores = []
            for own in batch.column("row").field(text):
                if not len(index):
                    scores.append(0.0)
                    continue
                x = features.of(own.as_py() or "")
                hit = x[dense[x] != 0.0]
                scores.append(_sigmoid(dense[BIAS] + dense[np.unique(hit)].sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(scores, pa.float64())], names=["row", "score"]
            )

    # In one column, names of any kind get through.
    packed = docs.select(F.struct("*").alias("row"))
    scored = packed.mapInArrow(run, T.StructType([*packed.schema.fields, T.StructField("score", T.DoubleType())]))
    return scored.select("row.*", F.col("score").alias(name))


def classify(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted (1 from the threshold on).

    Repeated rows get equal scores, a row without an id is not held out, an empty table gives
    no rows, other columns are ignored. Words are runs of letters, digits and _ in lower case.
    """
    weights = train(docs, labels, doc_id, text)
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD_OUT
    return score(rows, weights).select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.col("_toxicity").alias("score"),
        (F.col("_toxicity") >= threshold).cast("int").alias("predicted"),
    )
