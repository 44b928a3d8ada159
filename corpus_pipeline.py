"""A corpus from raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before has kept;
its result is written as Parquet and read again. All but the last return the columns of
``documents``. Rows are told apart by numbers of their own, so repeated rows and repeated ids do
no harm.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from breakwater.llm import bpe, jaccard, mixing, suffixes, toxicity
from breakwater.llm.tables import free, keep


def quoted(columns: list[str]) -> list[str]:
    return ["`" + c.replace("`", "``") + "`" for c in columns]


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the classifier, fitted on the labels of ``sf_dir``, calls toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    weights = toxicity.train(docs, labels)
    name = free("_toxicity", docs.columns)
    return toxicity.score(docs, weights, name=name).where(F.col(name) < toxicity.THRESHOLD).select(*quoted(docs.columns))


def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row of the smallest doc_id of each group that shares five-word shingles at a
    similarity of 0.8 or more; rows without words are kept."""
    row = free("_row", docs.columns)
    rows = keep(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    named = rows.select(F.struct("doc_id", F.col(row).alias("_row")).alias("_id"), "text")
    groups = jaccard.similar(named, words=5, similarity=(4, 5), doc_id="_id")
    kept = groups.where("doc_id = component_id").select(F.col("doc_id._row").alias(row))
    return rows.join(kept, row, "left_semi").select(*quoted(docs.columns))


def repeats_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes the bytes of strings of 200 bytes that start elsewhere too. Pieces of a character
    cut by that go as well; n_chars is counted anew; documents left without text stay."""
    others = F.struct(*quoted([c for c in docs.columns if c != "text"]))
    clean = suffixes.remove_repeats(docs, characters=True, carry=others).select("carry.*", "text")
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*quoted(docs.columns))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and leaves out documents so that sources meet their weights, in training order."""
    position = free("position", docs.columns)
    return mixing.curriculum(docs, position).drop(position)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, with digests of the ids and of what they decode to."""
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_documents(docs, vocabulary, public_tokenizers.PATTERN).select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "ids",
    )


STAGES = [
    ("toxicity", toxic_out),
    ("near_duplicates", near_duplicates_out),
    ("repeated_strings", repeats_out),
    ("mixing", mixed),
    ("tokens", tokenized),
]

#: SQL can't express the classifier; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
