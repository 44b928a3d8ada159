"""Exact duplicates by progressive refinement: length, hash of the opening, hash of the whole text."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from breakwater.llm.tables import attach, bit_filter, filter_bits, keep, marked

#: Code points of a text's opening that are hashed in the second step.
OPENING = 256


def normalised(text: str | Column) -> Column:
    """The text with A-Z, and nothing else, in lower case; null counts as empty."""
    column = F.col(f"`{text}`") if isinstance(text, str) else text
    return F.translate(F.coalesce(column, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def deduplicate(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: list[Column] | None = None
) -> DataFrame:
    """Finds the rows whose texts are identical after lower-casing A-Z.

    One scan notes length in bytes and a hash of the opening of every text. Lengths that occur once
    are left out first, then pairs of length and opening that occur once. A second scan hashes whole
    texts only where length and opening are shared. Texts are never shuffled: what is
    shared is told to the scans by a filter of bits of bounded size (false hits cost a hash, they
    decide nothing), and groups are made of length, opening hash and SHA-256. Counts are
    combined before they are shuffled, and large groups come back to their rows by broadcast.

    Returns one row per row: doc_id, keep_id (largest doc_id of the group), group_size, kept, then
    the ``carry`` columns, which are taken from the row in the second scan. One row of each group is
    kept, also where several have the largest id; ids that are null rank below all others. Null and empty
    texts are one group. An empty table gives no rows; other columns are not looked at.
    """
    whole = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        normalised(text).alias("content"),
        F.octet_length(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("length"),
        F.xxhash64(normalised(F.substring(F.col(f"`{text}`"), 1, OPENING))).alias("opening"),
        F.struct(*(carry or [F.lit(True).alias("_none")])).alias("carried"),
    )
    noted = keep(whole.select("length", "opening"), "openings")
    total = noted.count()
    bits = filter_bits(total)

    lengths = noted.groupBy("length").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    noted = marked(noted, bit_filter(lengths, ["length"], bits), ["length"], bits).where("marked")
    pairs = noted.groupBy("length", "opening").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = bit_filter(pairs, ["length", "opening"], bits)

    rows = keep(
        marked(whole, shared, ["length", "opening"], bits).select(
            "doc_id",
            F.monotonically_increasing_id().alias("row"),
            "length",
            "opening",
            F.when(F.col("marked"), F.unhex(F.sha2("content", 256))).alias("digest"),
            "carried",
        ),
        "digests",
    )
    alone, compared = rows.where("digest IS NULL"), rows.where("digest IS NOT NULL")
    keys = ["length", "opening", "digest"]
    groups = keep(
        compared.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "row")).alias("top"))
        .where("group_size > 1"),
        "copies",
    )
    found = attach(compared, groups, keys, "group_size", total).select(
        "doc_id",
        F.when(F.col("top").isNull(), F.col("doc_id")).otherwise(F.col("top.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (F.col("top").isNull() | (F.col("row") == F.col("top.row"))).alias("kept"),
        "carried",
    )
    single = alone.select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "carried",
    )
    out = found.unionByName(single).select("doc_id", "keep_id", "group_size", "kept", "carried.*")
    return out if carry else out.drop("_none")

