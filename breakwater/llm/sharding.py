"""Sharding by proportional stratified interleaving (native)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from breakwater.llm.tables import keep, numbered

SHARDS = 40
SEED = 17
#: Added to each text's bytes: what a stored row costs besides its text.
ROW_BYTES = 16


def interleave(
    docs: DataFrame,
    shards: int = SHARDS,
    seed: int = SEED,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """Puts every row into one of ``shards`` shards that all hold the same mixture of sources.

    Rows are shuffled by a seeded hash and ranked within their source; the rank divided by the
    source's rows orders all sources evenly along one line, which is cut into shards whose row
    counts differ by one at most. Both ranks come from range shuffles, so a source with a third
    of all rows is ranked by many tasks.

    Returns doc_id, source, size (UTF-8 bytes plus 16), text_crc32, shard, slot (gapless from 0
    in each shard). A null text counts as empty, a null source is a source of its own, repeated
    rows each get a place, an empty table gives no rows, other columns are ignored. With fewer
    rows than shards some shards stay empty.
    """
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.col(f"`{source}`").alias("source"),
        (F.octet_length(whole) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(whole.cast("binary")).alias("text_crc32"),
    ).withColumn("_mix", F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "size"))
    last = [F.col(c) for c in ("_mix", "doc_id", "text_crc32", "size")]
    ranked = numbered(rows, [F.col("source"), *last], "_at")
    ranked = keep(ranked, "ranked")
    sources = ranked.groupBy(F.col("source").alias("_source")).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    share = (2 * (F.col("_at") - F.col("_first")) + 1) / (2 * F.col("_rows"))
    spread = ranked.join(sources, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "source", "size", "text_crc32", "_mix", share.alias("_share")
    )
    total = ranked.count()
    line = numbered(spread, [F.col("_share"), *last, F.col("source")], "_place")
    return (
        line.withColumn("shard", F.expr(f"cast(_place * {shards}L div {max(total, 1)}L as int)"))
        .withColumn("_start", F.expr(f"(shard * {total}L + {shards - 1}L) div {shards}L"))
        .select(
            "doc_id",
            "source",
            "size",
            "text_crc32",
            "shard",
            (F.col("_place") - F.col("_start")).alias("slot"),
        )
    )
