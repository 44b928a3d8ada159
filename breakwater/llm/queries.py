"""One registered query per operator, with production parameters on whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from breakwater.llm import (
    bpe,
    chat,
    clusters,
    codes,
    exact,
    jaccard,
    mixing,
    prints,
    sharding,
    suffixes,
    tokenfiles,
    toxicity,
    vectors,
)

#: The id that ends a document in the token files.
END_ID = 2


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.interleave(_table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )


def op2_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(_table(spark, sf_dir, "embeddings"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(_table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digests(_table(spark, sf_dir, "documents"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(_table(spark, sf_dir, "conversations"))


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar(_table(spark, sf_dir, "documents"), words=4, similarity=(85, 100))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.schedule(_table(spark, sf_dir, "documents"))
    return plan.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        "taken",
        "source",
        "weight",
        F.try_element_at("positions", F.lit(1)).alias("first_position"),
    )


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prints.compare_edits(_table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenfiles.fresh_path(spark)
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    tokenfiles.write(_table(spark, sf_dir, "documents"), tokenizer, END_ID, path)
    return tokenfiles.read(spark, path).select(
        "doc_id",
        "start",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op11_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.cluster_vectors(_table(spark, sf_dir, "embeddings"))


def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(_table(spark, sf_dir, "embeddings"))


def op13_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The digest of every text is a column of its own; the operator hashes only texts that may have a copy.
    digest = F.sha2(exact.normalised("text"), 256).alias("text_sha256")
    return exact.deduplicate(_table(spark, sf_dir, "documents"), carry=[digest])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_sharding": op1_sharding,
        "op2_vectors": op2_vectors,
        "op3_bpe": op3_bpe,
        "op4_toxicity": op4_toxicity,
        "op5_suffixes": op5_suffixes,
        "op6_chat": op6_chat,
        "op7_jaccard": op7_jaccard,
        "op8_mixing": op8_mixing,
        "op9_fingerprints": op9_fingerprints,
        "op10_token_files": op10_token_files,
        "op11_clusters": op11_clusters,
        "op12_codes": op12_codes,
        "op13_exact": op13_exact,
    }


CHAT_SQL = """
WITH placed AS (
  SELECT conv_id, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn, role NULLS FIRST, text NULLS FIRST) - 1 AS place,
         count(*) OVER (PARTITION BY conv_id) AS turns,
         md5(coalesce('r' || role, '-') || chr(1) || coalesce('t' || text, '-')) AS said
  FROM conversations
),
rolled AS (
  SELECT *, string_agg(said, '') OVER (PARTITION BY conv_id ORDER BY place
                                       ROWS UNBOUNDED PRECEDING) AS prefix
  FROM placed
),
whole AS (
  SELECT prefix, min(conv_id) AS conv_id FROM rolled WHERE place = turns - 1 GROUP BY prefix
),
kept AS (
  SELECT conv_id FROM whole
  WHERE prefix NOT IN (SELECT prefix FROM rolled WHERE place < turns - 1)
)
SELECT conv_id, CAST(place // 256 AS INTEGER) AS part, turns, CAST(sum(length(said_text)) AS BIGINT) AS n_chars,
       string_agg(said_text, '' ORDER BY place) AS text
FROM (
  SELECT conv_id, place, turns, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS said_text
  FROM placed WHERE conv_id IN (SELECT conv_id FROM kept)
)
GROUP BY conv_id, CAST(place // 256 AS INTEGER), turns
"""

MIXING_SQL = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
),
laid AS (
  SELECT doc_id, source, size,
         CAST(coalesce(sum(size) OVER (
           PARTITION BY source ORDER BY md5('29:' || CAST(doc_id AS VARCHAR) || ':' || md5(text)), doc_id, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM sized
),
sources AS (
  SELECT source, source_size, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source)
),
rounds AS (
  SELECT 0 AS n, CAST(sum(source_size) AS DOUBLE) / sum(weight) AS each FROM sources
  UNION ALL
  SELECT n + 1, (
    SELECT CASE WHEN sum(CASE WHEN 3 * source_size > each * weight THEN weight END) > 0
      THEN CAST(sum(source_size) - coalesce(sum(CASE WHEN 3 * source_size <= each * weight THEN 3 * source_size END), 0)
                AS DOUBLE)
           / sum(CASE WHEN 3 * source_size > each * weight THEN weight END)
      ELSE each END
    FROM sources)
  FROM rounds WHERE n < (SELECT count(*) FROM sources)
),
targets AS (
  SELECT source, source_size, CAST(weight AS BIGINT) AS weight,
         least(CAST(3 * source_size AS DOUBLE), each * weight) AS target,
         CASE weight WHEN 1 THEN 1.5 WHEN 2 THEN 1.0 ELSE 0.5 END::DOUBLE AS start
  FROM sources, (SELECT arg_max(each, n) AS each FROM rounds)
),
planned AS (
  SELECT l.*, t.source_size, t.weight, t.target, t.start,
         CASE WHEN t.source_size > 0 THEN CAST(floor(t.target) AS BIGINT) // t.source_size ELSE 0 END AS again,
         CAST(floor(t.target) AS BIGINT) AS words
  FROM laid l JOIN targets t ON l.source IS NOT DISTINCT FROM t.source
),
rested AS (
  SELECT *, least(size, greatest(0, words - again * source_size - before)) AS rest FROM planned
)
SELECT doc_id, size, source_size, target, CAST(again * size + rest AS BIGINT) AS taken, source, weight,
       CASE WHEN again > 0 OR rest > 0 THEN
         2 * (before / target) / (start + sqrt(greatest(0, start * start + 2 * (2 - 2 * start) * (before / target))))
       END AS first_position
FROM rested
"""


#: Distances come from exact products; the mean of whole numbers is rounded down.
_MEAN = "CAST((sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT)"


def _clusters_sql() -> str:
    """One pair of steps for each round: assign all vectors, then move the centroids."""
    steps = [
        """kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS p
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
),
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY h) - 1 AS INTEGER) AS cluster, p
  FROM (SELECT sha256('3:' || CAST(vec_id AS VARCHAR)) AS h, p FROM kept ORDER BY h LIMIT 8)
)"""
    ]
    for k in range(clusters.ROUNDS + 1):
        steps.append(
            f"""d{k} AS (
  SELECT vec_id, k.p, c.cluster,
         CAST(list_sum(list_transform(range(1, 65), lambda i: (k.p[i] - c.p[i]) * (k.p[i] - c.p[i]))) AS BIGINT) AS distance
  FROM kept k, c{k} c
),
a{k} AS MATERIALIZED (
  SELECT vec_id, any_value(p) AS p, min_by(cluster, (distance, cluster)) AS cluster, min(distance) AS distance
  FROM d{k} GROUP BY vec_id
)"""
        )
        if k < clusters.ROUNDS:
            steps.append(
                f"""m{k} AS (
  SELECT cluster, list(v ORDER BY place) AS p
  FROM (SELECT cluster, place, {_MEAN} AS v
        FROM (SELECT cluster, unnest(p) AS v, unnest(range(64)) AS place FROM a{k}) GROUP BY cluster, place)
  GROUP BY cluster
),
c{k + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.p, c.p) AS p FROM c{k} c LEFT JOIN m{k} m ON c.cluster = m.cluster
)"""
            )
    last = clusters.ROUNDS
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, a.cluster, distance,
       CAST(sum(distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(list_aggregate(list_transform(c.p, lambda x: CAST(x AS VARCHAR)), 'string_agg', ',')) AS centroid_sha256
FROM a{last} a JOIN c{last} c ON a.cluster = c.cluster
"""


def _codes_sql() -> str:
    """As ``_clusters_sql``, for each of eight parts of a vector and 16 entries."""
    steps = [
        """kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS p
  FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
),
parts AS MATERIALIZED (
  SELECT vec_id, part, p[part * len(p) // 8 + 1 : (part + 1) * len(p) // 8] AS p
  FROM kept, (SELECT unnest(range(8)) AS part)
),
c0 AS MATERIALIZED (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, p
  FROM parts WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 16)
)"""
    ]
    for k in range(codes.ROUNDS + 1):
        steps.append(
            f"""d{k} AS (
  SELECT vec_id, k.part, k.p, c.entry,
         CAST(list_sum(list_transform(range(1, len(k.p) + 1), lambda i: (k.p[i] - c.p[i]) * (k.p[i] - c.p[i]))) AS BIGINT) AS distance
  FROM parts k JOIN c{k} c ON k.part = c.part
),
a{k} AS MATERIALIZED (
  SELECT vec_id, part, any_value(p) AS p, min_by(entry, (distance, entry)) AS entry, min(distance) AS distance
  FROM d{k} GROUP BY vec_id, part
)"""
        )
        if k < codes.ROUNDS:
            steps.append(
                f"""m{k} AS (
  SELECT part, entry, list(v ORDER BY place) AS p
  FROM (SELECT part, entry, place, {_MEAN} AS v
        FROM (SELECT part, entry, unnest(p) AS v, unnest(range(len(p))) AS place FROM a{k}) GROUP BY part, entry, place)
  GROUP BY part, entry
),
c{k + 1} AS MATERIALIZED (
  SELECT c.part, c.entry, coalesce(m.p, c.p) AS p
  FROM c{k} c LEFT JOIN m{k} m ON c.part = m.part AND c.entry = m.entry
)"""
            )
    last = codes.ROUNDS
    return "WITH " + ",\n".join(steps) + f""",
whole AS (
  SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(distance) AS BIGINT) AS error
  FROM a{last} GROUP BY vec_id
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(list_aggregate(list_transform(p, lambda x: CAST(x AS VARCHAR)), 'string_agg', ','), ','
                                 ORDER BY part, entry)) FROM c{last}) AS codebooks_sha256
FROM whole JOIN kept USING (vec_id)
"""


EXACT_SQL = """
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n
"""


def statements() -> dict[str, str]:
    return {
        "op6_chat": CHAT_SQL,
        "op8_mixing": MIXING_SQL,
        "op11_clusters": _clusters_sql(),
        "op12_codes": _codes_sql(),
        "op13_exact": EXACT_SQL,
    }
