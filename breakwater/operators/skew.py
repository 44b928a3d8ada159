"""Joins and lags that keep working when one key holds a large part of all rows.

A key is *hot* when it exceeds ``share`` of the rows of a frame. Hot keys are looked for in a sample
of the key columns, in one scan that shuffles only the sample. By definition there are never more
than ``1 / share`` of them, whatever the size of the data, so the list may go through the driver and
be broadcast. The sample decides only how rows are spread over tasks: every row takes part in every
result, and a hot key that the sample missed is merely not split.

Rows of a hot key are divided over enough salts to bring each (key, salt) group back under the
limit; in sum that is at most about ``2 / share`` groups.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from breakwater.functions import any_null
from breakwater.sources.shared import shared_dir, short_lived_shuffles

SALT = "_salt"
REPEATED = "_repeated"
SAMPLE_SEED = 7
#: Rows of a table in one order that one task takes.
ROWS_PER_SLICE = 1_000_000


@dataclass(frozen=True)
class SkewPolicy:
    """When a key counts as hot.

    ``share``: part of all rows; also bounds the number of hot keys to ``1 / share``.
    ``min_rows``: groups below this size are never worth splitting.
    ``fraction``: part of the rows that is looked at; 1 looks at all of them.
    """

    share: float = 1e-4
    min_rows: int = 20_000
    fraction: float = 1e-3


DEFAULT = SkewPolicy()


def hot_keys(df: DataFrame, keys: Sequence[str], policy: SkewPolicy | None = DEFAULT) -> list[tuple]:
    """Hot keys as ``(key values..., salts)``. A NULL key can be hot as well.

    ``None`` as policy: the frame is known to be small, there is nothing to look for.
    """
    if policy is None:
        return []
    keys = list(keys)
    sample = df.select(*keys)
    if policy.fraction < 1:
        sample = sample.sample(fraction=policy.fraction, seed=SAMPLE_SEED)
    counts = sample.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    # Only groups that can reach the limit are kept, with the size of the sample next to them. The
    # partial counts combine map-side, so a hot key costs one row per task.
    floor = max(1.0, policy.min_rows * policy.fraction)
    total = counts.agg(F.sum("_n")).scalar()
    limit = F.greatest(total * F.lit(policy.share), F.lit(floor))
    hot = counts.filter(F.col("_n") >= limit).select(*keys, (F.col("_n") / limit).alias("_times"))
    with short_lived_shuffles(df.sparkSession):
        rows = hot.collect()  # at most 1 / share rows
    return [(*[r[k] for k in keys], max(2, math.ceil(r["_times"]))) for r in rows]


def scatter(columns: Sequence[str], buckets: Column) -> Column:
    """A bucket per row that is the same on every retry of a task.

    The partition id is mixed in so that exact copies, too, land in different buckets.
    """
    return F.pmod(F.xxhash64(F.spark_partition_id(), *columns), buckets).cast("int")


def salted(
    many: DataFrame,
    one: DataFrame,
    keys: Sequence[str],
    policy: SkewPolicy | None = DEFAULT,
    like: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides prepared for a join that survives hot keys in ``many``, and the columns to join on.

    Rows of ``many`` with a hot key are scattered over the salts of the key. The matching rows of
    ``one`` are repeated once per salt and marked ``REPEATED``; such a key does exist in ``many``,
    for that is where it was found. Rows with a NULL key match nothing, so their salt is free and
    they are scattered as well. Without hot keys the frames come back unsalted. ``like`` is a frame
    with the keys of ``many`` that is cheaper to look at, such as the table it was derived from.
    """
    keys = list(keys)
    found = hot_keys(many if like is None else like, keys, policy)
    if not found:
        return many, one.withColumn(REPEATED, F.lit(False)), keys

    spark = many.sparkSession
    # Rows without a key go anywhere: over as many salts as a shuffle has tasks.
    tasks = F.lit(int(spark.conf.get("spark.sql.shuffle.partitions")))
    fields = [T.StructField(k, many.schema[k].dataType) for k in keys]
    hot = spark.createDataFrame(
        [row for row in found if None not in row], T.StructType([*fields, T.StructField("_salts", T.IntegerType())])
    )
    hot_salts = hot.select(*keys, F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("_hot_salt"))
    no_key = any_null(keys)

    # Bounded by construction: 1 / share keys on the left, about 2 / share salts on the right.
    left = many.join(F.broadcast(hot), keys, "left")
    left = left.withColumn(
        SALT,
        F.when(no_key, scatter(many.columns, tasks))
        .when(F.col("_salts").isNotNull(), scatter(many.columns, F.col("_salts")))
        .otherwise(F.lit(0)),
    ).drop("_salts")
    right = one.join(F.broadcast(hot_salts), keys, "left")
    right = (
        right.withColumn(REPEATED, F.col("_hot_salt").isNotNull())
        .withColumn(
            SALT,
            F.when(no_key, scatter(one.columns, tasks)).otherwise(
                F.coalesce(F.col("_hot_salt"), F.lit(0))
            ),
        )
        .drop("_hot_salt")
    )
    return left, right, [*keys, SALT]


def salted_lookup(
    many: DataFrame,
    one: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    policy: SkewPolicy | None = DEFAULT,
    like: DataFrame | None = None,
) -> DataFrame:
    """``many`` joined to ``one`` (one row per key) on ``keys``.

    ``how`` is ``left``, ``inner``, ``left_semi`` or ``left_anti``: ``one`` may be repeated, so it can
    be looked up in, but its own rows can't be kept.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"a repeated side cannot be joined with {how!r}")
    left, right, on = salted(many, one, keys, policy, like)
    return left.join(right, on, how).drop(SALT, REPEATED)


def previous_value(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    value: str,
    default: str,
    out: str,
    slices: int | None = None,
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """``lag(value, 1, default)`` per key in the given total order.

    Ordinary keys go through one window. The rows of hot keys go through ``sliced_lag``, in as many
    slices as their measured sizes ask for, or ``slices``.
    """
    per_key = Window.partitionBy(key).orderBy(*order)

    def plain(rows: DataFrame) -> DataFrame:
        return rows.withColumn(out, F.lag(value, 1, default).over(per_key))

    found = [(row[0], row[1]) for row in hot_keys(df, [key], policy) if row[0] is not None]
    if not found:
        return plain(df)

    spark = df.sparkSession
    hot = F.broadcast(spark.createDataFrame([(k,) for k, _ in found], T.StructType([df.schema[key]])))
    cold = plain(df.join(hot, [key], "left_anti"))
    needed = slices or sum(salts for _, salts in found)
    carried = sliced_lag(df.join(hot, [key], "left_semi"), order, value, default, out, needed, key)
    return cold.select(*df.columns, out).unionByName(carried.select(*df.columns, out))


def sliced_lag(
    df: DataFrame,
    order: Sequence[str],
    value: str,
    default: str | None,
    out: str,
    slices: int,
    key: str | None = None,
) -> DataFrame:
    """``lag(value, 1, default)`` in the given total order (per key), for rows that no single task should take.

    The rows are range-partitioned by key and order into slices of similar size; the lag inside a
    slice is a window over that slice only, and the first row of each slice takes the last value of
    the slice before it, which needs one row per slice.
    """
    keys = [key] if key else []
    # The slice number comes from sampled range bounds. It is written down once, because the rows
    # are read twice below and both readers have to see the same slices.
    shared_dir(df.sparkSession)
    sliced = (
        df.repartitionByRange(slices, *keys, *order).withColumn("_slice", F.spark_partition_id()).checkpoint()
    )
    within = Window.partitionBy(*keys, "_slice").orderBy(*order)
    over_slices = Window.partitionBy(*keys).orderBy("_slice")
    tails = (
        sliced.groupBy(*keys, "_slice")
        .agg(F.max_by(F.struct(value), F.struct(*order)).alias("_tail"))
        .withColumn("_before", F.lag("_tail", 1).over(over_slices))
        .select(*keys, "_slice", F.col(f"_before.{value}").alias("_before"), F.col("_before").isNotNull().alias("_any"))
    )
    first = F.when(F.col("_any"), F.col("_before")).otherwise(F.lit(default))
    return (
        sliced.withColumn("_lag", F.lag(value).over(within))
        .withColumn("_first", F.row_number().over(within) == 1)
        .join(tails, [*keys, "_slice"], "left")
        .withColumn(out, F.when(F.col("_first"), first).otherwise(F.col("_lag")))
        .select(*df.columns, out)
    )
