"""What several operators need: a shared folder, cut lineage, and exact positions in a global order."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A group with more than one row in so many is joined by broadcast; there are fewer than this many of them.
HOT_SHARE = 1000
#: monotonically_increasing_id() holds the partition above these bits and the row below them.
ROW_BITS = 33


def folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one set as checkpoint
    folder; only a local session without either takes one in its warehouse."""
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if base is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(base)
    return base.rstrip("/")


def keep(df: DataFrame, name: str) -> DataFrame:
    """Writes the rows to the shared folder and reads them back, so that later jobs start from files."""
    path = f"{folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    kept._kept_in = path
    return kept


def discard(*tables: DataFrame) -> None:
    """Deletes the files of tables that ``keep`` has returned, once no later plan reads them."""
    for table in tables:
        path = table._kept_in
        hadoop_path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        hadoop_path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(hadoop_path, True)


#: Bits for each entry of a filter, and the least and most bits a filter has (16 MB).
BITS_EACH, LEAST_BITS, MOST_BITS = 8, 1 << 15, 1 << 27


def filter_bits(entries: int) -> int:
    bits = LEAST_BITS
    while bits < min(MOST_BITS, BITS_EACH * entries):
        bits *= 2
    return bits


def _place(keys: list[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(bits)) + 1


def bit_filter(entries: DataFrame, keys: list[str], bits: int) -> DataFrame:
    """(bucket, bitmap): which hashes of the keys occur, at most 4,096 bitmaps of 4 KB."""
    return keep(
        entries.select(_place(keys, bits).alias("place"))
        .groupBy(F.bitmap_bucket_number("place").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bitmap")),
        "filter",
    )


def marked(rows: DataFrame, bitmaps: DataFrame, keys: list[str], bits: int) -> DataFrame:
    """``rows`` with ``marked``: false for keys that are certainly not among the filter's entries."""
    byte = F.substring(F.col("bitmap"), (F.expr("_bit div 8") + 1).cast("int"), F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    return (
        rows.withColumn("_bit", F.bitmap_bit_position(_place(keys, bits)))
        .join(F.broadcast(bitmaps), F.bitmap_bucket_number(_place(keys, bits)) == F.col("bucket"), "left")
        .withColumn("marked", F.coalesce(F.getbit(value, (F.col("_bit") % 8).cast("int")) == 1, F.lit(False)))
        .drop("_bit", "bucket", "bitmap")
    )


def free(name: str, taken: list[str]) -> str:
    """The name, with as many underscores behind it as set it apart from the names taken."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(
    df: DataFrame, order: list[Column], position: str, running: str | None = None
) -> DataFrame:
    """Adds each row's exact place, from 0, in the order of the whole table.

    A range shuffle sorts the rows over all tasks; a place is the row's place in its partition
    plus the rows of the partitions before it, of which there are as many numbers as
    partitions. With ``running``, ``<position>_sum`` is the sum of that column over all rows
    before. Rows that tie on the whole order are taken in any order, so ``order`` has to name
    all columns that matter. The shuffled rows are written once: a second reading of the
    shuffle could cut the ranges elsewhere.
    """
    spark = df.sparkSession
    placed = (
        df.repartitionByRange(partitions(spark), *order)
        .sortWithinPartitions(*order)
        .withColumn("_row", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_row", ROW_BITS))
    )
    placed = keep(placed, "numbered")
    total = F.sum(running) if running else F.lit(0).cast("long")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"), total.alias("_s"))
        .select(
            "_part",
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"),
            F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_base_sum"),
        )
    )
    out = placed.join(F.broadcast(bases), "_part").withColumn(
        position, F.col("_base") + F.col("_row").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    )
    if running:
        inside = Window.partitionBy("_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
        out = out.withColumn(
            f"{position}_sum",
            F.col("_base_sum") + F.coalesce(F.sum(running).over(inside), F.lit(0)),
        )
    return out.drop("_row", "_part", "_base", "_base_sum")


def attach(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """``rows`` with the figures of their group, null where ``groups`` lists none; null is a key like others.

    ``groups`` has one row per key, of which ``size`` says how many of the ``total`` rows it holds.
    Groups beyond a share of 1 / ``HOT_SHARE`` come to their rows by broadcast, so no task gets all
    rows of a hot key; the others meet theirs in a shuffle. Both tables should be written ones, as
    they are read twice.
    """
    own = {k: f"_{k}" for k in keys}
    named = groups.select(*[F.col(c).alias(own.get(c, c)) for c in groups.columns])
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(o)) for k, o in own.items()])
    is_hot = F.col(size) * HOT_SHARE > total
    hot, cold = F.broadcast(named.where(is_hot)), named.where(~is_hot)
    joined = rows.join(hot, same).unionByName(rows.join(hot, same, "left_anti").join(cold, same, "left"))
    return joined.drop(*own.values())
