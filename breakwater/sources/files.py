"""CSV and JSON in and out. All of it is partitioned Spark IO: a dataset is a directory."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from breakwater import constants as C
from breakwater.operators.quality import FeedRejected, missing_columns
from breakwater.sources.shared import delete, file_system, fresh_path, short_lived_shuffles, written

# Quotes are doubled inside quoted fields, as spreadsheets and most CSV readers expect.
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"'}
#: Rows in one file of an ordered export.
ROWS_PER_FILE = 1_000_000
#: Rows of an ordered export that are sorted at once, about; what that shuffles lies on disk meanwhile.
ROWS_AT_ONCE = 16_000_000
#: Keys that are looked at for every cut between such parts.
KEYS_PER_CUT = 1_000
CUT_SEED = 11
#: Types whose values come back the same from text.
_CUT_TYPES = (T.StringType, T.IntegralType, T.DecimalType, T.FractionalType, T.DateType, T.TimestampNTZType)


def read_feed_csv(spark: SparkSession, path: str) -> DataFrame:
    """A feed from CSV with a header. Columns may come in any order, further columns are ignored.

    Values that don't fit their type fail the read. Nothing is inferred: the header gives the names,
    the feed schema the types.
    """
    header = spark.read.options(**CSV_OPTIONS).csv(path).columns
    if not header:
        raise FeedRejected(f"{path}: empty file")
    schema = T.StructType(
        [C.FEED_SCHEMA[c] if c in C.FEED_COLUMNS else T.StructField(c, T.StringType()) for c in header]
    )
    reader = spark.read.schema(schema).options(**CSV_OPTIONS, mode="FAILFAST", enforceSchema=False)
    rows = reader.csv(path)
    absent = missing_columns(rows)
    if absent:
        raise FeedRejected(f"{path}: missing columns {absent}")
    # "NaN" in a price column is a missing price, not a number that differs from all others.
    price = F.when(~F.isnan("Price"), F.col("Price")).alias("Price")
    return rows.select(*[price if c == "Price" else F.col(c) for c in C.FEED_COLUMNS])


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = (), compression: str = "none") -> None:
    # Files of similar size even where one partition value holds most of the rows.
    writer = (df.hint("rebalance", *partition_by) if partition_by else df).write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with short_lived_shuffles(df.sparkSession):
        writer.mode("overwrite").options(**CSV_OPTIONS, compression=compression).csv(path)


def write_ordered_csv(
    df: DataFrame,
    path: str,
    order: Sequence[str | Column],
    drop: Sequence[str] = (),
    rows_per_file: int = ROWS_PER_FILE,
    staged: bool = True,
    compression: str = "none",
    rows_at_once: int | None = None,
) -> None:
    """CSV files that hold the rows in one total order: rows follow each other within a file, and
    files follow each other by the number in their names.

    The rows are computed once, into the shared folder; the ranges are cut over what is written there,
    as many as give files of about ``rows_per_file`` rows, each sorted by its own task. Columns in
    ``drop`` only give the order. ``staged=False``: the rows are as cheap to read where they are, and
    always the same. Where the order is of plain columns, parts of about ``rows_at_once`` rows are sorted one after
    the other, so the shuffle of one is gone before the next begins.
    """
    spark = df.sparkSession
    stage, parts = fresh_path(spark, "ordered"), f"{path}/_parts"
    options = {**CSV_OPTIONS, "compression": compression}

    def sort(rows: DataFrame, count: int, to: str) -> None:
        ranges = max(1, -(-count // rows_per_file))
        sorted_rows = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).drop(*drop)
        sorted_rows.write.mode("overwrite").options(**options).csv(to)

    try:
        with short_lived_shuffles(spark):
            rows = df
            if staged:
                df.write.option("compression", "zstd").parquet(stage)
                rows = spark.read.schema(df.schema).parquet(stage)
            count = rows.count()
            cuts = _cuts(rows, order, count, rows_at_once or ROWS_AT_ONCE)
            if not cuts:
                sort(rows, count, path)
                return
            delete(spark, path)
            for k in range(len(cuts) + 1):
                part = _between(rows, order, cuts[k - 1] if k else None, cuts[k] if k < len(cuts) else None)
                sort(part, part.count(), f"{parts}/{k:06d}")
            _in_one_folder(spark, parts, path)
    finally:
        delete(spark, stage)


def _cuts(rows: DataFrame, order: Sequence[str | Column], count: int, rows_at_once: int) -> list[Row]:
    """Keys, as text, that cut the order into parts of about as many rows, from a sample of the keys."""
    parts = -(-count // rows_at_once)
    if parts < 2 or not all(isinstance(c, str) and isinstance(rows.schema[c].dataType, _CUT_TYPES) for c in order):
        return []
    some = rows.select(*order).sample(fraction=min(1.0, KEYS_PER_CUT * parts / count), seed=CUT_SEED)
    # KEYS_PER_CUT for each part, about.
    found = some.orderBy(*order).select(*[F.col(c).cast("string").alias(c) for c in order]).collect()
    at = {found[k * len(found) // parts] for k in range(1, parts)} if found else set()
    return [row for k, row in enumerate(found) if row in at and row not in found[max(0, k - 1) : k]]


def _between(rows: DataFrame, order: Sequence[str], first: Row | None, end: Row | None) -> DataFrame:
    """The rows from a key on and before another; NULL comes before all values."""

    def before(key: Row) -> Column:  # never NULL
        out = F.lit(False)
        for c in reversed(order):
            value = F.lit(key[c]).cast(rows.schema[c].dataType)
            less = F.lit(False) if key[c] is None else F.col(c).isNull() | (F.col(c) < value)
            out = less | (F.col(c).eqNullSafe(value) & out)
        return out

    if first is not None:
        rows = rows.filter(~before(first))
    return rows if end is None else rows.filter(before(end))


def _in_one_folder(spark: SparkSession, parts: str, path: str) -> None:
    """Brings the files of folders that follow each other together, numbered through."""
    fs, source = file_system(spark, parts)
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path
    folders = sorted((s.getPath() for s in fs.listStatus(source)), key=lambda p: p.getName())
    number = 0
    for folder in folders:
        found = {f.getName(): f for f in (s.getPath() for s in fs.listStatus(folder))}
        for name in sorted(n for n in found if n.startswith("part-")):
            target = hadoop_path(path, f"part-{number:06d}{name[name.index('-', 5) :]}")
            if not fs.rename(found[name], target):
                raise OSError(f"{found[name].toString()} can't become {target.toString()}")
            number += 1
    delete(spark, parts)
    fs.create(hadoop_path(path, "_SUCCESS")).close()


def read_ordered_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of an ordered export with ``Position``, their place from 1 on in the order of the files.

    The rows are read once, into the shared folder, with their numbers within what a task has read. Only the
    row counts of the parts that tasks read are added up in one place; one row per part comes back
    to the rows, which are not shuffled.
    """
    part = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("int")
    # Tasks read parts of files from front to back, so their row numbers rise within a part.
    rows = read_csv(spark, path, schema).select(
        "*",
        part.alias("_file"),
        F.col("_metadata.file_block_start").alias("_from"),
        F.monotonically_increasing_id().alias("_row"),
    )
    rows = written(rows, "numbered")
    keys = ["_file", "_from"]
    before = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    # A part is read from front to back by one task, so its numbers are without gaps.
    bases = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    bases = bases.select(*keys, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return (
        rows.join(F.broadcast(bases), keys)
        .withColumn("Position", (F.col("_base") + F.col("_row") - F.col("_first") + 1).cast("long"))
        .drop(*keys, "_row", "_base", "_first")
    )


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per line, NULL fields written out."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_json_document(df: DataFrame, path: str) -> None:
    """All rows as one JSON array, a line each: for tables of few rows, such as run summaries."""
    row = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    lines = F.array_join(F.array_sort(F.collect_list(row)), ",\n")
    df.agg(F.concat(F.lit("[\n"), lines, F.lit("\n]")).alias("value")).write.mode("overwrite").text(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = False) -> DataFrame:
    reader = spark.read.option("multiLine", multi_line)
    return (reader.schema(schema) if schema else reader).json(path)


def as_json(df: DataFrame, key: str) -> DataFrame:
    """(key, Json) with each row as one JSON text."""
    return df.select(key, F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("Json"))
