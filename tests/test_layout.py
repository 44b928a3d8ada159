"""What is read and written: id filters, partitions of the history, files in order."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from breakwater import constants as C
from breakwater.operators import explore
from breakwater.plans import queries
from breakwater.sources import files, tables
from breakwater.sources.tables import BACK, FRONT, ControlTables


def scanned(df):
    """Rows that came out of file scans, and the partition filters of these."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    rows, leaves, filters = 0, plan.collectLeaves(), []
    for k in range(leaves.size()):
        leaf = leaves.apply(k)
        while leaf.getClass().getSimpleName().endswith("QueryStageExec"):
            leaf = leaf.plan().collectLeaves().apply(0)
        if leaf.metrics().contains("numOutputRows"):
            rows += leaf.metrics().apply("numOutputRows").value()
            if hasattr(leaf, "partitionFilters"):
                filters.append(leaf.partitionFilters().toString())
    return rows, filters


@pytest.fixture
def without_dictionaries(spark):
    """Only min, max and the filters can skip row groups, as in files with very many ids."""
    conf = spark._jsc.hadoopConfiguration()
    conf.set("parquet.enable.dictionary", "false")
    yield
    conf.unset("parquet.enable.dictionary")


def test_a_lookup_skips_row_groups(spark, tmp_path, feed, without_dictionaries):
    control = ControlTables(spark, str(tmp_path / "control"), "Feed_Month")
    ids = spark.range(3000).select(F.md5(F.col("id").cast("string")).alias("Trade_ID"), (F.col("id") % 3).cast("int").alias("m"))
    rows = feed({}).drop("Trade_ID").crossJoin(ids).withColumn("Feed_Month", F.col("m"))
    control.replace_feed(rows, FRONT)
    front = control.read(FRONT)
    wanted = front.filter("Feed_Month = 1").orderBy("Trade_ID").limit(500).agg(F.max("Trade_ID")).first()[0]
    found = tables.lookup(front, wanted)
    assert [r["Trade_ID"] for r in found.collect()] == [wanted]
    # Every period's ids lie between the same bounds; the filters of two say that they don't have it.
    assert scanned(front.filter(F.col("Trade_ID") == wanted))[0] == 1000
    assert scanned(front.filter(F.col("Trade_ID") == wanted[:-1] + "x"))[0] == 0
    assert front.filter(F.col("Trade_ID") == wanted).count() == 1


def test_ids_lie_in_order(spark, tmp_path, feed):
    control = ControlTables(spark, str(tmp_path / "control"))
    control.replace_feed(feed({"Trade_ID": "C"}, {"Trade_ID": "A"}, {"Trade_ID": "B"}).coalesce(1), BACK)
    assert [r["Trade_ID"] for r in control.read(BACK).collect()] == ["A", "B", "C"]


# --- newest breaks ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["recent_breaks", "top_critical"])
def test_only_the_needed_runs_are_read(spark, small_dir, name, monkeypatch):
    read = []
    first = explore._first
    monkeypatch.setattr(explore, "_first", lambda df, *a: read.append(scanned(df)) or first(df, *a))
    found = queries.registry()[name](spark, small_dir)
    (rows, filters), = read
    breaks = queries.control_tables(spark, small_dir).read(tables.BREAKS)
    share = {"recent_breaks": 1.0, "top_critical": 0.1}[name]  # 500 and 8 of 568 breaks
    assert found.count() <= rows <= share * breaks.count()
    assert any("Run_ID" in f for f in filters)


def breaks_and_runs(spark, *runs):
    """Runs as (id, day, critical, low) with as many breaks."""
    stamp = {r: dt.datetime(2024, 1, day) for r, day, *_ in runs}
    rows = [(f"{r}-{kind}{k}", "T", r, kind, stamp[r]) for r, _, *counts in runs for kind, n in zip(("CRITICAL", "LOW"), counts, strict=True) for k in range(n)]
    breaks = spark.createDataFrame(rows, "Break_ID string, Trade_ID string, Run_ID string, Severity string, Detected_At timestamp_ntz")
    summary = [(r, stamp[r], c, 0, 0, low) for r, _, c, low in runs]
    columns = ", ".join(f"{c} long" for c in C.SEVERITY_COUNT_COLUMNS.values())
    return breaks, spark.createDataFrame(summary, f"Run_ID string, Created_At timestamp_ntz, {columns}")


def test_runs_are_taken_until_they_hold_enough(spark):
    breaks, runs = breaks_and_runs(spark, ("a", 1, 2, 2), ("b", 2, 0, 3), ("c", 3, 0, 0), ("d", 4, 1, 1), ("e", 4, 0, 1))

    def chosen(limit, newest, count=explore.total_breaks()):
        some = explore._of_first_runs(breaks, runs, count, limit, newest)
        return sorted({r[0] for r in some.select("Run_ID").collect()})

    assert chosen(1, True) == ["d", "e"]  # one time stamp is taken whole
    assert chosen(3, True) == ["d", "e"]
    assert chosen(4, True) == ["b", "d", "e"]
    assert chosen(5, False) == ["a", "b"]
    assert chosen(99, True) == ["a", "b", "d", "e"]
    assert chosen(3, False, F.col("Critical_Breaks")) == ["a", "d"]
    nothing = explore._of_first_runs(breaks, runs.limit(0), explore.total_breaks(), 5, True)
    assert nothing.count() == 0


# --- files in order ------------------------------------------------------------------------------------------


def test_files_follow_one_order(spark, tmp_path):
    rows = spark.range(5000).select(F.md5(F.col("id").cast("string")).alias("k"), (F.col("id") % 7).alias("v"), F.lit('a "b", c').alias("t"))
    path = str(tmp_path / "ordered")
    files.write_ordered_csv(rows, path, ["v", F.desc("k")], drop=["k"], rows_per_file=400)
    parts = sorted((tmp_path / "ordered").glob("part-*.csv"))
    assert len(parts) > 5
    values = [line.split(",")[0] for p in parts for line in p.read_text().splitlines()[1:]]
    assert values == sorted(values) and len(values) == 5000
    path = str(tmp_path / "kept")
    files.write_ordered_csv(rows, path, ["k"], rows_per_file=400)
    back = files.read_ordered_csv(spark, path, rows.schema).orderBy("Position").collect()
    assert [r.Position for r in back] == list(range(1, 5001))
    assert [r.k for r in back] == sorted(r.k for r in rows.collect())


def test_split_files_keep_their_order(spark, tmp_path):
    rows = spark.range(20_000).select(F.format_string("%08d", "id").alias("k"))
    path = str(tmp_path / "split")
    files.write_ordered_csv(rows, path, ["k"], rows_per_file=15_000)
    bytes_ = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 10_000)
    try:
        back = files.read_ordered_csv(spark, path, rows.schema)
        assert files.read_csv(spark, path, rows.schema).rdd.getNumPartitions() > 2
        assert [r.k for r in back.orderBy("Position").collect()] == [f"{k:08d}" for k in range(20_000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", bytes_)
    files.write_ordered_csv(rows.limit(0), path, ["k"])
    assert files.read_ordered_csv(spark, path, rows.schema).count() == 0


# --- counts ------------------------------------------------------------------------------------------------


def test_counts_read_no_column(spark, small_dir):
    """Row counts come from the footers of the files."""
    counts = queries.control_tables(spark, small_dir).counts()
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = counts._jdf.queryExecution().explainString(mode)
    schemas = [line.strip() for line in plan.splitlines() if "ReadSchema" in line]
    assert len(schemas) >= 5 and all(line == "ReadSchema: struct<>" for line in schemas)
