"""What lies on disk while large tables are worked on: shuffles go as jobs end, large jobs come in parts."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from breakwater.operators import detect, sieve, summarise
from breakwater.plans import queries, runs
from breakwater.sources import files, star_feeds
from breakwater.sources.shared import fresh_path, short_lived_shuffles
from breakwater.sources.star_feeds import PERIOD, run_id
from breakwater.sources.tables import BACK, BREAKS, FRONT, RUNS, ControlTables


def shuffle_files(spark):
    """Names of the shuffle files that lie on disk now."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(k).getName() for k in range(files.size())]
    return {n for n in names if n.startswith("shuffle_")}


def rows(df, *columns):
    return sorted(map(str, df.select(*columns or sorted(df.columns)).collect()))


def months(feed, *sizes):
    """A feed with as many rows as told in the months 1, 2, ...; 0 stands for rows without a month."""
    many = [{"Trade_ID": f"T{m}-{k}", "Quantity": 10 + m} for m, n in enumerate(sizes) for k in range(n)]
    month = F.regexp_extract("Trade_ID", r"T(\d+)-", 1).cast("int")
    return feed(*many).withColumn(PERIOD, F.nullif(month, F.lit(0)))


# --- shuffles ----------------------------------------------------------------------------------------------


def test_writes_leave_no_shuffle_behind(spark, tmp_path, feed):
    control = ControlTables(spark, str(tmp_path / "control"), PERIOD)
    front, back = months(feed, 0, 3, 4), months(feed, 0, 2, 4).withColumn("Quantity", F.col("Quantity") + F.col(PERIOD) % 2)
    before = shuffle_files(spark)
    control.replace_feed(front, FRONT)
    control.replace_feed(back, BACK)
    runs.reconcile_runs(control, run_id(), F.lit("2024-01-31").cast("timestamp_ntz"), PERIOD)
    with short_lived_shuffles(spark):
        assert len(rows(control.read(BREAKS).groupBy("Break_Type").count())) == 2
    assert not [n for n in shuffle_files(spark) - before if n.endswith(".data")]
    assert control.read(BREAKS).count() == 3


def test_a_setting_of_the_user_comes_back(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    with pytest.raises(ValueError), short_lived_shuffles(spark):
        assert spark.conf.get(key) == "true"
        raise ValueError
    assert spark.conf.get(key) == before


# --- feeds in parts ----------------------------------------------------------------------------------------


def test_parts_make_up_the_feed(spark, small_dir, monkeypatch):
    monkeypatch.setattr(star_feeds, "LINES_AT_ONCE", 1700)
    parts = list(star_feeds.front_office_parts(spark, small_dir))
    counts = [p.count() for p in parts]
    whole = star_feeds.front_office(spark, small_dir)
    assert len(parts) == 4 and sum(counts) == whole.count() and max(counts) < 1.3 * 1700
    control = queries.load_feeds(spark, small_dir)
    names = [c for c in control.read(FRONT).columns]
    assert rows(control.read(FRONT)) == rows(whole.select(*names))
    assert rows(control.read(BACK)) == rows(star_feeds.back_office(whole).select(*names))


# --- periods in batches ------------------------------------------------------------------------------------


def test_periods_are_dealt_out_whole(spark, feed):
    front, back = months(feed, 2, 3, 1, 4, 1), months(feed, 0, 3, 1, 0, 2)
    dealt = [
        (sorted((r[0] or 0 for r in front.filter(b).select(PERIOD).collect())), back.filter(b).count())
        for b in runs._batches((front, back), PERIOD, 8)
    ]
    assert dealt == [([0, 0, 1, 1, 1], 3), ([2, 3, 3, 3, 3], 1), ([4], 2)]


def test_batches_find_the_same_breaks(spark, tmp_path, feed, monkeypatch):
    front = months(feed, 0, 3, 4, 2)
    back = months(feed, 0, 2, 5, 2).withColumn("Price", F.col("Price") + F.col(PERIOD) % 2)
    compared, recorded = [], []
    detect = runs.all_breaks
    monkeypatch.setattr(runs, "all_breaks", lambda f, b, *a: compared.append(f.count()) or detect(f, b, *a))
    for size in (1000, 8):
        monkeypatch.setattr(runs, "ROWS_AT_ONCE", size)
        control = ControlTables(spark, str(tmp_path / f"of-{size}"), PERIOD)
        control.replace_feed(front, FRONT)
        control.replace_feed(back, BACK)
        runs.reconcile_runs(control, run_id(), F.lit("2024-01-31").cast("timestamp_ntz"), PERIOD)
        recorded.append((rows(control.read(BREAKS)), rows(control.read(RUNS).drop("Execution_Time"))))
    assert compared == [9, 3, 4, 2]
    assert recorded[0] == recorded[1] and len(recorded[0][0]) == 6


def test_single_detectors_follow_each_other(spark, feed):
    front = months(feed, 0, 3, 4)
    back = front.withColumn("Price", F.col("Price") + F.col(PERIOD) % 2)
    before = shuffle_files(spark)
    found = detect.breaks_one_by_one(front, back, PERIOD)
    found.collect()
    # What is left to do for the union is to read nine tables.
    assert not [n for n in shuffle_files(spark) - before if n.endswith(".data")]
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert rows(found) == rows(detect.all_breaks(front, back, PERIOD)) and found.count() == 3


# --- tables of the queries ---------------------------------------------------------------------------------


def folders(spark):
    """Paths two levels below the folder for tables of this session."""
    top = Path(fresh_path(spark, "any")).parent
    return {str(p.relative_to(top)) for p in top.glob("*/*")}


def test_refused_inputs_leave_no_tables(spark, small_dir):
    queries.control_tables(spark, small_dir)
    before = folders(spark)
    assert queries.registry()["refused_inputs"](spark, small_dir).count() == 8
    assert folders(spark) == before


def test_cleared_tables_in_batches(spark, small_dir, monkeypatch):
    queries.control_tables(spark, small_dir)
    compared, found = [], runs.all_breaks
    monkeypatch.setattr(runs, "all_breaks", lambda *a: compared.append(a) or found(*a))
    monkeypatch.setattr(runs, "ROWS_AT_ONCE", 3000)
    before = shuffle_files(spark)
    counts = queries.registry()["cleared_tables"](spark, small_dir)
    assert len(compared) > 3
    assert not [n for n in shuffle_files(spark) - before if n.endswith(".data")]
    assert sorted(r.Row_Count for r in counts.collect())[:4] == [0, 0, 0, 0]


def test_changed_periods_leave_their_history_alone(spark, small_dir):
    queries.control_tables(spark, small_dir)
    before = folders(spark)
    found = queries.registry()["backfill_changed"](spark, small_dir)
    left = {name.split("/")[1] for name in folders(spark) - before}
    assert BREAKS in left and not left & {FRONT, BACK}
    assert found.count() == 92


@pytest.mark.parametrize("name", ["break_history", "rerun_history"])
def test_batches_of_periods_leave_their_history_alone(spark, small_dir, name):
    queries.control_tables(spark, small_dir)
    before = folders(spark)
    found = queries.registry()[name](spark, small_dir)
    left = {folder.split("/")[1] for folder in folders(spark) - before}
    assert BREAKS in left and not left & {FRONT, BACK}
    assert found.count() == (568 if name == "break_history" else 80)


# --- sieve -------------------------------------------------------------------------------------------------


def test_a_sieve_keeps_all_that_is_wanted(spark):
    table = spark.range(20_000).select((F.col("id") % 7).cast("int").alias("m"), F.col("id").cast("string").alias("k"), "id")
    wanted = table.filter("id % 10 = 3").select("m", "k")
    left = sieve.sifted(table, wanted, ["m", "k"])
    assert left.columns == table.columns and 2000 <= left.count() < 2100
    assert left.join(wanted, ["m", "k"]).count() == 2000
    assert sieve.sifted(table, wanted.limit(0), ["m", "k"]).count() == 0
    # Equal numbers of other types have other hashes.
    assert sieve.sifted(table, wanted.withColumn("m", F.col("m").cast("long")), ["m", "k"]).count() == 20_000


def shuffled_rows(df):
    """Rows written to the largest shuffle of a query."""
    df.collect()
    plans, most = [df._jdf.queryExecution().executedPlan()], 0
    while plans:
        plan = plans.pop()
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            plans.append(plan.executedPlan())
        elif name.endswith("QueryStageExec"):
            plans.append(plan.plan())
        if name == "ShuffleExchangeExec":
            most = max(most, plan.metrics().apply("shuffleRecordsWritten").value())
        children = plan.children()
        plans += [children.apply(k) for k in range(children.size())]
    return most


def test_only_trades_with_breaks_are_shuffled(spark, feed):
    front = months(feed, 0, 300, 300)
    back = front.withColumn("Quantity", F.col("Quantity") + F.when(F.col("Trade_ID").endswith("-7"), 1).otherwise(0))
    breaks = detect.all_breaks(front, back, PERIOD).localCheckpoint()
    counts = summarise.break_counts(breaks, front, back, "Asset_Class", PERIOD)
    assert [tuple(r) for r in counts.collect()] == [("Bond", 2, 0)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert shuffled_rows(summarise.break_counts(breaks, front, back, "Asset_Class", PERIOD)) < 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# --- exports -----------------------------------------------------------------------------------------------


def test_ordered_files_in_parts(spark, tmp_path, monkeypatch):
    """The same files in order, whether sorted at once or in parts, with repeated and missing keys."""
    monkeypatch.setattr(files, "KEYS_PER_CUT", 20)
    key = F.when(F.col("id") % 50 == 0, F.lit(None)).when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 997)
    table = spark.range(4000).select(key.alias("a"), F.md5(F.col("id").cast("string")).alias("b"), F.lit("x").alias("c"))
    written, lines = [], []
    for k, size in enumerate((100_000, 700)):
        path = tmp_path / str(k)
        files.write_ordered_csv(table, str(path), ["a", "b"], ["c"], 300, k == 0, "gzip" if k else "none", size)
        written.append(sorted(p.name for p in path.iterdir() if p.name.startswith("part-")))
        found = files.read_ordered_csv(spark, str(path), table.drop("c").schema)
        lines.append([tuple(r) for r in found.orderBy("Position").collect()])
        assert [p.name for p in path.iterdir() if p.is_dir()] == [] and (path / "_SUCCESS").exists()
    assert lines[0] == lines[1] and [r[-1] for r in lines[0]] == list(range(1, 4001))
    assert lines[0] == [(*r, n) for n, r in enumerate(map(tuple, table.drop("c").orderBy("a", "b").collect()), 1)]
    assert len(written[1]) >= 13 and all(n.endswith(".csv.gz") for n in written[1])
    assert [int(n[5:11]) for n in written[1]] == list(range(len(written[1])))


def test_cuts_deal_out_all_rows(spark):
    table = spark.createDataFrame([(a, b) for a in (None, 1, 1, 2, 5) for b in (None, "x", "y")], "a int, b string")
    cuts = table.distinct().selectExpr("a", "b").orderBy("a", "b").selectExpr("string(a) a", "b").collect()[::3]
    ends = [None, *cuts, None]
    parts = [files._between(table, ["a", "b"], *ends[k : k + 2]).collect() for k in range(len(ends) - 1)]
    assert [len(p) for p in parts] == [0, 3, 6, 3, 3]
    assert sorted(sum(parts, []), key=str) == sorted(table.collect(), key=str)


def test_positions_shuffle_no_rows(spark, tmp_path):
    path = str(tmp_path / "ordered")
    table = spark.range(4000).select(F.md5(F.col("id").cast("string")).alias("k"))
    files.write_ordered_csv(table, path, ["k"], rows_per_file=400)
    found = files.read_ordered_csv(spark, path, table.schema)
    assert shuffled_rows(found) < 100
    assert [r.Position for r in found.orderBy("k").collect()] == list(range(1, 4001))
