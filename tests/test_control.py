"""Tables, runs, files, quality rules and resolution."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from breakwater import constants as C
from breakwater.functions import is_iso_date
from breakwater.operators import quality, resolution, trades
from breakwater.plans import reports, runs
from breakwater.sources import files, tables
from breakwater.sources.tables import ACTIONS, BACK, BREAKS, FRONT, RUNS, ControlTables
from conftest import TOUCHY


@pytest.fixture
def control(spark, tmp_path):
    return ControlTables(spark, str(tmp_path / "control"))


@pytest.fixture
def loaded(control, feed):
    control.load_feed(feed({"Trade_ID": "A"}, {"Trade_ID": "B"}, {"Trade_ID": "C"}), FRONT)
    control.load_feed(feed({"Trade_ID": "A"}, {"Trade_ID": "B", "Price": 11.0}, {"Trade_ID": "B", "Price": 11.0}), BACK)
    return control


# --- runs and history ----------------------------------------------------------------------------------


def test_runs_add_to_the_history(loaded):
    first = runs.reconcile(loaded, as_of=dt.datetime(2024, 1, 1, 8))
    second = runs.reconcile(loaded, as_of=dt.datetime(2024, 1, 2, 8))
    assert first != second and first.startswith("REC_20240101_080000_")
    assert loaded.read(BREAKS).groupBy(C.RUN).count().count() == 2
    assert loaded.read(BREAKS).count() == 6
    rows = loaded.read(RUNS).orderBy("Created_At").collect()
    assert [r[C.RUN] for r in rows] == [first, second]
    assert [(r["Matched_Count"], r["Match_Percentage"]) for r in rows] == [(1, 33.33)] * 2
    assert all(r["Execution_Time"] > 0 for r in rows)


def test_a_run_id_is_used_once(loaded):
    runs.reconcile(loaded, "R1")
    with pytest.raises(ValueError, match="R1"):
        runs.reconcile(loaded, "R1")
    assert loaded.read(BREAKS).count() == 3


def test_a_repeated_write_counts_once(loaded):
    found = runs.detect_runs(loaded.read(FRONT), loaded.read(BACK), F.lit("R1"), F.lit(None).cast("timestamp_ntz"))
    for run, published in (("R1", False), ("R2", True), ("R1", True)):
        attempt = loaded.begin()
        stored = loaded.store_breaks(found.withColumn(C.RUN, F.lit(run)), attempt)
        assert stored.count() == 3
        loaded.store_runs(summary_rows(loaded, run), attempt)
        if published:
            loaded.publish(attempt)
    assert {r[0]: r[1] for r in loaded.read(BREAKS).groupBy(C.RUN).count().collect()} == {"R1": 3, "R2": 3}
    assert sorted(r[0] for r in loaded.read(RUNS).select(C.RUN).collect()) == ["R1", "R2"]


def summary_rows(control, *ids):
    rows = control.spark.createDataFrame([(i,) for i in ids], "Run_ID string")
    columns = [f for f in tables.SCHEMAS[RUNS] if f.name != C.RUN]
    return rows.select(C.RUN, *[F.lit(None).cast(f.dataType).alias(f.name) for f in columns])


def test_tolerance_reaches_the_run(loaded):
    runs.reconcile(loaded, "WIDE", price_tolerance=5.0)
    assert loaded.read(RUNS).first()["Price_Mismatch_Count"] == 0


def test_empty_feeds_are_refused(control, feed):
    control.load_feed(feed({}), FRONT)
    control.replace_feed(feed({}).limit(0), BACK)
    with pytest.raises(quality.FeedRejected, match="no rows"):
        runs.reconcile(control)


def test_repeated_fo_ids_are_refused(control, feed):
    control.replace_feed(feed({}, {}), FRONT)
    control.load_feed(feed({}), BACK)
    with pytest.raises(quality.FeedRejected, match="not unique"):
        runs.reconcile(control)


def test_clear_keeps_the_audit_log(loaded, spark):
    runs.reconcile(loaded, "R1")
    action = spark.createDataFrame(
        [("b", "A", "RESOLVED", "r", "u", "", dt.datetime(2024, 1, 1), 1)],
        "Break_ID string, Trade_ID string, New_Status string, Reason string, Action_By string, Notes string, "
        "Created_At timestamp_ntz, Action_Seq int",
    )
    loaded.store_actions(action)
    loaded.clear()
    counts = {r[0]: r[1] for r in loaded.counts().collect()}
    assert counts == {FRONT: 0, BACK: 0, BREAKS: 0, RUNS: 0, ACTIONS: 1}
    assert not ControlTables(spark, loaded.root + "-none").exists(FRONT)
    assert ControlTables(spark, loaded.root + "-none").row_count(RUNS) == 0


def test_lookup_and_parameters(loaded, spark):
    assert tables.lookup(loaded.read(FRONT), "B").count() == 1
    assert tables.lookup(loaded.read(FRONT), "nobody").isEmpty()
    found = tables.select(spark, "SELECT * FROM {t} WHERE Price > :p", {"p": 10.5}, t=loaded.read(BACK))
    assert found.count() == 2


# --- loading -------------------------------------------------------------------------------------------


def test_csv_load(control, feed, tmp_path):
    path = str(tmp_path / "feed.csv")
    files.write_csv(feed({"Trader": 'O"Hara, Ann'}, {"Trade_ID": "B"}), path)
    assert control.load_feed_csv(path, FRONT) == 2
    assert control.read(FRONT).filter("Trade_ID = 'T1'").first()["Trader"] == 'O"Hara, Ann'


def test_append_keeps_fo_ids_unique(control, feed):
    control.append_feed(feed({"Trade_ID": "A"}), FRONT)
    control.append_feed(feed({"Trade_ID": "B"}), FRONT)
    with pytest.raises(quality.FeedRejected, match="'A' is not unique"):
        control.append_feed(feed({"Trade_ID": "A"}), FRONT)
    control.append_feed(feed({}, {}), BACK)
    assert (control.row_count(FRONT), control.row_count(BACK)) == (2, 2)


def test_csv_columns_by_name(spark, feed, tmp_path):
    path = str(tmp_path / "turned")
    turned = feed({}).select(*reversed(C.FEED_COLUMNS), F.lit("x").alias("Extra"))
    files.write_csv(turned, path)
    assert files.read_feed_csv(spark, path).collect() == feed({}).collect()


def test_bad_csv_leaves_the_table(control, feed, tmp_path):
    control.load_feed(feed({}), FRONT)
    bad = str(tmp_path / "bad.csv")
    files.write_csv(feed({"Quantity": 0}), bad)
    with pytest.raises(quality.FeedRejected, match="QUANTITY_NOT_POSITIVE"):
        control.load_feed_csv(bad, FRONT)
    narrow = str(tmp_path / "narrow.csv")
    files.write_csv(feed({}).drop("Price"), narrow)
    with pytest.raises(quality.FeedRejected, match="Price"):
        control.load_feed_csv(narrow, FRONT)
    empty = tmp_path / "empty.csv"
    empty.write_text("")
    with pytest.raises(quality.FeedRejected, match="empty"):
        control.load_feed_csv(str(empty), FRONT)
    broken = tmp_path / "broken.csv"
    broken.write_text(",".join(C.FEED_COLUMNS) + "\nT1,not a date,,,,,,,,,x,y,USD,BOOKED\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        control.load_feed_csv(str(broken), FRONT)
    assert control.read(FRONT).count() == 1


@pytest.mark.parametrize(
    "change, rule",
    [
        ({"Trade_ID": "  "}, "TRADE_ID_BLANK"),
        ({"Trade_ID": None}, "TRADE_ID_BLANK"),
        ({"Quantity": -1}, "QUANTITY_NOT_POSITIVE"),
        ({"Price": 0.0}, "PRICE_NOT_POSITIVE"),
        ({"Currency": "usd"}, "CURRENCY_OUTSIDE_DOMAIN"),
        ({"Currency": None}, "CURRENCY_OUTSIDE_DOMAIN"),
        ({"Trade_Status": "NEW"}, "STATUS_OUTSIDE_DOMAIN"),
        ({"Settlement_Date": dt.date(2020, 1, 1)}, "SETTLED_BEFORE_TRADED"),
        ({"Desk": None}, "DESK_MISSING"),
    ],
)
def test_row_rules(feed, change, rule):
    broken = {r["Rule"]: r["Violations"] for r in quality.violations(feed({}, change)).collect() if r["Violations"]}
    assert broken == {rule: 1}


def test_load_rejects_gaps_and_reports_date_order(feed):
    quality.require_valid(feed({"Settlement_Date": dt.date(2020, 1, 1)}), "x")
    with pytest.raises(quality.FeedRejected, match=r"DESK_MISSING \(1\)"):
        quality.require_valid(feed({}, {"Desk": None}), "x")
    with pytest.raises(quality.FeedRejected, match="Price"):
        quality.require_valid(feed({}).drop("Price"), "x")


def test_domains_are_parameters(feed):
    quality.require_valid(feed({"Currency": "CHF"}), "x", currencies=["CHF"])
    with pytest.raises(quality.FeedRejected):
        quality.require_valid(feed({"Currency": "CHF"}), "x")


def test_orphans(spark):
    children = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    parents = spark.createDataFrame([("a",)], "k string")
    assert sorted((r[0] or "" for r in quality.orphans(children, parents, "k").collect())) == ["", "b", "b"]


def test_dates(spark):
    texts = ["2026-08-05", "2026-8-5", "2026-13-01", "2026-02-30", "26-08-05", "2026/08/05", "2026-08-05 10:00", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(is_iso_date(F.col("t"))).collect()] == [True, True] + [False] * 7


def test_trade_records(spark):
    raw = spark.createDataFrame(
        [("A", "100", "150"), (" ", "50", "100"), (None, "x", None)], "trade_id string, quantity string, price string"
    )
    out = trades.trade_records(raw).withColumn("ok", trades.is_valid_record()).collect()
    assert [(r["notional_amount"], r["ok"]) for r in out] == [(15000.0, True), (5000.0, False), (0.0, False)]
    assert (out[0]["currency"], out[0]["status"], out[0]["trader_id_or_book"]) == ("USD", "NEW", "DEFAULT_DESK")


# --- extracts ------------------------------------------------------------------------------------------


def test_nine_datasets(loaded, spark, tmp_path):
    with pytest.raises(ValueError, match="no reconciliation run"):
        reports.analytics_datasets(loaded)
    runs.reconcile(loaded, "R1")
    written = reports.write_analytics_datasets(loaded, str(tmp_path / "out"))
    assert len(written) == 9
    columns = {name: spark.read.option("header", True).csv(path).columns for name, path in written.items()}
    assert columns["desk_summary"] == [
        "Desk", "Total_Trades", "Total_Notional", "Total_Breaks", "Critical_Breaks", "High_Breaks",
        "Medium_Breaks", "Low_Breaks", "Exception_Rate",
    ]
    assert "Execution_Time" in columns["reconciliation_runs"]
    assert "Trade_Notional" in columns["trade_details"]


def test_category_extract_has_every_type(loaded, tmp_path):
    runs.reconcile(loaded, "R1")
    reports.write_category_extract(loaded.read(BREAKS), str(tmp_path / "cat"))
    folders = {p.name for p in (tmp_path / "cat").iterdir() if p.is_dir()}
    assert folders == {f"Break_Type={k}" for k in C.BREAK_TYPES}
    empty = tmp_path / "cat" / f"Break_Type={C.UNEXPECTED}"
    (part,) = empty.glob("part-*.csv")
    assert part.read_text().split() == [",".join(c for c in loaded.read(BREAKS).columns if c != "Break_Type")]
    back = files.read_csv(loaded.spark, str(tmp_path / "cat"), loaded.read(BREAKS).schema)
    assert back.count() == 3


def test_json_audit(loaded, spark, tmp_path):
    runs.reconcile(loaded, "R1")
    path = str(tmp_path / "json")
    reports.write_json_audit(loaded.read(RUNS), loaded.read(BREAKS), path)
    back = files.read_json(spark, f"{path}/breaks", loaded.read(BREAKS).schema)
    assert back.exceptAll(loaded.read(BREAKS)).isEmpty() and back.count() == 3
    (tmp_path / "one.json").write_text(json.dumps([{"a": 1}, {"a": 2}], indent=2))
    assert files.read_json(spark, str(tmp_path / "one.json"), multi_line=True).count() == 2


# --- resolution ----------------------------------------------------------------------------------------

REQUEST = (
    "Break_ID string, New_Status string, Reason string, Action_By string, Notes string, "
    "Created_At timestamp_ntz, Action_Seq int"
)


def _day(n):
    return dt.datetime(2024, 1, n)


@pytest.fixture
def judged(spark):
    breaks = spark.createDataFrame([("b1", "A"), ("b2", "B"), ("b3", "C")], "Break_ID string, Trade_ID string")

    def judge(*requests):
        return breaks, resolution.judge(spark.createDataFrame(list(requests), REQUEST), breaks, TOUCHY)

    return judge


def test_requests_are_judged(judged):
    _, out = judged(
        ("b1", "resolved", None, None, None, _day(1), 1),
        ("b2", "CLOSED", None, None, None, _day(1), 1),
        ("zz", None, None, None, None, _day(1), 1),
        (None, "CLOSED", None, None, None, _day(1), 1),
        ("", "RESOLVED", None, None, None, _day(1), 1),
        ("b3", "", "why", "me", "n", _day(1), 1),
    )
    good = {r["Break_ID"]: r for r in resolution.accepted(out).collect()}
    assert set(good) == {"b1", "b3"}
    assert (good["b1"]["New_Status"], good["b1"]["Reason"], good["b1"]["Action_By"]) == (
        "RESOLVED", "Approved by Product Control", "Product Controller",
    )
    assert (good["b3"]["New_Status"], good["b3"]["Reason"], good["b3"]["Trade_ID"]) == ("RESOLVED", "why", "C")
    assert sorted(r["Reject_Reason"] for r in resolution.rejected(out).collect()) == [
        "Invalid status", "Missing break id", "Missing break id", "Unknown break",
    ]


def test_history_and_state(judged):
    breaks, out = judged(
        ("b1", "RESOLVED", "r1", "u", "", _day(2), 2),
        ("b1", "UNDER_REVIEW", "r0", "u", "", _day(1), 1),
        ("b1", "UNRESOLVED", "reopen", "u", "", _day(3), 3),
        ("b1", "ESCALATED", "same time", "u", "", _day(3), 4),
        ("b2", "ESCALATED", "e", "v", "", _day(1), 1),
    )
    good = resolution.accepted(out)
    for policy in (TOUCHY, resolution.DEFAULT):
        trail = resolution.history(good, slices=3, policy=policy).orderBy("Break_ID", *resolution.ORDER).collect()
        assert [(r["Break_ID"], r["Previous_Status"], r["New_Status"]) for r in trail] == [
            ("b1", "UNRESOLVED", "UNDER_REVIEW"),
            ("b1", "UNDER_REVIEW", "RESOLVED"),
            ("b1", "RESOLVED", "UNRESOLVED"),
            ("b1", "UNRESOLVED", "ESCALATED"),
            ("b2", "UNRESOLVED", "ESCALATED"),
        ]
    state = {r["Break_ID"]: r for r in resolution.current_state(breaks, good).collect()}
    assert [state[b]["Resolution_Status"] for b in ("b1", "b2", "b3")] == ["ESCALATED", "ESCALATED", "UNRESOLVED"]
    assert state["b1"]["Resolved_At"] == _day(3) and state["b3"]["Resolved_At"] is None


# --- recording is safe -----------------------------------------------------------------------------------


def test_a_refused_run_leaves_the_history_alone(loaded, feed):
    runs.reconcile(loaded, "R1")
    before = sorted(map(str, loaded.read(BREAKS).collect()))
    loaded.load_feed(feed({"Trade_ID": "A", "Quantity": 7}), BACK)
    with pytest.raises(ValueError, match="R1"):
        runs.reconcile(loaded, "R1")
    assert sorted(map(str, loaded.read(BREAKS).collect())) == before


def test_a_lost_job_leaves_no_breaks_behind(loaded, feed):
    lost = runs.detect_runs(loaded.read(FRONT), loaded.read(BACK), F.lit("R9"), F.lit(None).cast("timestamp_ntz"))
    assert loaded.store_breaks(lost, loaded.begin()).count() == 3
    loaded.load_feed(feed({"Trade_ID": "A"}, {"Trade_ID": "B"}, {"Trade_ID": "C"}), BACK)
    runs.reconcile(loaded, "R9")
    assert loaded.read(BREAKS).count() == 0
    row = loaded.read(RUNS).first()
    assert (row["Matched_Count"], row["Critical_Breaks"]) == (3, 0)


def test_of_interleaved_writers_the_second_is_refused(loaded):
    """Both have looked before either has written anything."""
    ids = loaded.spark.createDataFrame([("R1",)], "Run_ID string")
    found = runs.detect_runs(loaded.read(FRONT), loaded.read(BACK), F.lit("R1"), F.lit(None).cast("timestamp_ntz"))
    writers = [(loaded.begin(), loaded.require_new_runs(ids)) for _ in range(2)]
    for k, (attempt, _) in enumerate(writers):
        loaded.store_breaks(found.limit(1 + k), attempt)
        loaded.store_runs(summary_rows(loaded, "R1"), attempt)
    second, first = writers
    loaded.publish(*first)
    with pytest.raises(ValueError, match="R1 is already recorded"):
        loaded.publish(*second)
    assert (loaded.read(BREAKS).count(), loaded.read(RUNS).count()) == (2, 1)


def test_a_refused_writer_of_many_runs_adds_none_of_them(loaded):
    one, many = loaded.begin(), loaded.begin()
    loaded.store_runs(summary_rows(loaded, "R2"), one)
    loaded.store_runs(summary_rows(loaded, "R1", "R2", "R3"), many)
    loaded.publish(one)
    with pytest.raises(ValueError, match="R2"):
        loaded.publish(many)
    other = loaded.begin()
    loaded.store_runs(summary_rows(loaded, "R1"), other)
    loaded.publish(other)  # R1 is still free
    assert sorted(r[0] for r in loaded.read(RUNS).select(C.RUN).collect()) == ["R1", "R2"]


def test_a_number_is_published_once(loaded):
    commits = loaded.commits
    assert commits.publish("a", 0) and not commits.publish("b", 0) and commits.publish("b", 1)
    assert commits.entries() == ["a", "b"] == commits.attempts()


def test_rows_of_lost_jobs_can_be_dropped(loaded):
    runs.reconcile(loaded, "R1")
    found = runs.detect_runs(loaded.read(FRONT), loaded.read(BACK), F.lit("R9"), F.lit(None).cast("timestamp_ntz"))
    lost = loaded.begin()
    loaded.store_breaks(found, lost)
    assert loaded.drop_unpublished(dt.datetime(2020, 1, 1)) == []  # it may still be running
    assert loaded.drop_unpublished(dt.datetime.now() + dt.timedelta(hours=1)) == [lost]
    assert loaded.store_breaks(found.limit(0), lost).count() == 0
    assert loaded.read(BREAKS).count() == 3


def test_ids_are_free_again_after_clearing(loaded, feed):
    runs.reconcile(loaded, "R1")
    loaded.clear()
    assert loaded.row_count(BREAKS) == loaded.row_count(RUNS) == 0
    for table in (FRONT, BACK):
        loaded.load_feed(feed({"Trade_ID": "A"}), table)
    runs.reconcile(loaded, "R1")
    assert loaded.read(RUNS).first()["Matched_Count"] == 1


# --- changed periods ---------------------------------------------------------------------------------------


def changed(control, name="", **rule):
    """The periods that are reconciled, as runs REC_<month><name>."""
    run = F.concat(F.lit("REC_"), F.col("Feed_Month").cast("string"), F.lit(name))
    return runs.reconcile_changed(control, run, F.lit("2024-03-01").cast("timestamp_ntz"), **rule)


@pytest.fixture
def months(spark, tmp_path, feed):
    control = ControlTables(spark, str(tmp_path / "months"), "Feed_Month")
    for table in (FRONT, BACK):
        rows = [feed({"Trade_ID": "A"}, {"Trade_ID": "B"}).withColumn("Feed_Month", F.lit(m)) for m in (1, 2, 3)]
        control.load_feed(rows[0].unionByName(rows[1]).unionByName(rows[2]), table)
    return control


def of_month(feed, month, *rows):
    return feed(*rows).withColumn("Feed_Month", F.lit(month))


def test_only_changed_periods_are_reconciled(months, feed):
    assert changed(months) == [1, 2, 3]
    assert changed(months) == []
    months.load_periods(of_month(feed, 2, {"Trade_ID": "A", "Quantity": 5}, {"Trade_ID": "B"}), BACK)
    assert changed(months, "_2") == [2]
    assert months.read(BREAKS).select(C.RUN, "Trade_ID").collect() == [("REC_2_2", "A")]
    assert months.read(RUNS).count() == 4
    # another tolerance is another question
    assert changed(months, "_3", price_tolerance=1.0) == [1, 2, 3]


def test_the_same_rows_in_new_files_are_no_change(months, feed):
    changed(months)
    months.load_periods(of_month(feed, 3, {"Trade_ID": "B"}, {"Trade_ID": "A", "Desk": "Credit"}), FRONT)
    commits = len(months.commits.entries())
    assert changed(months) == []  # no compared column has changed
    assert len(months.commits.entries()) == commits + 1  # the new files are noted,
    assert changed(months) == []
    assert len(months.commits.entries()) == commits + 1  # so they aren't read again
    months.append_feed(of_month(feed, 3, {"Trade_ID": "C"}), FRONT)
    assert changed(months, "_2") == [3]


def test_unchanged_periods_are_not_read(months, feed, tmp_path):
    changed(months)
    months.load_periods(of_month(feed, 2, {"Trade_ID": "A"}), BACK)
    for month in (1, 3):  # reading these files would fail
        for table in (FRONT, BACK):
            for file in (tmp_path / "months" / table / f"Feed_Month={month}").glob("*.parquet"):
                stat = file.stat()
                file.write_bytes(b"x" * stat.st_size)
                os.utime(file, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    assert changed(months, "_2") == [2]
    with pytest.raises(Exception, match="(?i)parquet|checksum"):
        months.read(FRONT).collect()


def test_a_period_gone_from_one_side_is_changed(months, feed):
    changed(months)
    rest = months.read(BACK).filter("Feed_Month <> 1").checkpoint()
    months.replace_feed(rest, BACK)
    # The other periods were written anew with the same rows.
    assert changed(months, "_2") == [1]
    assert months.read(BREAKS).select("Break_Type").distinct().collect() == [(C.MISSING,)]


def test_periods_are_replaced_alone(months, control, feed):
    months.load_periods(of_month(feed, 2, {"Trade_ID": "Z"}), FRONT)
    found = {(r[0], r[1]) for r in months.read(FRONT).select("Feed_Month", "Trade_ID").collect()}
    assert found == {(1, "A"), (1, "B"), (2, "Z"), (3, "A"), (3, "B")}
    with pytest.raises(quality.FeedRejected, match="not unique"):
        months.load_periods(of_month(feed, 2, {"Trade_ID": "Z"}, {"Trade_ID": "Z"}), FRONT)
    with pytest.raises(ValueError, match="no periods"):
        control.load_periods(feed({}), FRONT)


def test_rows_without_a_run_are_refused(spark, tmp_path, feed):
    control = ControlTables(spark, str(tmp_path / "periods"), "Feed_Month")
    rows = feed({"Trade_ID": "A"}).withColumn("Feed_Month", F.lit(None).cast("int"))
    control.replace_feed(rows, FRONT)
    control.replace_feed(rows, BACK)
    run_id, now = F.concat(F.lit("REC_"), F.col("Feed_Month")), F.lit(None).cast("timestamp_ntz")
    with pytest.raises(ValueError, match="without a run"):
        runs.reconcile_runs(control, run_id, now, "Feed_Month")
    assert not control.exists(BREAKS)


def test_absent_tables_count_as_empty(control):
    assert {r[1] for r in control.counts().collect()} == {0}
    assert control.counts().count() == 5


def test_values_out_of_range_end_nothing(spark):
    raw = spark.createDataFrame([("A", "1e15", "3"), ("B", "NaN", "1"), ("C", "Infinity", "1")], "trade_id string, price string, quantity string")
    assert [r.notional_amount for r in trades.trade_records(raw).collect()] == [None] * 3
