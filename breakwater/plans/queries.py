"""The registered queries: every operator applied to the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from breakwater import constants as C
from breakwater.functions import is_iso_date, severity_of
from breakwater.operators import detect, enrich, explore, perturb, quality, resolution, summarise, trades
from breakwater.plans import reports, runs
from breakwater.sources import files, star_feeds, tables
from breakwater.sources.shared import delete, fresh_path, short_lived_shuffles
from breakwater.sources.star_feeds import PERIOD, as_of, fault_bucket, key_parts, period_of_run, run_id
from breakwater.sources.tables import ACTIONS, BACK, BREAKS, FRONT, RUNS, ControlTables

STAR_TABLES = ["lineitem", "orders", "customer", "nation", "part", "supplier"]
OPEN_RUNS_BEFORE = 199601  # break_history records the runs before and from this month separately
CORRECTED_YEAR, RELOADED_YEAR = 1996, 1994  # backfill_changed loads these again, changed and unchanged

_loaded: dict[tuple, ControlTables] = {}
_written: dict[str, dict[str, Callable[[], DataFrame]]] = {}
_seen: dict[tuple, tuple | None] = {}  # version of the source files, for the duration of one query


# --- inputs ----------------------------------------------------------------------------------------


def _version(spark: SparkSession, sf_dir: str) -> tuple:
    """Sizes and times of the source files, so that changed tables are loaded again."""
    paths = [f"{sf_dir}/{t}.parquet" for t in STAR_TABLES]
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    seen = listing.agg(F.count(F.lit(1)), F.sum(F.xxhash64("path", "modificationTime", "length").cast("decimal(38,0)")))
    return tuple(seen.first())


def control_tables(spark: SparkSession, sf_dir: str) -> ControlTables:
    """Feeds loaded and every period reconciled, once per session and version of the tables.

    This is the load-then-reconcile step users take before they ask questions. Feeds, breaks and
    run summaries become tables in the shared folder, which also cuts the lineage of all queries.
    """
    source = (spark.sparkContext.applicationId, sf_dir)
    version = _seen.get(source) or _version(spark, sf_dir)
    if source in _seen:
        _seen[source] = version
    key = (*source, version)
    if key not in _loaded:
        control = load_feeds(spark, sf_dir)
        reconcile_all(control)
        breaks = control.read(BREAKS)
        control.store_actions(resolution.accepted(resolution.judge(resolution_requests(breaks), breaks)))
        _loaded[key] = control
    return _loaded[key]


def load_feeds(spark: SparkSession, sf_dir: str) -> ControlTables:
    control = ControlTables(spark, fresh_path(spark, "control"), PERIOD)
    control.replace_feed_by_parts(star_feeds.front_office_parts(spark, sf_dir), FRONT)
    # BO is a projection of the FO table and keeps its order, so it needs no shuffle.
    control.replace_feed(star_feeds.back_office(_bucketed(control.read(FRONT))), BACK, in_order=True)
    return control


def reconcile_all(control: ControlTables) -> None:
    # front_office keeps one row per line key, and the id is that key.
    runs.reconcile_runs(control, run_id(), as_of(), PERIOD, ids_checked=True)


def _bucketed(feed: DataFrame) -> DataFrame:
    key = key_parts(F.col("Trade_ID"))
    return feed.withColumns(
        {
            "Fault_Bucket": fault_bucket(*key).cast("int"),
            "Fault_Variant": star_feeds.fault_variant(*key).cast("int"),
        }
    )


def _feeds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    control = control_tables(spark, sf_dir)
    return control.read(FRONT), control.read(BACK)


def _breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control_tables(spark, sf_dir).read(BREAKS)


def _breaks_of_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Breaks with the period under which their trades are found in the feeds."""
    return _breaks(spark, sf_dir).withColumn(PERIOD, period_of_run())


def _by_run(breaks: DataFrame) -> DataFrame:
    return breaks.withColumn(C.RUN, run_id()).drop(PERIOD)


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    # How long a run took is not a function of the data.
    return control_tables(spark, sf_dir).read(RUNS).drop("Execution_Time")


def _details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trades.trade_details(control_tables(spark, sf_dir).read(FRONT))


def _defective(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The FO feed with defects a load has to notice, again by fault bucket."""
    k = F.col("Fault_Bucket")
    feed = perturb.duplicate_rows(_bucketed(_feeds(spark, sf_dir)[0]), k.between(60, 64))

    def put(column, low, high, value):
        return F.when(k.between(low, high), value).otherwise(F.col(column))

    nothing = F.lit(None)
    return feed.withColumns(
        {
            "Trade_ID": F.when(k < 5, F.lit(" ")).otherwise(put("Trade_ID", 5, 9, nothing)),
            "Quantity": F.when(k.between(10, 14), -F.col("Quantity")).otherwise(put("Quantity", 15, 19, nothing)),
            "Price": F.when(k.between(20, 24), F.lit(0.0))
            .when(k.between(65, 69), F.lit(1e15))
            .otherwise(put("Price", 25, 29, nothing)),
            "Currency": F.when(k.between(30, 34), F.lit("XXX")).otherwise(
                put("Currency", 35, 39, F.lower("Currency"))
            ),
            "Trade_Status": F.when(k.between(40, 44), F.lit("CANCELLED")).otherwise(
                put("Trade_Status", 45, 49, nothing)
            ),
            "Settlement_Date": put("Settlement_Date", 50, 54, F.date_sub("Trade_Date", 1)),
            "Trader": put("Trader", 55, 59, nothing),
        }
    )


def _raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defective feed rows as loosely typed records: numbers as text, some of them unreadable."""
    feed = _defective(spark, sf_dir)
    k = F.col("Fault_Bucket")
    text = feed.withColumns(
        {
            "Quantity": F.when(k.between(70, 74), F.lit("n/a")).otherwise(F.col("Quantity").cast("string")),
            "Price": F.when(k.between(75, 79), F.lit("1e15"))
            .when(k.between(80, 84), F.lit("NaN"))
            .when(k.between(85, 89), F.lit("Infinity"))
            .otherwise(F.col("Price").cast("string")),
        }
    )
    return trades.as_record(text, "FRONT_OFFICE")


def resolution_requests(breaks: DataFrame) -> DataFrame:
    """Requests to resolve breaks, by the bucket of the trade: none, one, two, and some to be rejected."""
    k = F.col("_k")

    def step(hit, status, seq, break_id=None):
        key = F.col("Break_ID") if break_id is None else break_id
        return F.when(
            hit, F.struct(key.alias("Break_ID"), F.lit(status).alias("New_Status"), F.lit(seq).alias("Action_Seq"))
        )

    steps = [
        step(k % 5 == 1, "RESOLVED", 1),
        step(k % 5 == 2, "ESCALATED", 1),
        step(k % 5 == 3, "UNDER_REVIEW", 1),
        step(k % 5 == 3, "RESOLVED", 2),
        step(k % 5 == 4, "RESOLVED", 1),
        step(k % 5 == 4, "UNRESOLVED", 2),
        step(k % 50 == 7, "CLOSED", 3),
        step(k % 50 == 8, "RESOLVED", 3, F.concat(F.lit("gone-"), F.col("Break_ID"))),
        step(k % 50 == 9, "RESOLVED", 3, F.lit(None).cast("string")),
    ]
    requests = (
        breaks.withColumn("_k", fault_bucket(*key_parts(F.col("Trade_ID"))))
        .select("_k", "Detected_At", F.explode(F.array(*steps)).alias("_s"))
        .filter(F.col("_s").isNotNull())
        .select("_k", "Detected_At", "_s.*")
    )
    left_out = (k % 7 == 0) & (F.col("New_Status") == "RESOLVED")
    return requests.select(
        "Break_ID",
        F.when(left_out, F.lit(None)).when(k % 3 == 0, F.lower("New_Status")).otherwise(F.col("New_Status")).alias(
            "New_Status"
        ),
        F.when(k % 2 == 1, F.lit("Checked with desk")).alias("Reason"),
        F.when(k % 4 != 0, F.concat(F.lit("Analyst "), (k % 6).cast("string"))).alias("Action_By"),
        F.lit(None).cast("string").alias("Notes"),
        (F.col("Detected_At") + F.make_dt_interval(days=F.col("Action_Seq"))).alias("Created_At"),
        "Action_Seq",
    )


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    breaks = _breaks(spark, sf_dir)
    return resolution.judge(resolution_requests(breaks), breaks)


def _actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control_tables(spark, sf_dir).read(ACTIONS)


def _state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolution.current_state(_breaks(spark, sf_dir), _actions(spark, sf_dir))


def _enriched(spark: SparkSession, sf_dir: str, breaks: DataFrame | None = None) -> DataFrame:
    """All breaks, or the given ones, with their trade attributes."""
    breaks = _breaks(spark, sf_dir) if breaks is None else breaks
    dated = breaks.withColumn(PERIOD, period_of_run())
    return enrich.enrich(dated, *_feeds(spark, sf_dir), PERIOD).drop(PERIOD)


def _enriched_state(spark: SparkSession, sf_dir: str, breaks: DataFrame | None = None) -> DataFrame:
    """The same with the resolution state."""
    breaks = _breaks(spark, sf_dir) if breaks is None else breaks
    return resolution.current_state(_enriched(spark, sf_dir, breaks), _actions(spark, sf_dir), like=breaks)


def _filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    # What the breaks tell themselves is filtered before anything is looked up for them.
    prices = explore.filter_breaks(_breaks(spark, sf_dir), break_type=C.PRICE)
    return explore.filter_breaks(_enriched_state(spark, sf_dir, prices), text="supplier", resolution="RESOLVED")


def _sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = explore.slice_breaks(
        _breaks(spark, sf_dir), "1994-01-01", "1996-12-31", Severity=["CRITICAL", "HIGH"]
    )
    return explore.slice_breaks(
        _enriched(spark, sf_dir, dated),
        Desk=["BUILDING", "MACHINERY"],
        Counterparty=["NATION_1", "NATION_2", "NATION_3"],
    )


# --- sources and sinks -------------------------------------------------------------------------------


def _csv_roundtrip(table: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = fresh_path(spark, f"{table}-csv")
        files.write_csv(control_tables(spark, sf_dir).read(table).select(*C.FEED_COLUMNS), path)
        return files.read_feed_csv(spark, path)

    return query


def _replaced_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed replaced by another, then a load that is refused and changes nothing."""
    control = _copied(spark, sf_dir, "replaced")
    front = _feeds(spark, sf_dir)[0]
    control.load_feed(front.filter(F.col(PERIOD) >= OPEN_RUNS_BEFORE), FRONT)
    _refusal(lambda: control.load_feed(_defective(spark, sf_dir).withColumn(PERIOD, F.lit(1)), FRONT))
    return control.read(FRONT)


def _cleared_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts after recorded tables were emptied; the audit trail stays."""
    control = _copied(spark, sf_dir, "cleared")
    reconcile_all(control)
    control.store_actions(_actions(spark, sf_dir))
    control.clear()
    return control.counts()


def _refusal(action: Callable[[], object]) -> str:
    """What a refused input is refused with."""
    try:
        action()
    except ValueError as e:
        return str(e)
    raise RuntimeError("nothing was refused")


def _refused_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(Case, Refusal): inputs made from the feeds that must not be loaded, reconciled or exported."""
    front, back = _feeds(spark, sf_dir)
    first = front.filter(F.col("Trade_ID") == front.agg(F.min("Trade_ID")).first()[0])
    defective = _defective(spark, sf_dir).withColumn(PERIOD, F.lit(1))
    no_run = front.withColumn(PERIOD, F.when(F.col(PERIOD) >= OPEN_RUNS_BEFORE, F.col(PERIOD)))

    def same_feeds(control: ControlTables) -> None:
        control.replace_feed(front, FRONT, in_order=True)
        control.replace_feed(back, BACK, in_order=True)

    def no_rows(control: ControlTables) -> None:
        control.replace_feed(front, FRONT, in_order=True)
        control.replace_feed(back.limit(0), BACK)

    def unnamed(control: ControlTables) -> None:
        # A file holds one period, so what loses it still lies in order.
        control.replace_feed(no_run, FRONT, in_order=True)
        control.replace_feed(back, BACK, in_order=True)

    def no_price(control: ControlTables) -> None:
        csv = front.select(*C.FEED_COLUMNS).drop("Price")
        files.write_csv(csv, control.path("no-price"), compression="gzip")

    # What was made for some cases goes before the next ones are made.
    cases = [
        (
            same_feeds,
            {
                "rows against the rules": lambda control: control.load_feed(defective, FRONT),
                "column missing": lambda control: control.load_feed(front.drop("Desk", "Price"), FRONT),
                "id repeated": lambda control: control.load_feed(front.unionByName(first), FRONT),
                "id repeated by appending": lambda control: control.append_feed(first, FRONT),
            },
        ),
        (no_price, {"column missing in a file": lambda control: files.read_feed_csv(spark, control.path("no-price"))}),
        (no_rows, {"feed without rows": reconcile_all}),
        (unnamed, {"rows without a run": reconcile_all}),
        (lambda control: None, {"export without history": reports.analytics_datasets}),
    ]
    refused = []
    for make, actions in cases:
        control = ControlTables(spark, fresh_path(spark, "refusing"), PERIOD)
        try:
            make(control)
            for name, action in actions.items():
                refusal = _refusal(partial(action, control))
                refused.append((name, refusal.replace(control.path("no-price"), "file")))
        finally:
            delete(spark, control.root)
    return spark.createDataFrame(refused, "Input string, Refusal string")


def _json_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run summaries as one JSON document over many lines, read back."""
    path = fresh_path(spark, "document")
    summary = _runs(spark, sf_dir)
    files.write_json_document(summary, path)
    return files.read_json(spark, path, summary.schema, multi_line=True)


def _copied(spark: SparkSession, sf_dir: str, name: str) -> ControlTables:
    """Control tables of their own with the same feeds, to change and record in."""
    front, back = _feeds(spark, sf_dir)
    control = ControlTables(spark, fresh_path(spark, name), PERIOD)
    control.replace_feed(front, FRONT, in_order=True)
    control.replace_feed(back, BACK, in_order=True)
    return control


def _recorded_in_batches(spark: SparkSession, sf_dir: str) -> ControlTables:
    """Two batches of periods, loaded and recorded one after the other; in between a job that is lost,
    and one that is refused as its runs are on record."""
    front, back = _feeds(spark, sf_dir)
    history = ControlTables(spark, fresh_path(spark, "history"), PERIOD)
    for batch in (F.col(PERIOD) < OPEN_RUNS_BEFORE, F.col(PERIOD) >= OPEN_RUNS_BEFORE):
        history.replace_feed(front.filter(batch), FRONT, in_order=True)
        history.replace_feed(back.filter(batch), BACK, in_order=True)
        # Breaks at another tolerance, written and never published.
        feeds = front.filter(batch), back.filter(batch)
        runs.store_detected(history, feeds, run_id(), as_of(), history.begin(), PERIOD, 75.0)
        reconcile_all(history)
        try:
            reconcile_all(history)
        except ValueError:
            continue
        raise RuntimeError("runs on record were recorded again")
    return _history_of(history)


def _history_of(control: ControlTables) -> ControlTables:
    """Control tables of which only the history is read from here on: copies of feeds are deleted."""
    for table in (FRONT, BACK):
        delete(control.spark, control.path(table))
    return control


def _break_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recorded_in_batches(spark, sf_dir).read(BREAKS)


def _rerun_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recorded_in_batches(spark, sf_dir).read(RUNS).drop("Execution_Time")


def _backfill_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All periods, then those of one year again after BO was corrected: FO's rows, but for the missing ones.

    Another year is loaded once more as it was; its files are new, its rows are not, so no run follows.
    """
    control = _copied(spark, sf_dir, "changed")
    runs.reconcile_changed(control, run_id(), as_of(), ids_checked=True)
    front, back = _feeds(spark, sf_dir)
    year = F.col(PERIOD) / 100
    front = _bucketed(front.filter(year.cast("int") == CORRECTED_YEAR))
    control.load_periods(front.filter(~star_feeds.hit("missing")).drop(*star_feeds.BUCKETS), BACK)
    control.load_periods(back.filter(year.cast("int") == RELOADED_YEAR), BACK)
    second = F.concat(run_id(), F.lit("_2"))
    runs.reconcile_changed(control, second, as_of(), ids_checked=True)
    return _history_of(control).read(RUNS).drop("Execution_Time")


def _category_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "by-category")
    breaks = _breaks(spark, sf_dir)
    reports.write_category_extract(breaks, path)
    return files.read_csv(spark, path, breaks.schema)


def _breaks_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "audit")
    breaks = _breaks(spark, sf_dir)
    reports.write_json_audit(_runs(spark, sf_dir), breaks, path)
    return files.as_json(files.read_json(spark, f"{path}/breaks", breaks.schema), "Break_ID")


def _run_audit_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "run-audit")
    summary = _runs(spark, sf_dir)
    files.write_json(summary, path)
    return files.read_json(spark, path, summary.schema)


def _filtered_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "filtered")
    high = explore.filter_breaks(_breaks(spark, sf_dir), severity="HIGH")
    chosen = explore.filter_breaks(_enriched_state(spark, sf_dir, high), resolution="RESOLVED")
    extract = explore.filtered_extract(chosen)
    files.write_csv(extract, path)
    return files.read_csv(spark, path, extract.schema)


def _trade_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    front = control_tables(spark, sf_dir).read(FRONT)
    return tables.lookup(front, front.agg(F.min("Trade_ID")).scalar()).select(*C.FEED_COLUMNS)


def _append_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed loaded in two appends."""
    front = control_tables(spark, sf_dir).read(FRONT)
    target = ControlTables(spark, fresh_path(spark, "appended"), PERIOD)
    for batch in (F.col(PERIOD) < OPEN_RUNS_BEFORE, F.col(PERIOD) >= OPEN_RUNS_BEFORE):
        target.append_feed(front.filter(batch), FRONT)
    return target.read(FRONT)


def _control_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.control_status(control_tables(spark, sf_dir).counts(), _runs(spark, sf_dir))


def _exported(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the nine analytics datasets, which are written as CSV, once per set of control tables, and read back."""
    control = control_tables(spark, sf_dir)
    if control.root not in _written:
        datasets = reports.analytics_datasets(control, PERIOD, period_of_run())
        paths = reports.write_datasets(datasets, fresh_path(spark, "analytics"), compression="gzip")
        schemas = {n: df.select(*reports.exported_columns(n, df)).schema for n, df in datasets.items()}
        _written[control.root] = {n: partial(files.read_csv, spark, path, schemas[n]) for n, path in paths.items()}
        for n in reports.EXPORT_ORDER:
            _written[control.root][f"{n}_in_order"] = partial(files.read_ordered_csv, spark, paths[n], schemas[n])
    return _written[control.root][name]()


def _analytics_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number of rows found in each dataset."""
    out = None
    for name, rows in ((n, _exported(spark, sf_dir, n)) for n in C.DATASETS):
        one = rows.agg(F.count(F.lit(1)).alias("Row_Count")).select(F.lit(name).alias("Dataset"), "Row_Count")
        out = one if out is None else out.unionByName(one)
    return out


def _exported_rows(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """All rows of one dataset."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        # How long a run took is not a function of the data.
        return _exported(spark, sf_dir, name).drop("Execution_Time")

    return query


def _summary_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "by-run")
    summary = _runs(spark, sf_dir)
    reports.write_run_extract(summary, _breaks(spark, sf_dir), path)
    return files.read_csv(spark, f"{path}/summary", summary.schema)


# --- data quality ------------------------------------------------------------------------------------


def _date_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = _bucketed(_feeds(spark, sf_dir)[0])
    day, k = F.col("Trade_Date"), F.col("Fault_Bucket") % 8
    year = F.year(day).cast("string")
    text = (
        F.when(k == 0, F.date_format(day, "yyyy/MM/dd"))
        .when(k == 1, F.concat_ws("-", year, F.month(day).cast("string"), F.day(day).cast("string")))
        .when(k == 2, F.concat(year, F.lit("-13-01")))
        .when(k == 3, F.concat(year, F.lit("-02-30")))
        .when(k == 4, F.substring(day.cast("string"), 3, 8))
        .when(k == 5, F.concat(day.cast("string"), F.lit(" 00:00")))
        .otherwise(day.cast("string"))
    )
    return feed.select("Trade_ID", text.alias("Date_Text")).withColumn("Is_Valid", is_iso_date(F.col("Date_Text")))


def _orphan_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Breaks of runs that an older state of the run summaries does not know."""
    older = _runs(spark, sf_dir).filter(F.col("Created_At") < F.lit("1996-01-01").cast("timestamp_ntz"))
    return quality.orphan_counts(_breaks(spark, sf_dir).select(C.RUN), older, C.RUN)


def _orphan_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    breaks = _breaks(spark, sf_dir)
    return quality.orphan_counts(resolution_requests(breaks).select("Break_ID"), breaks, "Break_ID")


def _severity_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = _breaks(spark, sf_dir).select(
        F.explode(F.array("Break_Type", F.concat(F.lit("Unlisted "), "Break_Type"))).alias("Break_Type")
    )
    return kinds.distinct().withColumn("Severity", severity_of(F.col("Break_Type")))


# --- aggregates --------------------------------------------------------------------------------------


def _one_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both feeds as a single run."""
    front, back = _feeds(spark, sf_dir)
    everything = F.lit("REC_ALL")
    breaks = detect.all_breaks(front, back).withColumn(C.RUN, everything)
    return summarise.run_summary(
        front.select(everything.alias(C.RUN)), back.select(everything.alias(C.RUN)), breaks
    )


def _backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    front, back = _feeds(spark, sf_dir)
    breaks = runs.detect_runs(front, back, run_id(), as_of(), PERIOD)
    return runs.summarise_runs(front, back, breaks, run_id(), as_of())


def _dimension(name: str, *severities: str, every_copy: bool = False):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        # unique_ids: reconcile_runs has checked the FO feed.
        one = summarise.dimension_summary(
            *_feeds(spark, sf_dir), _breaks_of_period(spark, sf_dir), name, PERIOD, every_copy, unique_ids=True
        )
        return one.select(
            name, "Total_Trades", "Total_Notional", "Total_Breaks", *severities, "Exception_Rate"
        ).orderBy(name)

    return query


def _entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarise.entity_summary(
        *_feeds(spark, sf_dir), _breaks_of_period(spark, sf_dir), run_col=PERIOD, unique_ids=True
    )


def _break_counts(dimension: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return summarise.break_counts(
            _breaks_of_period(spark, sf_dir), *_feeds(spark, sf_dir), dimension, PERIOD
        )

    return query


def _top_counterparties(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _break_counts("Counterparty")(spark, sf_dir)
    return counts.orderBy(F.desc("Total_Breaks"), "Counterparty").limit(10)


def _measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarise.measures(_runs(spark, sf_dir), _breaks(spark, sf_dir), _feeds(spark, sf_dir)[0])


def _timed_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run summaries with an execution time that follows from the data: a millisecond for each FO row."""
    return _runs(spark, sf_dir).withColumn("Execution_Time", F.round(F.col("Front_Count") / 1000, 4))


def _measures_timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = _timed_runs(spark, sf_dir)
    return summarise.measures(timed, _breaks(spark, sf_dir), _feeds(spark, sf_dir)[0])


def _execution_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each recorded run, whether its time was taken and the executive list shows it."""
    recorded = control_tables(spark, sf_dir).read(RUNS)
    shown = reports.executive_kpis(recorded).filter(F.col("Attribute") == "Execution Time")
    texts = F.format_string("%.4f seconds", "Execution_Time")
    return recorded.join(shown.select("Value").distinct(), texts == F.col("Value"), "left").select(
        C.RUN, (F.col("Execution_Time") > 0).alias("Is_Timed"), F.col("Value").isNotNull().alias("Is_Shown")
    )


def _executive_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = _runs(spark, sf_dir).withColumn("Execution_Time", F.lit(0.0))
    return reports.executive_kpis(summarise.latest_run(timed))


# --- injections --------------------------------------------------------------------------------------


def _injected(change: Callable[[DataFrame], DataFrame]):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return change(_bucketed(_feeds(spark, sf_dir)[0])).select(*C.FEED_COLUMNS)

    return query


def _pick(*values):
    """One of the values by fault bucket."""
    return F.get(F.array(*[F.lit(v) for v in values]), (F.col("Fault_Bucket") % len(values)).cast("int"))


def _injections() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    hit = star_feeds.hit
    changes = {
        "inject_missing": lambda f: perturb.drop_rows(f, hit("missing")),
        "inject_unexpected": lambda f: perturb.add_unexpected(f, hit("unexpected"), star_feeds.UNEXPECTED_PREFIX),
        "inject_price": lambda f: perturb.scale_price(f, hit("price"), _pick(1.08, 0.92, 1.15)),
        "inject_quantity": lambda f: perturb.add_to_quantity(f, hit("quantity"), _pick(100, -50, 500)),
        "inject_status": lambda f: perturb.replace_status(f, hit("status")),
        "inject_trade_date": lambda f: perturb.shift_trade_date(f, hit("trade_date"), _pick(1, 2, 3)),
        "inject_settlement_date": lambda f: perturb.shift_settlement_date(
            f, hit("settlement_date"), _pick(2, 3, 4, 5)
        ),
        "inject_currency": lambda f: perturb.replace_currency(f, hit("currency")),
        "inject_duplicates": lambda f: perturb.duplicate_rows(f, hit("duplicate")),
    }
    return {name: _injected(change) for name, change in changes.items()}


def _truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_feeds.injected_truth(_bucketed(_feeds(spark, sf_dir)[0]))


def _feed_columns(feed: DataFrame) -> DataFrame:
    return feed.select(*C.FEED_COLUMNS, PERIOD)


# --- registry ----------------------------------------------------------------------------------------


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _looking_once(query) for name, query in _queries().items()}


def _looking_once(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query, with the source files listed at most once while it is put together, and the shuffles of
    jobs that run meanwhile deleted as they end."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        source = (spark.sparkContext.applicationId, sf_dir)
        _seen[source] = None
        try:
            with short_lived_shuffles(spark):
                return query(spark, sf_dir)
        finally:
            _seen.pop(source, None)

    return run


def _queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    two = _feeds
    dated = _breaks_of_period
    return {
        # feeds
        "front_office_feed": lambda s, d: _feed_columns(star_feeds.front_office(s, d)),
        "back_office_feed": lambda s, d: _feed_columns(star_feeds.back_office(star_feeds.front_office(s, d))),
        "scan_front_office": lambda s, d: two(s, d)[0],
        "scan_back_office": lambda s, d: two(s, d)[1],
        "csv_roundtrip_fo": _csv_roundtrip(FRONT),
        "csv_roundtrip_bo": _csv_roundtrip(BACK),
        "append_feed": _append_feed,
        "replaced_feed": _replaced_feed,
        "cleared_tables": _cleared_tables,
        "refused_inputs": _refused_inputs,
        "trade_lookup": _trade_lookup,
        "table_counts": lambda s, d: control_tables(s, d).counts(),
        "control_status": _control_status,
        "distinct_runs": lambda s, d: _breaks(s, d).select(C.RUN).distinct(),
        "param_query": lambda s, d: tables.select(
            s,
            "SELECT Run_ID, Trade_ID, Break_Type FROM {breaks} WHERE Severity = :severity AND Run_ID >= :first",
            {"severity": "HIGH", "first": "REC_199601"},
            breaks=_breaks(s, d),
        ),
        # detection
        "missing_trades": lambda s, d: detect.missing_trades(*two(s, d)),
        "unexpected_trades": lambda s, d: detect.unexpected_trades(*two(s, d)),
        "duplicate_trades": lambda s, d: detect.duplicate_trades(two(s, d)[1]),
        "price_mismatches": lambda s, d: detect.price_mismatches(*two(s, d)),
        "price_mismatches_narrow_tolerance": lambda s, d: detect.price_mismatches(*two(s, d), tolerance=0.001),
        "price_mismatches_wide_tolerance": lambda s, d: detect.price_mismatches(*two(s, d), tolerance=0.50),
        "price_mismatches_widest_tolerance": lambda s, d: detect.price_mismatches(*two(s, d), tolerance=75.0),
        "quantity_mismatches": lambda s, d: detect.quantity_mismatches(*two(s, d)),
        "status_mismatches": lambda s, d: detect.status_mismatches(*two(s, d)),
        "trade_date_mismatches": lambda s, d: detect.trade_date_mismatches(*two(s, d)),
        "settlement_date_mismatches": lambda s, d: detect.settlement_date_mismatches(*two(s, d)),
        "currency_mismatches": lambda s, d: detect.currency_mismatches(*two(s, d)),
        "all_breaks": lambda s, d: _by_run(detect.all_breaks(*two(s, d), PERIOD)),
        "all_breaks_one_by_one": lambda s, d: _by_run(detect.breaks_one_by_one(*two(s, d), PERIOD)),
        "severity_map": _severity_map,
        # runs
        "run_summary": _one_run,
        "backfill_runs": _backfill,
        "break_history": _break_history,
        "rerun_history": _rerun_history,
        "backfill_changed": _backfill_changed,
        "reconciliation_runs": lambda s, d: summarise.run_history(_runs(s, d)),
        "latest_run": lambda s, d: summarise.latest_run(_runs(s, d)),
        "match_rate_trend": lambda s, d: summarise.match_rate_trend(_runs(s, d)),
        "match_rate_change": lambda s, d: summarise.match_rate_change(_runs(s, d)),
        "volume_trend": lambda s, d: summarise.volume_trend(_runs(s, d)),
        "critical_trend": lambda s, d: summarise.critical_trend(_breaks(s, d)),
        "run_status_bands": lambda s, d: reports.run_status(_runs(s, d)),
        "executive_kpis": _executive_kpis,
        "executive_kpis_timed": lambda s, d: reports.executive_kpis(summarise.latest_run(_timed_runs(s, d))),
        "measures_timed": _measures_timed,
        "execution_times": _execution_times,
        "kpi_cards": lambda s, d: reports.kpi_cards(summarise.latest_run(_runs(s, d))),
        "measures": _measures,
        # enrichment
        "breaks_enriched": _enriched_state,
        "breaks_enriched_fanout": lambda s, d: enrich.enrich(
            dated(s, d), *two(s, d), PERIOD, every_copy=True
        ).drop(PERIOD),
        "star_breaks": lambda s, d: reports.star_breaks(
            _runs(s, d), dated(s, d), two(s, d)[0], PERIOD
        ).drop(PERIOD),
        "recent_breaks": lambda s, d: explore.recent_breaks(
            dated(s, d), *two(s, d), PERIOD, _actions(s, d), runs=_runs(s, d)
        ).drop(PERIOD),
        "top_critical": lambda s, d: explore.top_critical(
            dated(s, d), *two(s, d), PERIOD, _actions(s, d), runs=_runs(s, d)
        ),
        "search_breaks": lambda s, d: explore.search(_enriched(s, d), "nation_7"),
        "filter_breaks": _filtered,
        "filter_breaks_dims": _sliced,
        "break_table": lambda s, d: explore.break_table(_enriched_state(s, d)),
        "filtered_breaks_export": _filtered_extract,
        # summaries
        "desk_summary": _dimension("Desk", *C.SEVERITY_COUNT_COLUMNS.values()),
        "desk_summary_fanout": _dimension("Desk", *C.SEVERITY_COUNT_COLUMNS.values(), every_copy=True),
        "portfolio_summary": _dimension("Portfolio"),
        "counterparty_summary": _dimension("Counterparty", "Critical_Breaks"),
        "asset_class_summary": _dimension("Asset_Class"),
        "entity_summary": _entities,
        "desk_risk": lambda s, d: summarise.desk_risk(
            _dimension("Desk", "Critical_Breaks")(s, d)
        ),
        "top_entities": lambda s, d: explore.top_entities(_entities(s, d)),
        "top_counterparties": _top_counterparties,
        "severity_summary": lambda s, d: summarise.severity_distribution(_breaks(s, d)),
        "break_type_summary": lambda s, d: summarise.break_type_distribution(_breaks(s, d)),
        "severity_exposure": lambda s, d: summarise.severity_exposure(dated(s, d), *two(s, d), PERIOD),
        "exposure_by_counterparty": lambda s, d: summarise.entity_exposure(
            dated(s, d), *two(s, d), "Counterparty", PERIOD
        ),
        "breaks_by_desk": _break_counts("Desk"),
        "breaks_by_asset_class": _break_counts("Asset_Class"),
        # trades
        "trade_details": _details,
        "trade_population": lambda s, d: explore.trade_population(_details(s, d)),
        "search_trades": lambda s, d: explore.search(_details(s, d), "nation_1"),
        "trade_model": lambda s, d: trades.trade_records(_raw_records(s, d)),
        "trade_is_valid": lambda s, d: trades.trade_records(_raw_records(s, d))
        .withColumn("is_valid", trades.is_valid_record())
        .select("trade_id", "quantity", "price", "is_valid"),
        # data quality
        "dq_violations": lambda s, d: quality.violations(_defective(s, d)),
        "dq_invalid_currency": lambda s, d: quality.outside_domain(_defective(s, d), "Currency", C.CURRENCIES),
        "dq_invalid_status": lambda s, d: quality.outside_domain(
            _defective(s, d), "Trade_Status", C.TRADE_STATUSES
        ),
        "dq_duplicate_fo_ids": lambda s, d: quality.duplicate_ids(_defective(s, d)),
        "dq_null_counts": lambda s, d: quality.null_counts(_defective(s, d)),
        "dq_date_format": _date_format,
        "dq_orphan_breaks": _orphan_breaks,
        "dq_orphan_actions": _orphan_actions,
        # resolution
        "resolution_apply": lambda s, d: _state(s, d),
        "resolution_history": lambda s, d: resolution.history(_actions(s, d)),
        "resolution_rejects": lambda s, d: resolution.rejected(_judged(s, d)).select(
            "Break_ID", "New_Status", "Reject_Reason", "Created_At", "Action_Seq"
        ),
        # reports
        "report_input": lambda s, d: reports.report_input(_runs(s, d), _breaks(s, d)),
        "breaks_by_category_extract": _category_extract,
        "breaks_json": _breaks_json,
        "run_audit_json": _run_audit_json,
        "json_document": _json_document,
        "summary_extract": _summary_extract,
        "analytics_export": _analytics_export,
        **{f"analytics_export_{name}": _exported_rows(name) for name in C.DATASETS},
        **{f"analytics_export_{name}_in_order": _exported_rows(f"{name}_in_order") for name in reports.EXPORT_ORDER},
        # injection
        **_injections(),
        "injected_truth": _truth,
        "injected_counts": lambda s, d: perturb.injected_counts(_truth(s, d)),
    }
