"""Reconciliation runs: one run over a pair of feeds, or many periods in a single job."""

from __future__ import annotations

import time
import uuid
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from breakwater import constants as C
from breakwater.functions import break_id
from breakwater.operators import quality
from breakwater.operators.detect import all_breaks, field_rules
from breakwater.operators.summarise import run_summary, summary_of
from breakwater.sources.shared import shared_dir, short_lived_shuffles
from breakwater.sources.tables import BACK, FRONT, INPUTS, RUNS, SCHEMAS, ControlTables

#: Feed columns that decide about breaks.
COMPARED = ["Trade_ID", *[rule.column for rule in field_rules()]]
#: Feed rows of both sides that are compared at once where periods can be read alone, about; what their
#: comparison shuffles lies on disk meanwhile. A larger period is compared on its own.
ROWS_AT_ONCE = 32_000_000
#: What is known of a period's last run, under names that keep apart from what is true now.
_KNOWN = {f"_{f.name}": f.dataType for f in SCHEMAS[INPUTS] if f.name != "Period"}


def new_run_id(now: datetime | None = None) -> str:
    return f"REC_{(now or datetime.now(timezone.utc)):%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:6]}"


def identified(breaks: DataFrame, run_id: Column, detected_at: Column) -> DataFrame:
    """Break rows with their run, their key and the time they were detected."""
    parts = [F.col(c) for c in (C.RUN, "Trade_ID", "Break_Type", "Expected_Value", "Actual_Value")]
    return breaks.withColumn(C.RUN, run_id).withColumns({"Break_ID": break_id(*parts), "Detected_At": detected_at})


def detect_runs(
    front: DataFrame,
    back: DataFrame,
    run_id: Column,
    detected_at: Column,
    run_col: str | None = None,
    price_tolerance: float = C.PRICE_TOLERANCE,
) -> DataFrame:
    """Breaks of every run in the feeds.

    ``run_col`` is the feed column that tells the runs apart; ``run_id`` is computed from it, and
    ``detected_at`` from ``Run_ID``. Both are worked out on the breaks, not on the feeds.
    """
    return identified(all_breaks(front, back, run_col, field_rules(price_tolerance)), run_id, detected_at)


def _batches(feeds: tuple[DataFrame, DataFrame], period: str, rows_at_once: int) -> list[Column]:
    """Conditions that deal all rows of the feeds out by whole periods."""
    both = feeds[0].select(period).unionByName(feeds[1].select(period))
    with short_lived_shuffles(feeds[0].sparkSession):
        sizes = both.groupBy(period).agg(F.count(F.lit(1)).alias("_n")).collect()  # one row per folder
    batches, room = [], 0
    for value, rows in sorted(sizes, key=lambda r: (r[0] is not None, r[0] or 0)):
        if rows > room:
            batches.append([])
            room = max(rows_at_once, rows)
        batches[-1].append(value)
        room -= rows
    named = [([v for v in batch if v is not None], None in batch) for batch in batches]
    # NULL is told apart, as it is in no list.
    return [F.coalesce(F.col(period).isin(values), F.lit(unnamed)) for values, unnamed in named]


def store_detected(
    tables: ControlTables,
    feeds: tuple[DataFrame, DataFrame],
    run_id: Column,
    as_of: Column,
    attempt: str,
    run_col: str | None = None,
    price_tolerance: float = C.PRICE_TOLERANCE,
    rows_at_once: int | None = None,
) -> DataFrame:
    """Writes the breaks of the feeds' runs under an attempt and returns them as written.

    Runs that are the periods of the tables are compared in batches of whole periods, one after the other:
    every period is read once, and the shuffles of a batch are gone before the next begins.
    """
    by_period = run_col is not None and run_col == tables.period
    batches = _batches(feeds, run_col, rows_at_once or ROWS_AT_ONCE) if by_period else []
    if len(batches) < 2:
        return tables.store_breaks(detect_runs(*feeds, run_id, as_of, run_col, price_tolerance), attempt)
    for batch in batches:
        front, back = [feed.filter(batch) for feed in feeds]
        stored = tables.store_breaks(detect_runs(front, back, run_id, as_of, run_col, price_tolerance), attempt)
    return stored


def summarise_runs(
    front: DataFrame,
    back: DataFrame,
    breaks: DataFrame,
    run_id: Column,
    created_at: Column,
) -> DataFrame:
    """Run summaries of the feeds, whose rows give ``run_id``; ``breaks`` carry theirs."""
    front, back = [feed.select(run_id.alias(C.RUN)) for feed in (front, back)]
    return run_summary(front, back, breaks).withColumn("Created_At", created_at)


def _sizes(run_id: Column, front: DataFrame, back: DataFrame, *digest: Column) -> DataFrame:
    """(run, Front_Count, Back_Count) of the feeds, and a digest of each side's rows: one row per run, written down."""
    parts = []
    for feed, side in ((front, "Front"), (back, "Back")):
        own = F.sum(F.xxhash64(*digest).cast("decimal(20,0)")) if digest else F.lit(None)
        named = feed.withColumn(C.RUN, run_id).groupBy(C.RUN)
        parts.append(named.agg(F.count(F.lit(1)).alias(f"{side}_Count"), own.cast("decimal(38,0)").alias(f"{side}_Digest")))
    both = parts[0].unionByName(parts[1], allowMissingColumns=True)
    columns = ["Front_Count", "Back_Count", "Front_Digest", "Back_Digest"]
    shared_dir(front.sparkSession)
    with short_lived_shuffles(front.sparkSession):
        return both.groupBy(C.RUN).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in columns]).checkpoint()


def _require_sizes(sizes: DataFrame) -> None:
    """Refuses feeds without rows."""
    with short_lived_shuffles(sizes.sparkSession):
        rows = sizes.agg(F.sum("Front_Count"), F.sum("Back_Count")).first()
    for count, table in zip(rows, (FRONT, BACK), strict=True):
        if not count:
            raise quality.FeedRejected(f"{table}: no rows")


def _record(
    tables: ControlTables,
    feeds: tuple[DataFrame, DataFrame],
    sizes: DataFrame,
    run_id: Column,
    as_of: Column,
    run_col: str | None,
    price_tolerance: float,
    inputs: DataFrame | None = None,
) -> None:
    """Detects the breaks of the feeds' runs and records them with their summaries, in one attempt."""
    started = time.perf_counter()
    checked = tables.require_new_runs(sizes)
    attempt = tables.begin()
    stored = store_detected(tables, feeds, run_id, as_of, attempt, run_col, price_tolerance)
    counts = sizes.select(C.RUN, "Front_Count", "Back_Count")
    summary = summary_of([counts], stored).withColumn("Created_At", as_of)
    elapsed = round(time.perf_counter() - started, 4)
    tables.store_runs(summary.withColumn("Execution_Time", F.lit(elapsed)), attempt)
    if inputs is not None:
        tables.store_inputs(inputs, attempt)
    tables.publish(attempt, checked)


def reconcile_runs(
    tables: ControlTables,
    run_id: Column,
    as_of: Column,
    run_col: str | None = None,
    price_tolerance: float = C.PRICE_TOLERANCE,
    ids_checked: bool = False,
) -> None:
    """Reconciles the loaded feeds and records breaks and summaries.

    One job covers as many runs as ``run_col`` has values. Nothing is recorded if a run is on record
    by the time the job ends, or a row belongs to none. Breaks are written first and the summaries
    are computed from them, so the detection runs once; all of it counts from the moment the
    attempt is published, and a lost job leaves nothing that is seen. ``ids_checked`` says that the FO
    ids are known to be unique, which saves a shuffle.
    """
    feeds = tables.read(FRONT), tables.read(BACK)
    if not ids_checked:
        quality.require_unique_ids(feeds[0], FRONT, run_col)
    sizes = _sizes(run_id, *feeds)
    _require_sizes(sizes)
    _record(tables, feeds, sizes, run_id, as_of, run_col, price_tolerance)


def reconcile_changed(
    tables: ControlTables,
    run_id: Column,
    as_of: Column,
    price_tolerance: float = C.PRICE_TOLERANCE,
    ids_checked: bool = False,
) -> list[int]:
    """Reconciles the periods whose feeds differ from those of their last run; returns these periods.

    A period whose files are the ones of its last run is not read. One with other files is read
    for a digest of its rows (of the columns that are compared, in any order); if the rows turn out to be the same, only the names of the files
    are noted. ``run_id`` has to give new names, as runs stay on record. Another tolerance makes
    all periods count as changed. Periods that have left the feeds are not looked at.
    """
    period = tables.period
    if not period:
        raise ValueError("the feeds have no periods")
    now = tables.feed_files(FRONT).withColumnRenamed("Files", "Front_Files").join(
        tables.feed_files(BACK).withColumnRenamed("Files", "Back_Files"), ["Period"], "full"
    )
    shared_dir(tables.spark)
    files = ["Front_Files", "Back_Files"]
    known = now.select("Period", *[F.lit(None).cast(t).alias(c) for c, t in _KNOWN.items()]).limit(0)
    if tables.exists(INPUTS):
        known = tables.latest_inputs().select("Period", *[F.col(c.removeprefix("_")).alias(c) for c in _KNOWN])
    state = now.join(known, ["Period"], "left").checkpoint()  # one row per period
    same_files = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in files])
    same_rule = F.col("_Price_Tolerance").eqNullSafe(F.lit(float(price_tolerance)))
    looked_at = [r[0] for r in state.filter(~(same_files & same_rule)).select("Period").collect()]
    if None in looked_at:
        raise ValueError("a feed has rows without a run")
    if not looked_at:
        return []
    of_these = F.col(period).isin(looked_at)
    feeds = [tables.read(t).filter(of_these) for t in (FRONT, BACK)]
    sizes = _sizes(run_id, *feeds, *[F.col(c) for c in COMPARED])
    by_period = sizes.join(_periods(run_id, *feeds, period), [C.RUN])
    joined = by_period.join(state, ["Period"]).withColumn("Price_Tolerance", F.lit(float(price_tolerance)))
    same_rows = reduce(
        Column.__and__, [F.col(f"{s}_Digest").eqNullSafe(F.col(f"_{s}_Digest")) for s in ("Front", "Back")]
    )
    judged = joined.withColumn("_same", same_rows & same_rule).checkpoint()
    changed = sorted(r[0] for r in judged.filter(~F.col("_same")).select("Period").collect())
    # The same rows in other files: the last run stays the one that counts for the period.
    noted = judged.withColumn(C.RUN, F.when(F.col("_same"), F.col("_Run_ID")).otherwise(F.col(C.RUN)))
    if not changed:
        attempt = tables.begin()
        tables.store_runs(tables.spark.createDataFrame([], SCHEMAS[RUNS]), attempt)
        tables.store_inputs(noted, attempt)
        tables.publish(attempt)
        return []
    feeds = [tables.read(t).filter(F.col(period).isin(changed)) for t in (FRONT, BACK)]
    if not ids_checked:
        quality.require_unique_ids(feeds[0], FRONT, period)
    new = judged.filter(~F.col("_same")).select(*sizes.columns)
    _record(tables, tuple(feeds), new, run_id, as_of, period, price_tolerance, noted)
    return changed


def _periods(run_id: Column, front: DataFrame, back: DataFrame, period: str) -> DataFrame:
    """Which period each run belongs to."""
    found = front.select(period).unionByName(back.select(period)).distinct()
    return found.select(run_id.alias(C.RUN), F.col(period).alias("Period"))


def reconcile(
    tables: ControlTables,
    run_id: str | None = None,
    as_of: datetime | None = None,
    price_tolerance: float = C.PRICE_TOLERANCE,
) -> str:
    """One run over the loaded feeds; returns its id."""
    now = as_of or datetime.now(timezone.utc)
    run_id = run_id or new_run_id(now)
    stamp = F.lit(f"{now:%Y-%m-%d %H:%M:%S}").cast("timestamp_ntz")
    reconcile_runs(tables, F.lit(run_id), stamp, price_tolerance=price_tolerance)
    return run_id
