"""The control tables: feeds, break history, run summaries and the resolution log, as Parquet."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from breakwater import constants as C
from breakwater.operators import quality
from breakwater.sources.commits import CLEARED, Commits, standing
from breakwater.sources.files import read_feed_csv
from breakwater.sources.shared import delete, file_system, short_lived_shuffles

FRONT, BACK = "front_office_trades", "back_office_trades"
BREAKS, RUNS, ACTIONS = "reconciliation_breaks", "reconciliation_summary", "break_resolutions_history"
#: What the feeds held when a period was reconciled, and the list of attempts that count.
INPUTS, COMMITS = "reconciliation_inputs", "reconciliation_commits"
#: Tables whose rows belong to an attempt at recording runs.
HISTORY = (BREAKS, RUNS, INPUTS)
ATTEMPT = "Attempt"
#: Hints for finding a trade by its id: a small filter of each file's ids, in the size that fits.
ID_FILTERS = {
    "parquet.bloom.filter.enabled#Trade_ID": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
}
#: The tables are kept for long and copied, so they are packed tightly.
PACKED = {"compression": "zstd"}

_TEXT, _LONG, _DOUBLE, _TIME = T.StringType(), T.LongType(), T.DoubleType(), T.TimestampNTZType()
_DIGEST = T.DecimalType(38, 0)


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


SCHEMAS = {
    BREAKS: _schema(
        Break_ID=_TEXT,
        Trade_ID=_TEXT,
        Break_Type=_TEXT,
        Expected_Value=_TEXT,
        Actual_Value=_TEXT,
        Severity=_TEXT,
        Detected_At=_TIME,
        Run_ID=_TEXT,
    ),
    RUNS: _schema(
        Run_ID=_TEXT,
        Execution_Time=_DOUBLE,
        Front_Count=_LONG,
        Back_Count=_LONG,
        Matched_Count=_LONG,
        **{c: _LONG for c in C.RUN_COUNT_COLUMNS.values()},
        **{c: _LONG for c in C.SEVERITY_COUNT_COLUMNS.values()},
        Match_Percentage=_DOUBLE,
        Created_At=_TIME,
    ),
    INPUTS: _schema(
        Run_ID=_TEXT,
        Period=T.IntegerType(),
        Price_Tolerance=_DOUBLE,
        Front_Files=_DIGEST,
        Back_Files=_DIGEST,
        Front_Digest=_DIGEST,
        Back_Digest=_DIGEST,
    ),
    ACTIONS: _schema(
        Break_ID=_TEXT,
        Trade_ID=_TEXT,
        New_Status=_TEXT,
        Reason=_TEXT,
        Action_By=_TEXT,
        Notes=_TEXT,
        Created_At=_TIME,
        Action_Seq=T.IntegerType(),
    ),
}


@dataclass(frozen=True)
class ControlTables:
    """The tables below one root folder. ``period`` names the feed column that tells runs apart, if any.

    Feeds with a period have a folder for each, so that a period can be read or replaced alone. Runs
    are recorded in attempts: rows are written under a name of their own, seen by nobody, until the
    attempt is published as a whole.
    """

    spark: SparkSession
    root: str
    period: str | None = None

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    @property
    def commits(self) -> Commits:
        return Commits(self.spark, self.path(COMMITS))

    def _feed_schema(self) -> T.StructType:
        fields = list(C.FEED_SCHEMA.fields)
        return T.StructType(fields + ([T.StructField(self.period, T.IntegerType())] if self.period else []))

    def read(self, table: str) -> DataFrame:
        """A table; of the history, the rows of published attempts."""
        return self._of_attempts(table, self.commits.attempts()) if table in HISTORY else self._stored(table)

    def _stored(self, table: str) -> DataFrame:
        schema = SCHEMAS.get(table) or self._feed_schema()
        if table in HISTORY:
            schema = T.StructType([*schema.fields, T.StructField(ATTEMPT, _TEXT)])
        return self.spark.read.schema(schema).parquet(self.path(table))

    def _of_attempts(self, table: str, attempts: Sequence[str]) -> DataFrame:
        # One attempt is one job, so the list is short; it prunes folders.
        return self._stored(table).filter(F.col(ATTEMPT).isin(list(attempts))).drop(ATTEMPT)

    def _of_attempt(self, table: str, attempt: str) -> DataFrame:
        """The same for one attempt, without a look at the folders of others."""
        path = f"{self.path(table)}/{ATTEMPT}={attempt}"
        fs, folder = file_system(self.spark, path)
        if not fs.exists(folder):  # no rows, no folder
            return self.spark.createDataFrame([], SCHEMAS[table])
        return self.spark.read.schema(SCHEMAS[table]).option("basePath", path).parquet(path)

    def exists(self, table: str) -> bool:
        try:
            self._stored(table)
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return False
            raise
        return True

    def row_count(self, table: str) -> int:
        return self.read(table).count() if self.exists(table) else 0

    # --- feeds ------------------------------------------------------------------------------------

    def load_feed(self, feed: DataFrame, table: str) -> None:
        """Replaces a feed. The new rows are checked first, so a bad feed leaves the old one in place."""
        self._require_loadable(feed, table)
        self.replace_feed(feed, table)

    def load_feed_csv(self, path: str, table: str) -> int:
        self.load_feed(read_feed_csv(self.spark, path), table)
        return self.row_count(table)

    def load_periods(self, feed: DataFrame, table: str) -> None:
        """Replaces the periods that the rows belong to; all other periods stay as they are."""
        if not self.period:
            raise ValueError("the feeds have no periods")
        self._require_loadable(feed, table)
        self._write_feed(feed, table, "overwrite", partitionOverwriteMode="dynamic")

    def _require_loadable(self, feed: DataFrame, table: str) -> None:
        quality.require_valid(feed, table)
        if table == FRONT:
            quality.require_unique_ids(feed, table, self.period)

    def replace_feed(self, feed: DataFrame, table: str, in_order: bool = False) -> None:
        """Writes a feed as it is. ``in_order``: its rows already lie together by period and id."""
        self._write_feed(feed, table, "overwrite", in_order, partitionOverwriteMode="static")

    def replace_feed_by_parts(self, parts: Iterable[DataFrame], table: str) -> None:
        """Writes a feed that comes in parts, one after the other: the shuffles of one part are gone
        before the next begins."""
        for k, part in enumerate(parts):
            if k:
                self._write_feed(part, table, "append")
            else:
                self.replace_feed(part, table)

    def append_feed(self, feed: DataFrame, table: str) -> None:
        """Adds rows to a feed; FO ids have to stay unique."""
        quality.require_valid(feed, table)
        if table == FRONT:
            keys = [self.period, "Trade_ID"] if self.period else ["Trade_ID"]
            ids = feed.select(*keys)
            if self.exists(table):
                ids = ids.unionByName(self.read(table).select(*keys))
            quality.require_unique_ids(ids, table, self.period)
        self._write_feed(feed, table, "append")

    def _write_feed(self, feed: DataFrame, table: str, mode: str, in_order: bool = False, **options: str) -> None:
        rows = feed.select(*self._feed_schema().names)
        keys = [self.period] if self.period else []
        if not in_order:
            # Rebalancing splits a period that is too large for one file and merges small ones. Ids
            # lie in order, so that a search for one skips row groups.
            if keys:
                rows = rows.hint("rebalance", *keys)
            rows = rows.sortWithinPartitions(*keys, "Trade_ID")
        writer = rows.write.mode(mode).options(**ID_FILTERS, **PACKED, **options)
        with short_lived_shuffles(self.spark):
            (writer.partitionBy(*keys) if keys else writer).parquet(self.path(table))

    # --- history ----------------------------------------------------------------------------------

    def require_new_runs(self, ids: DataFrame) -> int:
        """Refuses rows without a run, and runs that are already recorded. Returns the number of
        commits that were looked at."""
        if not ids.filter(F.col(C.RUN).isNull()).isEmpty():
            raise ValueError("a feed has rows without a run")
        return self._require_unrecorded(ids)

    def _require_unrecorded(self, ids: DataFrame) -> int:
        entries = self.commits.entries()
        known = standing(entries)
        if known and self.exists(RUNS):
            recorded = self._of_attempts(RUNS, known).select(C.RUN)
            taken = ids.join(recorded, [C.RUN], "left_semi").take(1)
            if taken:
                raise ValueError(f"run {taken[0][0]} is already recorded")
        return len(entries)

    @staticmethod
    def begin() -> str:
        """The name of a new attempt at recording runs."""
        return f"attempt-{uuid.uuid4().hex}"

    def store_breaks(self, breaks: DataFrame, attempt: str) -> DataFrame:
        """Writes the breaks of an attempt; nobody sees them before it is published. Returns them as
        written."""
        rows = breaks.select(*SCHEMAS[BREAKS].names).withColumn(ATTEMPT, F.lit(attempt))
        # Large runs are split, small ones share tasks.
        writer = rows.hint("rebalance", C.RUN).write.mode("append").options(**PACKED)
        with short_lived_shuffles(self.spark):
            writer.partitionBy(ATTEMPT, C.RUN).parquet(self.path(BREAKS))
        return self._of_attempt(BREAKS, attempt)

    def store_runs(self, runs: DataFrame, attempt: str) -> DataFrame:
        """Writes the run summaries of an attempt, one row per run."""
        return self._store(runs, RUNS, attempt)

    def store_inputs(self, inputs: DataFrame, attempt: str) -> DataFrame:
        """Writes what the feeds held when the attempt reconciled them."""
        return self._store(inputs, INPUTS, attempt)

    def _store(self, rows: DataFrame, table: str, attempt: str) -> DataFrame:
        named = rows.select(*SCHEMAS[table].names).withColumn(ATTEMPT, F.lit(attempt))
        with short_lived_shuffles(self.spark):
            named.write.mode("append").options(**PACKED).partitionBy(ATTEMPT).parquet(self.path(table))
        return self._of_attempt(table, attempt)

    def publish(self, attempt: str, checked: int = 0) -> None:
        """Makes the rows of an attempt count, all at once. Refuses if one of its runs is recorded.

        ``checked`` commits are known to hold none of its runs. Of two jobs on the same run
        the second one to publish is refused, however they were interleaved; its rows
        stay unseen, see ``drop_unpublished``.
        """
        own = self._of_attempt(RUNS, attempt).select(C.RUN)
        while True:
            if checked < len(self.commits.entries()):
                checked = self._require_unrecorded(own)
            if self.commits.publish(attempt, checked):
                return

    def latest_inputs(self) -> DataFrame:
        """What the feeds held when each period was last reconciled: one row per period."""
        attempts = self.commits.attempts()
        order = self.spark.createDataFrame(list(enumerate(attempts)), f"_at int, {ATTEMPT} string")
        rows = self._stored(INPUTS).join(F.broadcast(order), [ATTEMPT])  # a row per job, see _of_attempts
        columns = SCHEMAS[INPUTS].names
        newest = F.max_by(F.struct(*columns), F.struct("_at", C.RUN)).alias("_r")
        return rows.groupBy(F.col("Period").alias("_p")).agg(newest).select("_r.*")

    def feed_files(self, table: str) -> DataFrame:
        """(Period, Files): a digest of names, sizes and times of each period's files, without reading them."""
        listed = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(self.path(table))
        # An integer period can't be NULL here: rows without one belong to no run.
        period = F.regexp_extract("path", f"/{self.period}=([0-9-]+)/", 1).try_cast("int")
        found = F.xxhash64("path", "modificationTime", "length").cast("decimal(20,0)")
        return listed.groupBy(period.alias("Period")).agg(F.sum(found).cast(_DIGEST).alias("Files"))

    def store_actions(self, actions: DataFrame) -> None:
        writer = actions.select(*SCHEMAS[ACTIONS].names).write.mode("append").options(**PACKED)
        with short_lived_shuffles(self.spark):
            writer.parquet(self.path(ACTIONS))

    # --- upkeep -----------------------------------------------------------------------------------

    def clear(self) -> None:
        """Empties feeds, breaks and summaries. The resolution log is an audit trail and stays."""
        for table in (FRONT, BACK):
            if self.exists(table):
                self.replace_feed(self.spark.createDataFrame([], self._feed_schema()), table)
        before = self.commits.entries()
        while standing(before) and not self.commits.publish(CLEARED, len(before)):
            before = self.commits.entries()
        for attempt in before:
            self._drop(attempt)

    def drop_unpublished(self, before: datetime) -> list[str]:
        """Deletes what attempts have written that were not published and ended before a time (in
        the session's time zone of the driver); returns their names. Jobs that may still be running have to be left out by that time."""
        published = set(self.commits.entries())
        found: dict[str, float] = {}
        for table in HISTORY:
            fs, folder = file_system(self.spark, self.path(table))
            for status in fs.listStatus(folder) if fs.exists(folder) else []:
                name = status.getPath().getName().removeprefix(f"{ATTEMPT}=")
                if status.isDirectory() and name.startswith("attempt-"):
                    found[name] = max(found.get(name, 0.0), status.getModificationTime() / 1000)
        lost = sorted(a for a, at in found.items() if a not in published and at < before.timestamp())
        for attempt in lost:
            self._drop(attempt)
        return lost

    def _drop(self, attempt: str) -> None:
        if attempt != CLEARED:
            for table in HISTORY:
                delete(self.spark, f"{self.path(table)}/{ATTEMPT}={attempt}")

    def counts(self) -> DataFrame:
        """(Table_Name, Row_Count) of all five tables; 0 for one that is not there."""
        parts = []
        for table in (FRONT, BACK, BREAKS, RUNS, ACTIONS):
            rows = self.read(table) if self.exists(table) else self.spark.createDataFrame([], "a int")
            parts.append(rows.agg(F.count(F.lit(1)).alias("Row_Count")).select(F.lit(table).alias("Table_Name"), "Row_Count"))
        return reduce(DataFrame.unionByName, parts)


def lookup(table: DataFrame, trade_id) -> DataFrame:
    """One row of a trade, found by id."""
    return table.filter(F.col("Trade_ID") == trade_id).limit(1)


def select(spark: SparkSession, sql: str, params: dict | None = None, **frames: DataFrame) -> DataFrame:
    """A parameterised SELECT; frames are named in braces, values as ``:name``."""
    return spark.sql(sql, args=params or {}, **frames)
