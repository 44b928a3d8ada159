"""Search, facets and top-k over breaks and trades."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from breakwater import constants as C
from breakwater.functions import contains_text
from breakwater.operators.enrich import enrich
from breakwater.operators.resolution import current_state
from breakwater.operators.summarise import total_breaks
from breakwater.sources.shared import shared_dir

SEARCHED = ["Trade_ID", "Trader", "Counterparty", "Symbol"]
ANY = "ALL"


def search(df: DataFrame, text: str) -> DataFrame:
    """Rows whose id, trader, counterparty or symbol contains the text, in any case."""
    return df.filter(contains_text(text, SEARCHED))


def filter_breaks(
    breaks: DataFrame, text: str = "", severity: str = ANY, break_type: str = ANY, resolution: str = ANY
) -> DataFrame:
    """Facets of the break explorer; ``ALL`` leaves a facet open."""
    out = search(breaks, text) if text else breaks
    if severity != ANY:
        out = out.filter(F.col("Severity") == severity)
    if break_type != ANY:
        out = out.filter(F.col("Break_Type") == break_type)
    if resolution != ANY:
        out = out.filter(F.coalesce(F.col("Resolution_Status"), F.lit("UNRESOLVED")) == resolution)
    return out


def slice_breaks(
    breaks: DataFrame,
    from_date: date | str | None = None,
    to_date: date | str | None = None,
    **selected: Sequence[str],
) -> DataFrame:
    """Slicers of the exception page: a run date range and lists of wanted values per column."""
    out = breaks
    if from_date is not None:
        out = out.filter(F.to_date("Detected_At") >= F.lit(str(from_date)).cast("date"))
    if to_date is not None:
        out = out.filter(F.to_date("Detected_At") <= F.lit(str(to_date)).cast("date"))
    for column, values in selected.items():
        out = out.filter(F.col(column).isin(list(values)))
    return out


def _first(breaks: DataFrame, order: Sequence[Column], limit: int) -> DataFrame:
    """The first rows in a total order, written down: several joins read them, the breaks are sorted once."""
    shared_dir(breaks.sparkSession)
    return breaks.orderBy(*order).limit(limit).checkpoint()


def _with_state(few: DataFrame, actions: DataFrame | None) -> DataFrame:
    """Resolution state of a limited number of breaks."""
    if actions is not None:
        theirs = actions.join(F.broadcast(few.select("Break_ID")), ["Break_ID"], "left_semi")
        return current_state(few, theirs, policy=None)
    return few.withColumn("Resolution_Status", F.lit(C.RESOLUTION_STATUSES[0]))


def _of_first_runs(breaks: DataFrame, runs: DataFrame, count: Column, limit: int, newest: bool) -> DataFrame:
    """Breaks of the newest (or oldest) runs that hold ``limit`` of them according to their summaries,
    with all runs of the last time stamp. The run ids prune the partitions of the history.

    At most ``limit`` time stamps are looked at, as only runs with such breaks count.
    """
    stamps = (
        runs.select("Created_At", C.RUN, count.alias("_n"))
        .filter(F.col("_n") > 0)
        .groupBy("Created_At")
        .agg(F.sum("_n").alias("_n"), F.collect_list(C.RUN).alias("_runs"))
        .orderBy(F.desc("Created_At") if newest else F.asc("Created_At"))
        .limit(limit)
    )
    chosen, have = [], 0
    for row in stamps.collect():
        if have < limit:
            chosen, have = chosen + row["_runs"], have + row["_n"]
    return breaks.filter(F.col(C.RUN).isin(chosen))


def recent_breaks(
    breaks: DataFrame,
    front: DataFrame,
    back: DataFrame,
    run_col: str | None = None,
    actions: DataFrame | None = None,
    limit: int = 500,
    runs: DataFrame | None = None,
) -> DataFrame:
    """The newest breaks with their trade attributes. The limit comes first, so few trades are looked up.

    ``runs`` are the summaries of the runs the breaks belong to, with the time of detection as
    ``Created_At``: they tell which runs hold the newest breaks, so that no others are read.
    """
    newest_first = [F.desc("Detected_At"), F.desc("Break_ID")]
    if runs is not None:
        breaks = _of_first_runs(breaks, runs, total_breaks(), limit, newest=True)
    newest = _with_state(_first(breaks, newest_first, limit), actions)
    return enrich(newest, front, back, run_col, policy=None).orderBy(*newest_first)


def trade_population(details: DataFrame, limit: int = 500) -> DataFrame:
    return details.orderBy("Trade_ID").limit(limit)


def top_critical(
    breaks: DataFrame,
    front: DataFrame,
    back: DataFrame,
    run_col: str | None = None,
    actions: DataFrame | None = None,
    limit: int = 8,
    runs: DataFrame | None = None,
) -> DataFrame:
    """The first CRITICAL breaks; only where there are none, the first breaks of any severity.

    ``runs`` as for ``recent_breaks``.
    """
    critical = F.col("Severity") == "CRITICAL"
    if runs is not None:
        only = runs.filter(F.col("Critical_Breaks") > 0)
        if only.isEmpty():
            breaks = _of_first_runs(breaks, runs, total_breaks(), limit, newest=False)
        else:
            breaks = _of_first_runs(breaks, only, F.col("Critical_Breaks"), limit, newest=False)
    order = [F.when(critical, 0).otherwise(1), F.col("Detected_At"), F.col("Break_ID")]
    first = _first(breaks, order, limit)
    # Sorted like this, one CRITICAL row among the few proves the fallback unnecessary.
    any_critical = F.max(critical).over(Window.partitionBy(F.lit(0)))
    chosen = first.withColumn("_any", any_critical).filter(critical | ~F.col("_any")).drop("_any")
    return enrich(_with_state(chosen, actions), front, back, run_col, policy=None).select(
        "Break_ID", "Trade_ID", "Desk", "Counterparty", "Break_Type", "Severity", "Resolution_Status"
    )


def top_entities(entities: DataFrame, limit: int = 10) -> DataFrame:
    """Entities of all dimensions with the most breaks."""
    return (
        entities.select(
            "Dimension", "Entity", "Total_Trades", "Total_Breaks", "Critical_Breaks", "Exception_Rate"
        )
        .orderBy(F.desc("Total_Breaks"), "Dimension", "Entity")
        .limit(limit)
    )


def break_table(enriched: DataFrame) -> DataFrame:
    """Rows as the exception table shows them: a dash for absent values, words instead of codes."""
    status = F.coalesce(F.col("Resolution_Status"), F.lit(C.RESOLUTION_STATUSES[0]))
    return enriched.select(
        "Break_ID",
        C.RUN,
        "Trade_ID",
        "Severity",
        "Break_Type",
        F.coalesce("Expected_Value", F.lit("-")).alias("Expected_Value"),
        F.coalesce("Actual_Value", F.lit("-")).alias("Actual_Value"),
        "Desk",
        "Counterparty",
        "Asset_Class",
        F.replace(status, F.lit("_"), F.lit(" ")).alias("Resolution_Status"),
        F.date_format("Detected_At", "yyyy-MM-dd").alias("Detected_On"),
    )


def filtered_extract(enriched: DataFrame) -> DataFrame:
    """The column set of the break-explorer extract."""
    rows = enriched.withColumn("Field_Name", F.lit(None).cast("string"))
    return rows.select(*C.FILTERED_EXTRACT_COLUMNS)
