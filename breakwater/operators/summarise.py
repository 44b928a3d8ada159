"""Aggregates over breaks, trades and runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from breakwater import constants as C
from breakwater.functions import notional, percent, severity_rank, to_money
from breakwater.operators.enrich import known_attributes
from breakwater.operators.skew import ROWS_PER_SLICE, sliced_lag


def _count_if(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


# --- dimensions -----------------------------------------------------------------------------------


def _per_trade(breaks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Break counts per trade, the form in which breaks travel to the feeds."""
    return breaks.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("Total_Breaks"),
        *[_count_if(F.col("Severity") == s).alias(c) for s, c in C.SEVERITY_COUNT_COLUMNS.items()],
    )


def _keys(run_col: str | None) -> list[str]:
    return [run_col, "Trade_ID"] if run_col else ["Trade_ID"]


def entity_summary(
    front: DataFrame,
    back: DataFrame,
    breaks: DataFrame,
    dimensions: Sequence[str] = tuple(C.DIMENSIONS),
    run_col: str | None = None,
    every_copy: bool = False,
    unique_ids: bool = False,
) -> DataFrame:
    """Trades, notional, breaks and exception rate per (Dimension, Entity), all dimensions in one pass.

    Breaks are counted per trade before they meet the feeds, and each side is aggregated before the
    two are joined, so repeated BO rows inflate nothing and no id is too frequent. Entities come
    from the FO feed. ``every_copy`` counts a break once per BO row of its trade.

    Trades are counted distinct per run. ``unique_ids`` states that the FO feed has passed the
    uniqueness check (``quality.duplicate_ids``): its rows are then simply counted, which combines
    map-side and shuffles no trade at all.
    """
    dimensions = list(dimensions)
    keys = _keys(run_col)
    counts = ["Total_Breaks", *C.SEVERITY_COUNT_COLUMNS.values()]
    pairs = F.array(*[F.struct(F.lit(d).alias("Dimension"), F.col(d).alias("Entity")) for d in dimensions])

    def by_entity(df: DataFrame, columns: Sequence[str]):
        return df.select(F.explode(pairs).alias("_e"), *columns).groupBy(
            F.col("_e.Dimension").alias("Dimension"), F.col("_e.Entity").alias("Entity")
        )

    def trades_counted(rows_are_trades: bool) -> Column:
        if rows_are_trades:
            return F.count("Trade_ID")
        return F.count_distinct(F.when(F.col("Trade_ID").isNotNull(), F.struct(*keys)))

    trades = by_entity(
        front.withColumn("_notional", notional(F.col("Quantity"), F.col("Price"))), [*keys, "_notional"]
    ).agg(trades_counted(unique_ids).alias("Total_Trades"), F.sum("_notional").alias("_notional"))

    known = known_attributes(breaks, front, back, run_col, dimensions, every_copy=every_copy)
    hit = _per_trade(breaks, keys).join(known, keys, "left")
    if every_copy:
        hit = hit.select(*keys, *dimensions, *[(F.col(c) * F.col("Row_Copies")).alias(c) for c in counts])
    affected = by_entity(hit, [*keys, *counts]).agg(
        *[F.sum(c).alias(c) for c in counts],
        trades_counted(unique_ids and not every_copy).alias("Affected_Trades"),
    )
    zero = F.lit(0).cast("long")
    # Two aggregates, one row per entity each.
    return trades.join(affected, ["Dimension", "Entity"], "left").select(
        "Dimension",
        "Entity",
        "Total_Trades",
        to_money(F.col("_notional")).alias("Total_Notional"),
        *[F.coalesce(F.col(c), zero).alias(c) for c in counts],
        percent(F.coalesce(F.col("Affected_Trades"), zero), F.col("Total_Trades")).alias("Exception_Rate"),
    )


def dimension_summary(
    front: DataFrame,
    back: DataFrame,
    breaks: DataFrame,
    dimension: str,
    run_col: str | None = None,
    every_copy: bool = False,
    unique_ids: bool = False,
) -> DataFrame:
    """``entity_summary`` of one dimension, with the dimension as first column."""
    one = entity_summary(front, back, breaks, [dimension], run_col, every_copy, unique_ids)
    return one.withColumnRenamed("Entity", dimension).drop("Dimension")


def desk_risk(desks: DataFrame, alert: float = C.EXCEPTION_RATE_ALERT) -> DataFrame:
    """Desks by falling exception rate, with a flag beyond the alert level."""
    return desks.select(
        "Desk",
        "Total_Trades",
        "Total_Notional",
        "Total_Breaks",
        "Critical_Breaks",
        "Exception_Rate",
        (F.col("Exception_Rate") > alert).alias("Is_Elevated"),
    ).orderBy(F.desc("Exception_Rate"), "Desk")


# --- distributions --------------------------------------------------------------------------------


def distribution(breaks: DataFrame, column: str) -> DataFrame:
    """Break count and share of all breaks per value of a column."""
    counts = breaks.groupBy(column).agg(F.count(F.lit(1)).alias("Break_Count"))
    # The window runs over one row per value (severities or break types), not over breaks.
    total = F.sum("Break_Count").over(Window.partitionBy(F.lit(0)))
    return counts.select(column, "Break_Count", percent(F.col("Break_Count"), total).alias("Percentage"))


def severity_distribution(breaks: DataFrame) -> DataFrame:
    ranked = distribution(breaks, "Severity").withColumn("Severity_Rank", severity_rank(F.col("Severity")))
    return ranked.orderBy("Severity_Rank", "Severity")


def break_type_distribution(breaks: DataFrame) -> DataFrame:
    return distribution(breaks, "Break_Type").orderBy(F.desc("Break_Count"), "Break_Type")


def break_counts(
    breaks: DataFrame, front: DataFrame, back: DataFrame, dimension: str, run_col: str | None = None
) -> DataFrame:
    """All and critical breaks per value of a dimension, unknown trades under its default label."""
    keys = _keys(run_col)
    known = known_attributes(breaks, front, back, run_col, [dimension])
    label = F.coalesce(F.col(dimension), F.lit(C.ENRICHMENT_DEFAULTS[dimension])).alias(dimension)
    return (
        _per_trade(breaks, keys)
        .join(known, keys, "left")
        .groupBy(label)
        .agg(*[F.sum(c).alias(c) for c in ("Total_Breaks", "Critical_Breaks")])
    )


# --- exposure -------------------------------------------------------------------------------------


def _valued(feed: DataFrame, *columns: str) -> DataFrame:
    return feed.select(*columns, notional(F.col("Quantity"), F.col("Price")).alias("_value"))


def severity_exposure(
    breaks: DataFrame, front: DataFrame, back: DataFrame, run_col: str | None = None
) -> DataFrame:
    """Count, share and notional of breaks per severity; a trade counts once per break.

    The notional is that of the FO trade, or of the smallest BO copy where FO has none.
    """
    keys = _keys(run_col)
    known = known_attributes(breaks, _valued(front, *keys), _valued(back, *keys), run_col, ["_value"])
    valued = (
        breaks.groupBy(*keys, "Severity")
        .agg(F.count(F.lit(1)).alias("_breaks"))
        .join(known, keys, "left")
        .withColumn("_value", F.col("_value").cast("decimal(28,8)"))
    )
    sums = valued.groupBy("Severity").agg(
        F.sum("_breaks").alias("Break_Count"),
        F.sum(F.col("_breaks") * F.col("_value")).alias("_notional"),
    )
    total = F.sum("Break_Count").over(Window.partitionBy(F.lit(0)))  # one row per severity
    return sums.select(
        "Severity",
        severity_rank(F.col("Severity")).alias("Severity_Rank"),
        "Break_Count",
        percent(F.col("Break_Count"), total).alias("Percentage"),
        F.coalesce(to_money(F.col("_notional")), F.lit(0.0)).alias("Notional_Exposure"),
    ).orderBy("Severity_Rank", "Severity")


def entity_exposure(
    breaks: DataFrame, front: DataFrame, back: DataFrame, dimension: str, run_col: str | None = None
) -> DataFrame:
    """Breaks, affected trades and their notional per value of one dimension; a trade counts once."""
    keys = _keys(run_col)
    label = C.ENRICHMENT_DEFAULTS[dimension]
    columns = [*keys, dimension]
    known = known_attributes(
        breaks, _valued(front, *columns), _valued(back, *columns), run_col, [dimension, "_value"]
    )
    return (
        breaks.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_breaks"))
        .join(known, keys, "left")
        .groupBy(F.coalesce(F.col(dimension), F.lit(label)).alias(dimension))
        .agg(
            F.sum("_breaks").alias("Total_Breaks"),
            F.count(F.lit(1)).alias("Affected_Trades"),
            to_money(F.sum("_value")).alias("Notional_Exposure"),
        )
    )


# --- runs -----------------------------------------------------------------------------------------


def run_sizes(front: DataFrame, back: DataFrame) -> list[DataFrame]:
    """Rows of each feed per run."""
    return [
        feed.groupBy(C.RUN).agg(F.count(F.lit(1)).alias(name))
        for feed, name in ((front, "Front_Count"), (back, "Back_Count"))
    ]


def run_summary(front: DataFrame, back: DataFrame, breaks: DataFrame) -> DataFrame:
    """One row per run: feed sizes, breaks by type and severity, matched trades and match rate.

    Unexpected and duplicate breaks concern BO only and do not unmatch an FO trade. The three
    inputs are aggregated per run first and then merged, so a run without breaks is kept and no
    join is needed.
    """
    return summary_of(run_sizes(front, back), breaks)


def summary_of(sizes: Sequence[DataFrame], breaks: DataFrame) -> DataFrame:
    """``run_summary`` for feeds whose sizes per run are known."""
    types = list(C.RUN_COUNT_COLUMNS.items())
    severities = list(C.SEVERITY_COUNT_COLUMNS.items())
    measures = ["Front_Count", "Back_Count", "_unmatched", *[c for _, c in types], *[c for _, c in severities]]
    unmatching = ~F.col("Break_Type").isin(C.UNEXPECTED, C.DUPLICATE)
    # Wrapped in a struct, a missing id counts as one value instead of being skipped.
    per_run_breaks = breaks.groupBy(C.RUN).agg(
        F.count_distinct(F.when(unmatching, F.struct("Trade_ID"))).alias("_unmatched"),
        *[_count_if(F.col("Break_Type") == kind).alias(c) for kind, c in types],
        *[_count_if(F.col("Severity") == s).alias(c) for s, c in severities],
    )
    merged = _union_measures(C.RUN, measures, [*sizes, per_run_breaks])
    matched = F.greatest(F.lit(0).cast("long"), F.col("Front_Count") - F.col("_unmatched"))
    return merged.withColumn("Matched_Count", matched).select(
        C.RUN,
        "Front_Count",
        "Back_Count",
        "Matched_Count",
        *[c for _, c in types],
        *[c for _, c in severities],
        percent(F.col("Matched_Count"), F.col("Front_Count")).alias("Match_Percentage"),
    )


def _union_measures(key: str, measures: Sequence[str], parts: Sequence[DataFrame]) -> DataFrame:
    zero = F.lit(0).cast("long")
    padded = [p.select(key, *[F.col(m) if m in p.columns else zero.alias(m) for m in measures]) for p in parts]
    union = padded[0]
    for p in padded[1:]:
        union = union.unionByName(p)
    return union.groupBy(key).agg(*[F.sum(m).alias(m) for m in measures])


def total_breaks() -> Column:
    out = F.lit(0).cast("long")
    for c in C.SEVERITY_COUNT_COLUMNS.values():
        out = out + F.col(c)
    return out


def run_history(runs: DataFrame) -> DataFrame:
    """Runs in time order with the total of their breaks."""
    timing = [c for c in ("Execution_Time",) if c in runs.columns]
    return runs.select(
        C.RUN,
        "Created_At",
        "Front_Count",
        "Back_Count",
        "Matched_Count",
        "Match_Percentage",
        total_breaks().alias("Total_Breaks"),
        *C.SEVERITY_COUNT_COLUMNS.values(),
        *timing,
    ).orderBy("Created_At", C.RUN)


def latest_run(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.desc("Created_At"), F.desc(C.RUN)).limit(1)


def match_rate_trend(runs: DataFrame, target: float = C.MATCH_RATE_TARGET) -> DataFrame:
    return runs.select(
        C.RUN,
        F.to_date("Created_At").alias("Run_Date"),
        "Match_Percentage",
        F.lit(float(target)).alias("Target_Rate"),
        (F.col("Match_Percentage") < target).alias("Below_Target"),
    ).orderBy("Run_Date", C.RUN)


def match_rate_change(runs: DataFrame, rows_per_task: int = ROWS_PER_SLICE) -> DataFrame:
    """Match rate of the run before, and the change. Nothing finer than one row per run is ordered, and
    with more than ``rows_per_task`` runs no task takes all of them."""
    order, rate, before = ["Created_At", C.RUN], "Match_Percentage", "Previous_Match_Percentage"
    slices = -(-runs.count() // rows_per_task)
    if slices > 1:
        lagged = sliced_lag(runs, order, rate, None, before, slices)
    else:
        lagged = runs.withColumn(before, F.lag(rate).over(Window.orderBy(*order)))
    change = F.round(F.col(rate) - F.col(before), 2).alias("Match_Rate_Change")
    return lagged.select(C.RUN, "Created_At", rate, before, change)


def volume_trend(runs: DataFrame) -> DataFrame:
    return runs.select(
        C.RUN,
        "Created_At",
        "Front_Count",
        "Back_Count",
        "Matched_Count",
        total_breaks().alias("Total_Breaks"),
    ).orderBy("Created_At", C.RUN)


def critical_trend(breaks: DataFrame) -> DataFrame:
    """Critical and all breaks per run, straight from the break history."""
    return breaks.groupBy(C.RUN).agg(
        F.count(F.lit(1)).alias("Total_Breaks"),
        _count_if(F.col("Severity") == "CRITICAL").alias("Critical_Breaks"),
    )


# --- measures -------------------------------------------------------------------------------------


def measures(runs: DataFrame, breaks: DataFrame, trades: DataFrame) -> DataFrame:
    """The dashboard measures as (Measure, Value) rows.

    Runs, breaks and trades are each reduced to one row, stacked and added up.
    """
    severities = list(C.SEVERITY_COUNT_COLUMNS.items())
    amount = "decimal(38,8)"
    columns = [
        "Total_Trades", "Matched_Trades", "Total_Breaks", "Affected_Trades",
        *[c for _, c in severities], "Total_Notional",
    ]
    timing = "Execution_Time" in runs.columns
    parts = [
        runs.agg(F.sum("Front_Count").alias("Total_Trades"), F.sum("Matched_Count").alias("Matched_Trades")),
        breaks.agg(
            F.count(F.lit(1)).alias("Total_Breaks"),
            F.count_distinct(F.struct("Trade_ID")).alias("Affected_Trades"),
            *[_count_if(F.col("Severity") == s).alias(c) for s, c in severities],
        ),
        trades.agg(F.sum(F.round(notional(F.col("Quantity"), F.col("Price")), 2)).alias("Total_Notional")),
    ]
    one = None
    for part in parts:
        padded = part.select(
            *[(F.col(c) if c in part.columns else F.lit(0)).cast(amount).alias(c) for c in columns]
        )
        one = padded if one is None else one.unionByName(padded)
    sums = one.agg(*[F.sum(c).cast("double").alias(c) for c in columns])

    def rate(part: str) -> Column:
        return F.when(F.col("Total_Trades") > 0, F.col(part) / F.col("Total_Trades") * 100).otherwise(0.0)

    named = {
        **{c: F.col(c) for c in columns},
        "Match_Rate": rate("Matched_Trades"),
        "Exception_Rate": rate("Affected_Trades"),
    }
    rows = F.array(*[F.struct(F.lit(n).alias("Measure"), v.alias("Value")) for n, v in named.items()])
    out = sums.select(F.explode(rows).alias("_m")).select("_m.*")
    if timing:
        # Seconds are kept to four places; a sum of decimals is the same in any order.
        seconds = F.sum(F.col("Execution_Time").cast("decimal(18,4)")).cast("double")
        mean = runs.agg((seconds / F.count("Execution_Time")).alias("Value"))
        out = out.unionByName(mean.select(F.lit("Average_Processing_Time").alias("Measure"), "Value"))
    return out
