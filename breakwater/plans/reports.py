"""Report inputs, KPI lists and the file extracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from breakwater import constants as C
from breakwater.functions import control_band, dashboard_band, notional, to_money
from breakwater.operators import summarise
from breakwater.operators.enrich import enrich
from breakwater.operators.skew import salted_lookup
from breakwater.operators.trades import trade_details
from breakwater.sources import files
from breakwater.sources.shared import shared_dir
from breakwater.sources.tables import BACK, BREAKS, FRONT, RUNS, ControlTables

NO_HISTORY = "no reconciliation run on record"


def run_status(runs: DataFrame) -> DataFrame:
    rate = F.col("Match_Percentage")
    return runs.select(
        C.RUN,
        "Match_Percentage",
        control_band(rate).alias("Control_Status"),
        dashboard_band(rate).alias("Dashboard_Status"),
    )


def report_input(runs: DataFrame, breaks: DataFrame) -> DataFrame:
    """Breaks of the latest run next to the headline figures of that run."""
    latest = summarise.latest_run(runs).select(C.RUN, "Front_Count", "Back_Count", "Match_Percentage")
    # The id as a subquery prunes the history to one partition. The figures are a single row, which
    # the limit proves small enough to broadcast.
    of_latest = breaks.filter(F.col(C.RUN) == latest.select(C.RUN).scalar())
    return of_latest.join(F.broadcast(latest), [C.RUN])


def executive_kpis(run: DataFrame) -> DataFrame:
    """The executive list of one run as (Position, Attribute, Value) text rows."""

    def count(column: str) -> Column:
        return F.col(column).cast("string")

    rows = [
        ("Run ID", F.col(C.RUN)),
        ("Execution Time", F.format_string("%.4f seconds", "Execution_Time")),
        ("Generated On", F.date_format("Created_At", "yyyy-MM-dd HH:mm:ss")),
        ("Front Office Trades", count("Front_Count")),
        ("Back Office Trades", count("Back_Count")),
        ("Matched Trades", count("Matched_Count")),
        ("Match Percentage", F.format_string("%.2f%%", "Match_Percentage")),
        ("Critical Issues", count("Critical_Breaks")),
        ("High Issues", count("High_Breaks")),
        ("Medium Issues", count("Medium_Breaks")),
        ("Low Issues", count("Low_Breaks")),
    ]
    entries = [
        F.struct(F.lit(i).alias("Position"), F.lit(name).alias("Attribute"), value.alias("Value"))
        for i, (name, value) in enumerate(rows, start=1)
    ]
    return run.select(F.explode(F.array(*entries)).alias("_k")).select("_k.*").orderBy("Position")


def kpi_cards(run: DataFrame) -> DataFrame:
    """The headline cards of one run as (Position, Card, Value), numbers with thousands separators."""

    def grouped(value: Column) -> Column:
        return F.format_number(value, 0)

    cards = [
        ("Total FO Trades", grouped(F.col("Front_Count"))),
        ("Total BO Trades", grouped(F.col("Back_Count"))),
        ("Matched Trades", grouped(F.col("Matched_Count"))),
        ("Match Rate %", F.format_string("%.2f%%", "Match_Percentage")),
        ("Total Exceptions", grouped(summarise.total_breaks())),
        ("Critical Breaks", grouped(F.col("Critical_Breaks"))),
    ]
    entries = [
        F.struct(F.lit(i).alias("Position"), F.lit(name).alias("Card"), value.alias("Value"))
        for i, (name, value) in enumerate(cards, start=1)
    ]
    return run.select(F.explode(F.array(*entries)).alias("_k")).select("_k.*").orderBy("Position")


def control_status(counts: DataFrame, runs: DataFrame) -> DataFrame:
    """Table sizes and the latest run as (Item, Value) text rows."""
    latest = summarise.latest_run(runs)
    entries = F.array(
        F.struct(F.lit("latest_run").alias("Item"), F.col(C.RUN).alias("Value")),
        F.struct(F.lit("latest_match_percentage").alias("Item"), F.format_string("%.2f", "Match_Percentage").alias("Value")),
        F.struct(F.lit("latest_created_at").alias("Item"), F.date_format("Created_At", "yyyy-MM-dd").alias("Value")),
    )
    sizes = counts.select(F.col("Table_Name").alias("Item"), F.col("Row_Count").cast("string").alias("Value"))
    return sizes.unionByName(latest.select(F.explode(entries).alias("_s")).select("_s.*"))


def star_breaks(runs: DataFrame, breaks: DataFrame, trades: DataFrame, run_col: str | None = None) -> DataFrame:
    """Breaks with the figures of their run and the FO trade they belong to."""
    keys = [run_col, "Trade_ID"] if run_col else ["Trade_ID"]
    facts = breaks.select("Break_ID", C.RUN, *keys, "Break_Type", "Severity")
    traded = trades.select(
        *keys,
        *C.DIMENSIONS,
        to_money(notional(F.col("Quantity"), F.col("Price"))).alias("Trade_Notional"),
    )
    # The run table, one row for each run, is joined plainly; an id can own many breaks and is salted.
    dated = facts.join(runs.select(C.RUN, "Created_At", "Match_Percentage"), [C.RUN])
    return salted_lookup(dated, traded, keys, "inner", like=facts)


# --- files -----------------------------------------------------------------------------------------


def write_category_extract(breaks: DataFrame, path: str) -> None:
    """All break types as CSV, one folder per type, from one pass; a type without breaks gets a
    file with the header alone."""
    files.write_csv(breaks, path, ["Break_Type"])
    found = {r[0] for r in breaks.select("Break_Type").distinct().collect()}  # one row per type
    for kind in C.BREAK_TYPES:
        if kind not in found:
            header = breaks.filter(F.lit(False)).drop("Break_Type").coalesce(1)
            files.write_csv(header, f"{path}/Break_Type={kind}")


def write_run_extract(runs: DataFrame, breaks: DataFrame, path: str) -> None:
    """The summary of each run next to the extracts by category."""
    files.write_csv(runs, f"{path}/summary")
    write_category_extract(breaks, f"{path}/breaks")


def write_json_audit(summary: DataFrame, breaks: DataFrame, path: str) -> None:
    files.write_json(summary, f"{path}/summary")
    files.write_json(breaks, f"{path}/breaks")


def analytics_datasets(
    tables: ControlTables, run_col: str | None = None, run_of_break: Column | None = None
) -> dict[str, DataFrame]:
    """The nine analytics datasets over the recorded history.

    Where the feeds cover several runs, ``run_col`` names the feed column that tells them apart and
    ``run_of_break`` derives it from the ``Run_ID`` of a break; without them, trades are matched by
    id alone.
    """
    if not tables.exists(RUNS) or not tables.exists(BREAKS) or tables.read(RUNS).isEmpty():
        raise ValueError(NO_HISTORY)
    runs, breaks = tables.read(RUNS), tables.read(BREAKS)
    front, back = tables.read(FRONT), tables.read(BACK)
    if run_col:
        breaks = breaks.withColumn(run_col, run_of_break)
    enriched = enrich(breaks, front, back, run_col)

    # The FO table was checked for unique ids when it was loaded or reconciled. The four dimensions
    # are computed in one pass and written down, for four datasets are cut out of them.
    shared_dir(tables.spark)
    entities = summarise.entity_summary(front, back, breaks, run_col=run_col, unique_ids=True).checkpoint()

    def dimension(name: str, *severities: str) -> DataFrame:
        one = entities.filter(F.col("Dimension") == name)
        return one.select(
            F.col("Entity").alias(name),
            "Total_Trades",
            "Total_Notional",
            "Total_Breaks",
            *severities,
            "Exception_Rate",
        ).orderBy(name)

    return {
        "reconciliation_runs": summarise.run_history(runs),
        "reconciliation_breaks": enriched.drop(*([run_col] if run_col else [])),
        "trade_details": trade_details(front),
        "desk_summary": dimension("Desk", *C.SEVERITY_COUNT_COLUMNS.values()),
        "portfolio_summary": dimension("Portfolio"),
        "counterparty_summary": dimension("Counterparty", "Critical_Breaks"),
        "asset_class_summary": dimension("Asset_Class"),
        "severity_summary": summarise.severity_distribution(breaks),
        "break_type_summary": summarise.break_type_distribution(breaks),
    }


#: The large datasets: the order of their rows in the files, and what is left out there.
EXPORT_ORDER = {
    "reconciliation_breaks": (["Detected_At", "Break_ID"], ["Break_ID"]),
    "trade_details": (["Trade_ID"], []),
}
#: Of these, the ones that are a table read through: nothing is saved by computing them once.
READ_THROUGH = {"trade_details"}


def write_datasets(datasets: dict[str, DataFrame], path: str, compression: str = "none") -> dict[str, str]:
    """Writes each dataset as CSV into its own folder, the large ones as files in order."""
    written = {}
    for name, df in datasets.items():
        written[name] = f"{path}/{name}"
        if name in EXPORT_ORDER:
            order, left_out = EXPORT_ORDER[name]
            staged = name not in READ_THROUGH
            files.write_ordered_csv(df, written[name], order, left_out, staged=staged, compression=compression)
        else:
            files.write_csv(df, written[name], compression=compression)
    return written


def exported_columns(name: str, dataset: DataFrame) -> list[str]:
    """The columns a dataset has in its files."""
    left_out = EXPORT_ORDER[name][1] if name in EXPORT_ORDER else []
    return [c for c in dataset.columns if c not in left_out]


def write_analytics_datasets(
    tables: ControlTables, path: str, run_col: str | None = None, run_of_break: Column | None = None
) -> dict[str, str]:
    return write_datasets(analytics_datasets(tables, run_col, run_of_break), path)
