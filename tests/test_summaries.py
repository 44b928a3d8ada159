"""Enrichment, run arithmetic and top-k on hand-made data."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from breakwater import constants as C
from breakwater.operators import enrich, explore, summarise
from breakwater.operators.detect import all_breaks
from breakwater.plans import reports
from breakwater.plans.runs import identified
from conftest import TOUCHY

def _stamp():
    return F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")


@pytest.fixture
def breaks(spark):
    def build(*rows):
        """(id, type) rows as identified breaks of run R."""
        out = spark.createDataFrame(
            [(i, kind, "e", "a", C.SEVERITY_BY_BREAK[kind]) for i, kind in rows],
            "Trade_ID string, Break_Type string, Expected_Value string, Actual_Value string, Severity string",
        )
        return identified(out, F.lit("R"), _stamp())

    return build


def _run(summary):
    return summary.first().asDict()


def test_thousand_trades(spark, feed, breaks):
    """18+12+16+10+9+7+5+8+4 breaks in 1,000 trades: 89 in all, 927 matched, 92.70 %."""
    kinds = {
        C.MISSING: 18,
        C.UNEXPECTED: 12,
        C.PRICE: 16,
        C.QUANTITY: 10,
        C.STATUS: 9,
        C.TRADE_DATE: 7,
        C.SETTLEMENT_DATE: 5,
        C.CURRENCY: 8,
        C.DUPLICATE: 4,
    }
    rows, n = [], 0
    for kind, count in kinds.items():
        rows += [(f"T{n + i}", kind) for i in range(count)]
        n += count
    front = spark.range(1000).select(F.lit("R").alias(C.RUN))
    back = spark.range(998).select(F.lit("R").alias(C.RUN))
    run = _run(summarise.run_summary(front, back, breaks(*rows)))
    assert (run["Front_Count"], run["Back_Count"], run["Matched_Count"]) == (1000, 998, 927)
    assert run["Match_Percentage"] == 92.7
    assert [run[c] for c in C.SEVERITY_COUNT_COLUMNS.values()] == [30, 14, 24, 21]
    assert {k: run[c] for k, c in C.RUN_COUNT_COLUMNS.items()} == kinds


def test_bo_only_breaks_do_not_unmatch(spark, breaks):
    feed = spark.range(2).select(F.lit("R").alias(C.RUN))
    run = _run(summarise.run_summary(feed, feed, breaks(("X", C.UNEXPECTED), ("T1", C.DUPLICATE))))
    assert (run["Matched_Count"], run["Match_Percentage"]) == (2, 100.0)


def test_run_without_breaks_is_kept(spark, breaks):
    feed = spark.createDataFrame([("R",), ("S",)], "Run_ID string")
    runs = summarise.run_summary(feed, feed, breaks(("T1", C.MISSING)))
    assert {r[C.RUN]: r["Matched_Count"] for r in runs.collect()} == {"R": 0, "S": 1}


def test_enrichment_order(feed, breaks):
    """FO first, then the smallest BO copy, then the defaults; gaps in FO are filled from BO."""
    front = feed({"Trade_ID": "A", "Desk": "FO desk", "Trader": None})
    back = feed(
        {"Trade_ID": "A", "Desk": "BO desk", "Trader": "Bo"},
        {"Trade_ID": "B", "Desk": "Z", "Trader": "B"},
        {"Trade_ID": "B", "Desk": "Y", "Trader": "B"},
    )
    found = breaks(("A", C.PRICE), ("B", C.UNEXPECTED), ("B", C.DUPLICATE), ("C", C.MISSING), (None, C.MISSING))
    for policy in (TOUCHY, enrich.DEFAULT):
        out = enrich.enrich(found, front, back, policy=policy).collect()
        assert len(out) == 5
        seen = {(r["Trade_ID"], r["Desk"], r["Trader"], r["Currency"]) for r in out}
        assert seen == {
            ("A", "FO desk", "Bo", "USD"),
            ("B", "Y", "B", "USD"),
            ("C", "Unassigned", "N/A", "USD"),
            (None, "Unassigned", "N/A", "USD"),
        }


def test_every_copy_equals_the_plain_join(feed, breaks):
    front = feed({"Trade_ID": "A"}, {"Trade_ID": "N"})
    back = feed(*[{"Trade_ID": "A"}] * 3, {"Trade_ID": "B", "Desk": "X"}, *[{"Trade_ID": "B", "Desk": "Y"}] * 2)
    found = breaks(("A", C.PRICE), ("A", C.DUPLICATE), ("B", C.UNEXPECTED), ("N", C.MISSING))
    out = enrich.enrich(found, front, back, every_copy=True, policy=TOUCHY)
    counted = {(r["Trade_ID"], r["Break_Type"], r["Desk"]): r["Row_Copies"] for r in out.collect()}
    assert counted == {
        ("A", C.PRICE, "Rates"): 3,
        ("A", C.DUPLICATE, "Rates"): 3,
        ("B", C.UNEXPECTED, "X"): 1,
        ("B", C.UNEXPECTED, "Y"): 2,
        ("N", C.MISSING, "Rates"): 1,
    }


@pytest.mark.parametrize("unique_ids", [True, False])
def test_dimension_summary_is_not_inflated(feed, breaks, unique_ids):
    front = feed({"Trade_ID": "A"}, {"Trade_ID": "B"}, {"Trade_ID": "C", "Desk": "FX", "Quantity": -5})
    back = feed(*[{"Trade_ID": "A"}] * 4, {"Trade_ID": "X", "Desk": "BO only"})
    found = breaks(("A", C.DUPLICATE), ("A", C.PRICE), ("B", C.MISSING), ("X", C.UNEXPECTED))
    out = summarise.dimension_summary(front, back, found, "Desk", unique_ids=unique_ids)
    by_desk = {r["Desk"]: r.asDict() for r in out.collect()}
    assert set(by_desk) == {"Rates", "FX"}
    rates = by_desk["Rates"]
    assert (rates["Total_Trades"], rates["Total_Notional"], rates["Total_Breaks"]) == (2, 2000.0, 3)
    assert (rates["Critical_Breaks"], rates["Exception_Rate"]) == (1, 100.0)
    assert (by_desk["FX"]["Total_Notional"], by_desk["FX"]["Total_Breaks"], by_desk["FX"]["Exception_Rate"]) == (50.0, 0, 0.0)
    fan = summarise.dimension_summary(front, back, found, "Desk", every_copy=True, unique_ids=unique_ids)
    assert {r["Desk"]: r["Total_Breaks"] for r in fan.collect()} == {"Rates": 9, "FX": 0}


def test_exposure_falls_back_to_bo(feed, breaks):
    front = feed({"Trade_ID": "A", "Quantity": 3})
    back = feed({"Trade_ID": "X", "Quantity": 2}, {"Trade_ID": "X", "Quantity": 4})
    found = breaks(("A", C.QUANTITY), ("A", C.DUPLICATE), ("X", C.UNEXPECTED), ("Z", C.MISSING))
    out = {r["Severity"]: r.asDict() for r in summarise.severity_exposure(found, front, back).collect()}
    assert (out["HIGH"]["Notional_Exposure"], out["HIGH"]["Percentage"]) == (60.0, 50.0)
    assert (out["CRITICAL"]["Break_Count"], out["CRITICAL"]["Notional_Exposure"]) == (2, 20.0)


def test_severity_order_and_shares(breaks):
    found = breaks(("A", C.STATUS), ("B", C.MISSING), ("C", C.MISSING))
    out = summarise.severity_distribution(found).collect()
    assert [(r["Severity"], r["Break_Count"], r["Percentage"]) for r in out] == [
        ("CRITICAL", 2, 66.67),
        ("LOW", 1, 33.33),
    ]


def test_top_critical_is_not_padded_and_falls_back(feed, breaks):
    front, back = feed({"Trade_ID": "A"}), feed({"Trade_ID": "A"})
    mixed = breaks(("A", C.MISSING), *[(f"S{i}", C.STATUS) for i in range(20)])
    assert [r["Severity"] for r in explore.top_critical(mixed, front, back).collect()] == ["CRITICAL"]
    low = breaks(*[(f"S{i}", C.STATUS) for i in range(20)])
    assert explore.top_critical(low, front, back).count() == 8


def test_measures(spark, feed, breaks):
    runs = spark.createDataFrame([("R", 4, 3, 1.0), ("S", 4, 4, 2.0)], "Run_ID string, Front_Count long, Matched_Count long, Execution_Time double")
    found = breaks(("A", C.MISSING), ("A", C.STATUS), ("B", C.DUPLICATE))
    out = {r[0]: r[1] for r in summarise.measures(runs, found, feed({}, {"Quantity": -1})).collect()}
    assert out == {
        "Total_Trades": 8.0,
        "Matched_Trades": 7.0,
        "Total_Breaks": 3.0,
        "Affected_Trades": 2.0,
        "Critical_Breaks": 1.0,
        "High_Breaks": 1.0,
        "Medium_Breaks": 0.0,
        "Low_Breaks": 1.0,
        "Total_Notional": 1010.0,
        "Match_Rate": 87.5,
        "Exception_Rate": 25.0,
        "Average_Processing_Time": 1.5,
    }
    empty = summarise.measures(runs.limit(0), found.limit(0), feed({}).limit(0))
    assert {r[0]: r[1] for r in empty.collect()}["Match_Rate"] == 0.0


def test_facets(breaks):
    found = breaks(("A", C.MISSING), ("B", C.PRICE)).withColumns(
        {c: F.lit("Some Name") for c in ("Trader", "Counterparty", "Symbol")}
    )
    state = found.withColumn("Resolution_Status", F.lit(None).cast("string"))
    assert explore.filter_breaks(state).count() == 2
    assert explore.filter_breaks(state, text="SOME n").count() == 2
    assert explore.filter_breaks(state, severity="MEDIUM", resolution="UNRESOLVED").count() == 1
    assert explore.filter_breaks(state, break_type=C.MISSING, severity="LOW").isEmpty()
    assert explore.slice_breaks(found, "2024-02-01").isEmpty()
    assert explore.slice_breaks(found, to_date=dt.date(2024, 1, 31), Trade_ID=["A"]).count() == 1


def test_bands_at_their_edges(spark):
    runs = spark.createDataFrame(
        [("a", 95.0), ("b", 94.99), ("c", 90.0), ("d", 89.99), ("e", 79.99)], "Run_ID string, Match_Percentage double"
    )
    out = {r[0]: (r["Control_Status"], r["Dashboard_Status"]) for r in reports.run_status(runs).collect()}
    assert out == {
        "a": ("HEALTHY", "OPTIMAL"),
        "b": ("HEALTHY", "ACCEPTABLE"),
        "c": ("HEALTHY", "ACCEPTABLE"),
        "d": ("WARNING", "ATTENTION"),
        "e": ("CRITICAL", "ATTENTION"),
    }


def test_break_key_reads_null_as_empty(spark, breaks):
    one = breaks(("A", C.MISSING)).withColumn("Expected_Value", F.lit(None).cast("string"))
    again = identified(one.drop("Break_ID", "Detected_At"), F.lit("R"), _stamp()).first()["Break_ID"]
    assert again == one.selectExpr("md5('R|A|Missing Trade||a') AS m").first()["m"]


def test_detection_feeds_the_summary(feed):
    front = feed({"Trade_ID": "A"}, {"Trade_ID": "B"}).withColumn(C.RUN, F.lit("R"))
    back = feed({"Trade_ID": "A", "Price": 11.0}).withColumn(C.RUN, F.lit("R"))
    run = _run(summarise.run_summary(front, back, all_breaks(front, back, C.RUN)))
    assert (run["Missing_Count"], run["Price_Mismatch_Count"], run["Match_Percentage"]) == (1, 1, 0.0)
