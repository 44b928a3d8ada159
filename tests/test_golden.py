"""Known counts of the derived feeds at sf0.01."""

from breakwater import constants as C
from breakwater.operators import detect
from breakwater.plans import queries
from breakwater.sources.star_feeds import PERIOD

GOLDEN = {
    C.MISSING: 1106,
    C.UNEXPECTED: 708,
    C.DUPLICATE: 254,
    C.PRICE: 1010,
    C.QUANTITY: 614,
    C.STATUS: 644,
    C.TRADE_DATE: 426,
    C.SETTLEMENT_DATE: 294,
    C.CURRENCY: 445,
}


def test_feed_sizes(spark, medium_dir):
    front, back = queries._feeds(spark, medium_dir)
    assert front.count() == front.select("Trade_ID").distinct().count() == 60_000
    assert (back.count(), back.select("Trade_ID").distinct().count()) == (59_856, 59_602)


def test_breaks_by_type(spark, medium_dir):
    breaks = detect.all_breaks(*queries._feeds(spark, medium_dir))
    assert {r["Break_Type"]: r["count"] for r in breaks.groupBy("Break_Type").count().collect()} == GOLDEN
    assert breaks.select("Trade_ID").distinct().count() == 5334


def test_run_summary(spark, medium_dir):
    run = queries.registry()["run_summary"](spark, medium_dir).first()
    assert (run["Front_Count"], run["Back_Count"], run["Matched_Count"]) == (60_000, 59_856, 55_562)
    assert run["Match_Percentage"] == 92.6
    assert [run[c] for c in C.SEVERITY_COUNT_COLUMNS.values()] == [1814, 868, 1455, 1364]


def test_one_run_per_period(spark, medium_dir):
    runs = queries.registry()["backfill_runs"](spark, medium_dir)
    assert runs.count() == runs.select(C.RUN).distinct().count() == 80


def test_fused_equals_the_nine_detectors(spark, medium_dir):
    feeds = queries._feeds(spark, medium_dir)
    fused, single = detect.all_breaks(*feeds, PERIOD), detect.breaks_one_by_one(*feeds, PERIOD)
    assert fused.exceptAll(single).isEmpty() and single.exceptAll(fused).isEmpty()


def test_injected_breaks_are_detected(spark, medium_dir):
    """Everything injected is found; only prices on the edge of the tolerance may come on top."""
    truth = queries.registry()["injected_truth"](spark, medium_dir)
    found = detect.all_breaks(*queries._feeds(spark, medium_dir))
    assert truth.exceptAll(found.select(truth.columns)).isEmpty()
    extra = found.select(truth.columns).exceptAll(truth)
    assert {r[0] for r in extra.select("Break_Type").distinct().collect()} <= {C.PRICE}
