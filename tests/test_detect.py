"""Break detection on hand-made feeds, with and without the handling of hot keys."""

import datetime as dt
import random

import pytest

from breakwater import constants as C
from breakwater.operators import detect
from breakwater.operators.skew import DEFAULT
from conftest import TOUCHY

POLICIES = pytest.mark.parametrize("policy", [DEFAULT, TOUCHY], ids=["default", "touchy"])


def test_clean_feeds_have_no_breaks(feed):
    assert detect.all_breaks(feed({}), feed({})).isEmpty()


@pytest.mark.parametrize(
    "change, kind, expected, actual",
    [
        ({"Price": 10.5}, C.PRICE, "10.0", "10.5"),
        ({"Quantity": 150}, C.QUANTITY, "100", "150"),
        ({"Trade_Status": "SETTLED"}, C.STATUS, "BOOKED", "SETTLED"),
        ({"Trade_Date": dt.date(2024, 1, 1)}, C.TRADE_DATE, "2024-01-02", "2024-01-01"),
        ({"Settlement_Date": dt.date(2024, 1, 9)}, C.SETTLEMENT_DATE, "2024-01-04", "2024-01-09"),
        ({"Currency": "EUR"}, C.CURRENCY, "USD", "EUR"),
    ],
)
def test_one_changed_field_is_one_break(feed, breaks_of, change, kind, expected, actual):
    found = detect.all_breaks(feed({}), feed(change))
    assert breaks_of(found) == [("T1", kind, expected, actual)]
    assert breaks_of(found, "Severity") == [(C.SEVERITY_BY_BREAK[kind],)]
    assert breaks_of(detect.breaks_one_by_one(feed({}), feed(change))) == breaks_of(found)


def test_tolerance_is_strict_and_in_doubles(feed, breaks_of):
    # 100.01 - 100.0 is 0.010000000000005116 as a double, 10.01 - 10.0 is 0.009999999999999787.
    front = feed({"Trade_ID": "A", "Price": 100.0}, {"Trade_ID": "B", "Price": 10.0})
    back = feed({"Trade_ID": "A", "Price": 100.01}, {"Trade_ID": "B", "Price": 10.01})
    assert breaks_of(detect.all_breaks(front, back)) == [("A", C.PRICE, "100.0", "100.01")]
    assert detect.price_mismatches(front, back, tolerance=0.5).isEmpty()


def test_price_text_has_no_exponent(feed, breaks_of):
    found = detect.all_breaks(feed({"Price": 1e7}), feed({"Price": 12345678.25}))
    assert breaks_of(found) == [("T1", C.PRICE, "10000000.0", "12345678.25")]


def test_null_field_is_no_mismatch(feed):
    nothing = {c: None for c in ("Price", "Quantity", "Trade_Status", "Trade_Date", "Settlement_Date", "Currency")}
    assert detect.all_breaks(feed(nothing), feed({})).isEmpty()
    assert detect.all_breaks(feed({}), feed(nothing)).isEmpty()


@POLICIES
def test_null_ids(feed, breaks_of, policy):
    """FO rows without an id are missing one by one; BO rows without an id are one unexpected trade."""
    front = feed({}, *[{"Trade_ID": None}] * 4)
    back = feed({}, *[{"Trade_ID": None}] * 5)
    missing = (None, C.MISSING, C.MISSING_EXPECTED, C.MISSING_ACTUAL)
    expected = sorted(
        [
            *[missing] * 4,
            (None, C.UNEXPECTED, C.UNEXPECTED_EXPECTED, C.UNEXPECTED_ACTUAL),
            (None, C.DUPLICATE, C.DUPLICATE_EXPECTED, f"{C.DUPLICATE_ACTUAL} (5)"),
        ],
        key=str,
    )
    assert breaks_of(detect.all_breaks(front, back, policy=policy)) == expected
    assert breaks_of(detect.breaks_one_by_one(front, back)) == expected


def test_copies_with_the_same_wrong_price_are_one_price_break(feed, breaks_of):
    same = detect.price_mismatches(feed({}), feed({"Price": 11.0}, {"Price": 11.0}))
    different = detect.price_mismatches(feed({}), feed({"Price": 11.0}, {"Price": 12.0}))
    assert (same.count(), different.count()) == (1, 2)


def test_unexpected_copies_are_listed_once(feed, breaks_of):
    found = detect.all_breaks(feed({}), feed({}, {"Trade_ID": "X"}, {"Trade_ID": "X"}))
    kinds = [b[1] for b in breaks_of(found)]
    assert kinds == [C.DUPLICATE, C.UNEXPECTED]


def test_repeated_fo_row_is_missing_each_time(feed, breaks_of):
    front = feed({}, *[{"Trade_ID": "M"}] * 3)
    assert len(breaks_of(detect.all_breaks(front, feed({})))) == 3
    assert len(breaks_of(detect.missing_trades(front, feed({})))) == 3


def test_runs_do_not_mix(feed, breaks_of):
    front = feed({C.RUN: "R1"}, {C.RUN: "R2"})
    back = feed({C.RUN: "R1"}, {C.RUN: "R2", "Quantity": 7})
    assert breaks_of(detect.all_breaks(front, back, C.RUN), C.RUN, "Break_Type") == [("R2", C.QUANTITY)]
    lone = detect.all_breaks(feed({C.RUN: "R1"}), feed({C.RUN: "R2"}), C.RUN)
    assert breaks_of(lone, C.RUN, "Break_Type") == [("R1", C.MISSING), ("R2", C.UNEXPECTED)]


def _expected(front, back, tolerance=0.01):
    """Brute force over two lists of rows."""
    out = []
    by_id = {}
    for b in back:
        by_id.setdefault(b["Trade_ID"], []).append(b)
    known = {f["Trade_ID"] for f in front}
    fields = [("Quantity", C.QUANTITY), ("Trade_Status", C.STATUS), ("Currency", C.CURRENCY)]
    for f in front:
        copies = by_id.get(f["Trade_ID"], [])
        if not copies:
            out.append((f["Trade_ID"], C.MISSING, C.MISSING_EXPECTED, C.MISSING_ACTUAL))
        pairs = set()
        for b in copies:
            if abs(f["Price"] - b["Price"]) > tolerance:
                pairs.add((C.PRICE, str(f["Price"]), str(b["Price"])))
            for column, kind in fields:
                if f[column] != b[column]:
                    pairs.add((kind, str(f[column]), str(b[column])))
        out += [(f["Trade_ID"], *p) for p in pairs]
    for trade_id, copies in by_id.items():
        if trade_id not in known:
            out.append((trade_id, C.UNEXPECTED, C.UNEXPECTED_EXPECTED, C.UNEXPECTED_ACTUAL))
        if len(copies) > 1:
            out.append((trade_id, C.DUPLICATE, C.DUPLICATE_EXPECTED, f"{C.DUPLICATE_ACTUAL} ({len(copies)})"))
    return sorted(out, key=str)


@POLICIES
def test_one_id_holds_a_third_of_the_back_office(feed, breaks_of, policy):
    rng = random.Random(11)

    def row(trade_id):
        return {
            "Trade_ID": trade_id,
            "Price": float(rng.choice([10, 11, 12, 13])),
            "Quantity": rng.choice([100, 200]),
            "Trade_Status": rng.choice(["BOOKED", "SETTLED"]),
            "Currency": rng.choice(["USD", "EUR"]),
        }

    front = [row(f"T{i}") for i in range(40)]
    back = [row(f"T{i}") for i in range(0, 45) if i % 7]
    back += [row("T1") for _ in range(30)] + [row("NEW") for _ in range(12)] + [back[3]] * 9
    frames = feed(*front), feed(*back).repartition(5)
    expected = _expected(front, back)
    assert breaks_of(detect.all_breaks(*frames, policy=policy)) == expected
    assert breaks_of(detect.breaks_one_by_one(*frames)) == expected
    for rule in detect.field_rules():
        found = detect.field_mismatches(*frames, rule, policy=policy)
        assert breaks_of(found) == [b for b in expected if b[1] == rule.break_type]
