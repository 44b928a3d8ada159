"""Break detection between a front-office (FO) and a back-office (BO) feed.

``all_breaks`` finds the nine break types in one pass over a single full outer join; the
single-type functions answer one question each. Both views share the field rules and the salted
join. With ``run_col`` many reconciliation runs are compared in the same job: the column is part of
every key and of every result row.

The FO feed is expected to hold one row per key (``quality.duplicate_ids`` checks it, the run plan
refuses feeds that break it); BO copies may repeat at will, and one id may hold most of the feed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from breakwater import constants as C
from breakwater.functions import any_null, plain_price, severity_of
from breakwater.operators.skew import DEFAULT, REPEATED, SkewPolicy, salted
from breakwater.sources.shared import written


@dataclass(frozen=True)
class FieldRule:
    """One compared field: when do two values differ, and how are they shown."""

    column: str
    break_type: str
    differs: Callable[[Column, Column], Column]
    as_text: Callable[[Column], Column]


def _text(value: Column) -> Column:
    return value.cast("string")


def _unequal(front: Column, back: Column) -> Column:
    # Three-valued on purpose: a NULL on either side is not a break.
    return front != back


def field_rules(price_tolerance: float = C.PRICE_TOLERANCE) -> list[FieldRule]:
    """The six compared fields. Prices are compared as doubles, strictly beyond the tolerance."""

    def beyond(front: Column, back: Column) -> Column:
        return F.abs(front - back) > F.lit(float(price_tolerance))

    return [
        FieldRule("Price", C.PRICE, beyond, plain_price),
        FieldRule("Quantity", C.QUANTITY, _unequal, _text),
        FieldRule("Trade_Status", C.STATUS, _unequal, _text),
        FieldRule("Trade_Date", C.TRADE_DATE, _unequal, _text),
        FieldRule("Settlement_Date", C.SETTLEMENT_DATE, _unequal, _text),
        FieldRule("Currency", C.CURRENCY, _unequal, _text),
    ]


def _rule(break_type: str, price_tolerance: float = C.PRICE_TOLERANCE) -> FieldRule:
    return next(r for r in field_rules(price_tolerance) if r.break_type == break_type)


def _keys(run_col: str | None) -> list[str]:
    return [run_col, "Trade_ID"] if run_col else ["Trade_ID"]


def _labelled(df: DataFrame, keys: Sequence[str], break_type: str, expected: Column, actual: Column) -> DataFrame:
    return df.select(
        *keys,
        F.lit(break_type).alias("Break_Type"),
        expected.alias("Expected_Value"),
        actual.alias("Actual_Value"),
        severity_of(F.lit(break_type)).alias("Severity"),
    )


# --- one break type at a time --------------------------------------------------------------------


def missing_trades(front: DataFrame, back: DataFrame, run_col: str | None = None) -> DataFrame:
    """FO rows without a BO row. Every FO row counts, NULL ids included."""
    keys = _keys(run_col)
    ids = front.select(*keys)
    known = back.select(*keys).distinct()
    unmatched = ids.filter(~any_null(keys)).join(known, keys, "left_anti")
    # NULL ids match nothing; they need no join and must not meet in one partition.
    absent = unmatched.unionByName(ids.filter(any_null(keys)))
    return _labelled(absent, keys, C.MISSING, F.lit(C.MISSING_EXPECTED), F.lit(C.MISSING_ACTUAL))


def unexpected_trades(front: DataFrame, back: DataFrame, run_col: str | None = None) -> DataFrame:
    """Distinct BO ids without an FO row."""
    keys = _keys(run_col)
    # Reducing BO to its ids first combines copies map-side; the join then sees unique keys.
    extra = back.select(*keys).distinct().join(front.select(*keys).distinct(), keys, "left_anti")
    return _labelled(extra, keys, C.UNEXPECTED, F.lit(C.UNEXPECTED_EXPECTED), F.lit(C.UNEXPECTED_ACTUAL))


def duplicate_trades(back: DataFrame, run_col: str | None = None) -> DataFrame:
    """BO ids that occur more than once, with the number of entries."""
    keys = _keys(run_col)
    repeated = back.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return _labelled(repeated, keys, C.DUPLICATE, F.lit(C.DUPLICATE_EXPECTED), _entries_text(F.col("_n")))


def _entries_text(count: Column) -> Column:
    return F.concat(F.lit(C.DUPLICATE_ACTUAL + " ("), count.cast("string"), F.lit(")"))


def field_mismatches(
    front: DataFrame,
    back: DataFrame,
    rule: FieldRule,
    run_col: str | None = None,
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """Distinct (id, FO value, BO value) where the rule sees a difference."""
    keys = _keys(run_col)
    bo, fo, on = salted(
        back.select(*keys, F.col(rule.column).alias("_bo")).filter(~any_null(keys)),
        front.select(*keys, F.col(rule.column).alias("_fo")).filter(~any_null(keys)),
        keys,
        policy,
    )
    differing = fo.join(bo, on, "inner").filter(rule.differs(F.col("_fo"), F.col("_bo")))
    return _labelled(
        differing, keys, rule.break_type, rule.as_text(F.col("_fo")), rule.as_text(F.col("_bo"))
    ).distinct()


def price_mismatches(front, back, run_col=None, tolerance: float = C.PRICE_TOLERANCE) -> DataFrame:
    return field_mismatches(front, back, _rule(C.PRICE, tolerance), run_col)


def quantity_mismatches(front, back, run_col=None) -> DataFrame:
    return field_mismatches(front, back, _rule(C.QUANTITY), run_col)


def status_mismatches(front, back, run_col=None) -> DataFrame:
    return field_mismatches(front, back, _rule(C.STATUS), run_col)


def trade_date_mismatches(front, back, run_col=None) -> DataFrame:
    return field_mismatches(front, back, _rule(C.TRADE_DATE), run_col)


def settlement_date_mismatches(front, back, run_col=None) -> DataFrame:
    return field_mismatches(front, back, _rule(C.SETTLEMENT_DATE), run_col)


def currency_mismatches(front, back, run_col=None) -> DataFrame:
    return field_mismatches(front, back, _rule(C.CURRENCY), run_col)


def breaks_one_by_one(front: DataFrame, back: DataFrame, run_col: str | None = None) -> DataFrame:
    """Bag union of the nine single-type detectors: nine passes, kept to check ``all_breaks``.

    Every pass is written down before the next begins: nine of them at once would shuffle the feeds
    onto disk nine times.
    """
    parts = [
        missing_trades(front, back, run_col),
        unexpected_trades(front, back, run_col),
        duplicate_trades(back, run_col),
        *[field_mismatches(front, back, rule, run_col) for rule in field_rules()],
    ]
    return reduce(DataFrame.unionByName, [written(part, "detected") for part in parts])


# --- all break types in one pass -----------------------------------------------------------------


def all_breaks(
    front: DataFrame,
    back: DataFrame,
    run_col: str | None = None,
    rules: Sequence[FieldRule] | None = None,
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """All nine break types from one full outer join of the feeds.

    Each feed is shuffled once, with the compared columns only. Pairs without any difference are
    dropped before the break rows are built, and equal breaks are merged by all their columns, so
    neither the join nor the merge depends on a single id being rare.
    """
    keys = _keys(run_col)
    rules = list(rules) if rules is not None else field_rules()
    columns = [r.column for r in rules]

    # FO rows without an id are missing trades, each on its own; they take no part in the join.
    absent_id = any_null(keys)
    bo, fo, on = salted(
        back.select(*keys, *columns), front.select(*keys, *columns).filter(~absent_id), keys, policy
    )
    # Without hot ids, a window over the join keys counts the copies: the join needs the same shuffle
    # and sort. A hot id must not meet in one window; then a separate aggregate counts.
    counted = on == keys
    if counted:
        bo = bo.withColumn("_entries", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    fo = fo.select(*on, F.struct(REPEATED, *columns).alias("_fo"))
    bo = bo.select(*on, F.struct(*columns, *(["_entries"] if counted else [])).alias("_bo"))
    joined = fo.join(bo, on, "full_outer")

    # An FO row repeated for a hot id has BO rows by definition, only not in every salt.
    missing = F.col("_bo").isNull() & ~F.col(f"_fo.{REPEATED}")
    unexpected = F.col("_fo").isNull()

    def entry(hit: Column, break_type: str, expected: Column, actual: Column) -> Column:
        return F.when(
            hit,
            F.struct(
                F.lit(break_type).alias("Break_Type"),
                expected.alias("Expected_Value"),
                actual.alias("Actual_Value"),
            ),
        )

    hits = [missing, unexpected]
    entries = [
        entry(missing, C.MISSING, F.lit(C.MISSING_EXPECTED), F.lit(C.MISSING_ACTUAL)),
        entry(unexpected, C.UNEXPECTED, F.lit(C.UNEXPECTED_EXPECTED), F.lit(C.UNEXPECTED_ACTUAL)),
    ]
    if counted:
        repeated = F.coalesce(F.col("_bo._entries") > 1, F.lit(False))
        hits.append(repeated)
        entries.append(entry(repeated, C.DUPLICATE, F.lit(C.DUPLICATE_EXPECTED), _entries_text(F.col("_bo._entries"))))
    for rule in rules:
        front_value, back_value = F.col(f"_fo.{rule.column}"), F.col(f"_bo.{rule.column}")
        hit = F.coalesce(rule.differs(front_value, back_value), F.lit(False))
        hits.append(hit)
        entries.append(entry(hit, rule.break_type, rule.as_text(front_value), rule.as_text(back_value)))

    found = (
        joined.filter(reduce(lambda a, b: a | b, hits))
        .select(*keys, F.explode(F.array(*entries)).alias("_break"))
        .filter(F.col("_break").isNotNull())
        .select(*keys, "_break.*")
    )
    identity = [*keys, "Break_Type", "Expected_Value", "Actual_Value"]
    merged = found.groupBy(*identity).agg(F.count(F.lit(1)).alias("_copies"))
    # Missing trades are listed once per FO row, all others once. The copies are spelled out in
    # steps, so that no long array is built even for a feed with many rows of one missing id.
    step = 10_000
    last = F.when(F.col("Break_Type") == C.MISSING, F.col("_copies")).otherwise(F.lit(1)) - 1
    pairwise = (
        merged.withColumn("_last", last)
        .withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_last"), F.lit(step).cast("long"))))
        .withColumn("_copy", F.explode(F.sequence("_from", F.least(F.col("_from") + step - 1, F.col("_last")))))
        .select(*identity, severity_of(F.col("Break_Type")).alias("Severity"))
    )
    without_id = _labelled(
        front.select(*keys).filter(absent_id),
        keys,
        C.MISSING,
        F.lit(C.MISSING_EXPECTED),
        F.lit(C.MISSING_ACTUAL),
    )
    found = pairwise.unionByName(without_id)
    return found if counted else found.unionByName(duplicate_trades(back, run_col))
