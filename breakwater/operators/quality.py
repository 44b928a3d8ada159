"""Feed validation: one pass per feed for all row rules, anti joins for references."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from breakwater import constants as C
from breakwater.operators.skew import DEFAULT, SkewPolicy, salted_lookup
from breakwater.sources.shared import short_lived_shuffles


class FeedRejected(ValueError):
    """A feed that must not be loaded or reconciled."""


def missing_columns(df: DataFrame, required: Sequence[str] = tuple(C.FEED_COLUMNS)) -> list[str]:
    return [c for c in required if c not in df.columns]


def _outside(column: str, domain: Sequence[str]) -> Column:
    # NULL is outside of every domain.
    return ~F.coalesce(F.col(column).isin(list(domain)), F.lit(False))


def row_rules(
    currencies: Sequence[str] = tuple(C.CURRENCIES), statuses: Sequence[str] = tuple(C.TRADE_STATUSES)
) -> dict[str, Column]:
    """Rule name -> condition that marks a row as violating it."""
    not_null = {
        f"{c}_MISSING": F.col(c).isNull()
        for c in C.FEED_COLUMNS
        if c not in ("Trade_ID", "Currency", "Trade_Status")
    }
    return {
        "TRADE_ID_BLANK": F.col("Trade_ID").isNull() | (F.trim("Trade_ID") == ""),
        "QUANTITY_NOT_POSITIVE": F.col("Quantity") <= 0,
        "PRICE_NOT_POSITIVE": F.col("Price") <= 0,
        # A notional needs a price that fits its decimal; NaN and infinities don't.
        "PRICE_OUT_OF_RANGE": F.col("Price").isNotNull() & F.col("Price").try_cast("decimal(20,8)").isNull(),
        "CURRENCY_OUTSIDE_DOMAIN": _outside("Currency", currencies),
        "STATUS_OUTSIDE_DOMAIN": _outside("Trade_Status", statuses),
        "SETTLED_BEFORE_TRADED": F.col("Settlement_Date") < F.col("Trade_Date"),
        **{name.upper(): cond for name, cond in not_null.items()},
    }


def violations(feed: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """(Rule, Violations), one row per rule, from a single scan without a shuffle of rows."""
    rules = rules or row_rules()
    counted = feed.agg(*[F.count(F.when(cond, F.lit(1))).alias(name) for name, cond in rules.items()])
    return _unpivot(counted, list(rules), "Rule", "Violations")


def null_counts(feed: DataFrame, columns: Sequence[str] = tuple(C.FEED_COLUMNS)) -> DataFrame:
    """(Column_Name, Null_Count)."""
    counted = feed.agg(*[F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(c) for c in columns])
    return _unpivot(counted, list(columns), "Column_Name", "Null_Count")


def _unpivot(one_row: DataFrame, columns: Sequence[str], name: str, value: str) -> DataFrame:
    return one_row.unpivot([], list(columns), name, value)


def outside_domain(feed: DataFrame, column: str, domain: Iterable[str]) -> DataFrame:
    """Values that are not in the domain, with their row counts."""
    return (
        feed.filter(_outside(column, list(domain))).groupBy(column).agg(F.count(F.lit(1)).alias("Row_Count"))
    )


def duplicate_ids(feed: DataFrame, run_col: str | None = None) -> DataFrame:
    """Ids that occur more than once (per run)."""
    keys = [run_col, "Trade_ID"] if run_col else ["Trade_ID"]
    return feed.groupBy(*keys).agg(F.count(F.lit(1)).alias("Row_Count")).filter(F.col("Row_Count") > 1)


def orphans(children: DataFrame, parents: DataFrame, key: str, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Child rows whose key has no parent row."""
    return salted_lookup(children, parents.select(key).distinct(), [key], "left_anti", policy)


def orphan_counts(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Keys without a parent and how many child rows hang on each; only counts travel to the join."""
    counts = children.groupBy(key).agg(F.count(F.lit(1)).alias("Row_Count"))
    return counts.join(parents.select(key).distinct(), [key], "left_anti")


def require_columns(df: DataFrame, source: str) -> None:
    absent = missing_columns(df)
    if absent:
        raise FeedRejected(f"{source}: missing columns {absent}")


def require_rows(df: DataFrame, source: str) -> None:
    if df.isEmpty():
        raise FeedRejected(f"{source}: no rows")


def require_valid(
    feed: DataFrame,
    source: str,
    currencies: Sequence[str] = tuple(C.CURRENCIES),
    statuses: Sequence[str] = tuple(C.TRADE_STATUSES),
) -> None:
    """Rejects the whole feed, naming every violated load rule.

    All row rules are load rules but the order of the two dates, which is only reported.
    """
    require_columns(feed, source)
    rules = row_rules(currencies, statuses)
    del rules["SETTLED_BEFORE_TRADED"]
    broken = violations(feed, rules).filter(F.col("Violations") > 0).collect()  # one row per rule
    if broken:
        raise FeedRejected(f"{source}: " + ", ".join(f"{r['Rule']} ({r['Violations']})" for r in broken))


def require_unique_ids(feed: DataFrame, source: str, run_col: str | None = None) -> None:
    with short_lived_shuffles(feed.sparkSession):
        repeated = duplicate_ids(feed, run_col).take(1)
    if repeated:
        raise FeedRejected(f"{source}: Trade_ID {repeated[0]['Trade_ID']!r} is not unique")
