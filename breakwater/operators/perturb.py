"""Deterministic fault injection on a feed, for testing controls against a known truth.

Every function takes the rows to hit as a boolean column and changes nothing else. They are plain
projections, so any chain of them costs one pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from breakwater import constants as C
from breakwater.functions import plain_price, severity_of

MIN_QUANTITY = 10


def _set(feed: DataFrame, hit: Column, column: str, value: Column) -> DataFrame:
    return feed.withColumn(column, F.when(hit, value).otherwise(F.col(column)))


# --- rows ---------------------------------------------------------------------------------------------


def drop_rows(feed: DataFrame, hit: Column) -> DataFrame:
    """Missing trades."""
    return feed.filter(~hit)


def copy_rows(feed: DataFrame, hit: Column, copy_col: str) -> DataFrame:
    """A second copy of the hit rows; ``copy_col`` numbers the copies."""
    numbers = F.when(hit, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return feed.withColumn(copy_col, F.explode(numbers))


def rename_ids(feed: DataFrame, hit: Column, prefix: str) -> DataFrame:
    """Turns rows into trades only this feed knows; such rows arrive as BOOKED."""
    renamed = _set(feed, hit, "Trade_Status", F.lit("BOOKED"))
    return _set(renamed, hit, "Trade_ID", F.concat(F.lit(prefix), F.col("Trade_ID")))


def add_unexpected(feed: DataFrame, hit: Column, prefix: str) -> DataFrame:
    """Unexpected trades: a renamed copy of each hit row."""
    return rename_ids(copy_rows(feed, hit, "_copy"), hit & (F.col("_copy") == 2), prefix).drop("_copy")


def duplicate_rows(feed: DataFrame, hit: Column) -> DataFrame:
    """Duplicate trades: an exact second copy of each hit row."""
    return copy_rows(feed, hit, "_copy").drop("_copy")


# --- new values -----------------------------------------------------------------------------------------


def scaled_price(factor: Column) -> Column:
    """Price x factor, rounded half up to cents in decimals."""
    scaled = F.col("Price").cast("decimal(18,2)") * factor.cast("decimal(4,2)")
    return scaled.cast("decimal(18,2)").cast("double")


def raised_quantity(delta: Column) -> Column:
    return F.greatest(F.lit(MIN_QUANTITY).cast("long"), F.col("Quantity") + delta)


def other_status() -> Column:
    return F.when(F.col("Trade_Status") == "SETTLED", "PENDING").otherwise("SETTLED")


def other_currency() -> Column:
    return F.when(F.col("Currency") == "USD", "EUR").otherwise("USD")


# --- fields ---------------------------------------------------------------------------------------------


def scale_price(feed: DataFrame, hit: Column, factor: Column) -> DataFrame:
    return _set(feed, hit, "Price", scaled_price(factor))


def add_to_price(feed: DataFrame, hit: Column, amount: float) -> DataFrame:
    return _set(feed, hit, "Price", F.col("Price") + F.lit(amount))


def add_to_quantity(feed: DataFrame, hit: Column, delta: Column) -> DataFrame:
    return _set(feed, hit, "Quantity", raised_quantity(delta))


def replace_status(feed: DataFrame, hit: Column) -> DataFrame:
    return _set(feed, hit, "Trade_Status", other_status())


def shift_trade_date(feed: DataFrame, hit: Column, days_back: Column) -> DataFrame:
    return _set(feed, hit, "Trade_Date", F.date_sub("Trade_Date", days_back.cast("int")))


def shift_settlement_date(feed: DataFrame, hit: Column, days_on: Column) -> DataFrame:
    return _set(feed, hit, "Settlement_Date", F.date_add("Settlement_Date", days_on.cast("int")))


def replace_currency(feed: DataFrame, hit: Column) -> DataFrame:
    return _set(feed, hit, "Currency", other_currency())


# --- truth ----------------------------------------------------------------------------------------------


def truth_entry(hit: Column, trade_id: Column, break_type: str, expected: Column, actual: Column) -> Column:
    return F.when(
        hit,
        F.struct(
            trade_id.alias("Trade_ID"),
            F.lit(break_type).alias("Break_Type"),
            expected.alias("Expected_Value"),
            actual.alias("Actual_Value"),
        ),
    )


def truth_field_entry(hit: Column, break_type: str, column: str, new_value: Column) -> Column:
    show = plain_price if column == "Price" else (lambda c: c.cast("string"))
    return truth_entry(hit, F.col("Trade_ID"), break_type, show(F.col(column)), show(new_value))


def truth_table(feed: DataFrame, entries: Sequence[Column]) -> DataFrame:
    """One row per injected fault."""
    return (
        feed.select(F.explode(F.array(*entries)).alias("_fault"))
        .filter(F.col("_fault").isNotNull())
        .select("_fault.*")
        .withColumn("Severity", severity_of(F.col("Break_Type")))
    )


def injected_counts(truth: DataFrame) -> DataFrame:
    return truth.groupBy("Break_Type").agg(F.count(F.lit(1)).alias("Injected"))
