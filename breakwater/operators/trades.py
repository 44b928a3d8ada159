"""Projections of the trade population."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from breakwater import constants as C
from breakwater.functions import notional, to_money


def trade_details(feed: DataFrame) -> DataFrame:
    """Feed rows with the notional of the trade."""
    return feed.select(
        *C.FEED_COLUMNS, to_money(notional(F.col("Quantity"), F.col("Price"))).alias("Trade_Notional")
    )


def trade_records(rows: DataFrame) -> DataFrame:
    """Loosely typed rows as trade records: missing or unreadable fields take their defaults.

    Numbers are read with ``try_cast``; the notional is quantity x price to four places, NULL where
    one of them is beyond its decimal.
    """

    def field(name: str) -> Column:
        default = C.TRADE_RECORD_DEFAULTS[name]
        if name not in rows.columns:
            return F.lit(default)
        kind = "double" if isinstance(default, float) else "string"
        return F.coalesce(F.col(name).try_cast(kind), F.lit(default))

    records = rows.select(*[field(n).alias(n) for n in C.TRADE_RECORD_DEFAULTS])
    amount = F.col("price").try_cast("decimal(20,8)") * F.col("quantity").try_cast("decimal(17,4)")
    return records.withColumn("notional_amount", to_money(amount, 4))


def as_record(feed: DataFrame, source_system: str) -> DataFrame:
    """A feed under the snake_case names of a trade record."""
    return feed.select(
        F.col("Trade_ID").alias("trade_id"),
        F.col("Counterparty").alias("counterparty"),
        F.col("Asset_Class").alias("asset_class"),
        F.col("Quantity").alias("quantity"),
        F.col("Price").alias("price"),
        F.col("Currency").alias("currency"),
        F.col("Trade_Date").cast("string").alias("trade_date"),
        F.col("Settlement_Date").cast("string").alias("settlement_date"),
        F.lit(source_system).alias("source_system"),
        F.col("Trade_Status").alias("status"),
    )


def is_valid_record() -> Column:
    """A record needs an id and a positive quantity and price."""
    return (F.trim("trade_id") != "") & (F.col("quantity") > 0) & (F.col("price") > 0)
