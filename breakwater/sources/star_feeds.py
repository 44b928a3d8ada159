"""Front- and back-office feeds derived from an order/line star schema.

The FO feed is one trade per order line; the BO feed is the FO feed seen through a deterministic
set of booking faults. Which rows are hit follows from two integer buckets of the line's key, so the
feeds can be rebuilt anywhere, in SQL too.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from breakwater import constants as C
from breakwater.operators import perturb

PERIOD = "Feed_Month"
BUCKETS = ["Fault_Bucket", "Fault_Variant"]

# --- fixed values: which buckets (of 1,000) carry which fault -----------------------------------------
FAULT_BUCKETS = {
    "missing": (0, 17),
    "unexpected": (18, 29),
    "price": (30, 45),
    "quantity": (46, 55),
    "status": (56, 64),
    "trade_date": (65, 71),
    "settlement_date": (72, 76),
    "currency": (77, 84),
    "duplicate": (85, 88),
    "price_inside_tolerance": (89, 92),
    "price_on_tolerance": (93, 96),
}
PRICE_AND_STATUS_VARIANTS = (0, 4)  # variants of a price fault that also carry a status fault
DIFFERING_DUPLICATE = 88            # the second copy differs in price as well
UNEXPECTED_PREFIX = "UNX_"
#: Order lines that one part of the FO feed is made from, about; what a part shuffles lies on disk meanwhile.
LINES_AT_ONCE = 16_000_000


def hit(fault: str) -> Column:
    return F.col("Fault_Bucket").between(*FAULT_BUCKETS[fault])


def fault_bucket(order: Column, part: Column, supplier: Column, line: Column) -> Column:
    return (order * 7919 + part * 104729 + supplier * 1299709 + line * 31) % 1000


def fault_variant(order: Column, part: Column, supplier: Column, line: Column) -> Column:
    return (order * 31 + part * 17 + supplier * 13 + line) % 50


def key_parts(trade_id: Column) -> list[Column]:
    """The four integers inside a trade id, with or without the prefix of a BO-only trade."""
    parts = F.split(trade_id, "_")
    return [F.element_at(parts, i).cast("long") for i in (-4, -3, -2, -1)]


def front_office_parts(spark: SparkSession, sf_dir: str) -> Iterator[DataFrame]:
    """The FO feed in parts of whole orders, as many as the order lines ask for."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()  # from the footers of the files
    parts = max(1, -(-lines // LINES_AT_ONCE))
    return (front_office(spark, sf_dir, part, parts) for part in range(parts))


def front_office(spark: SparkSession, sf_dir: str, part: int = 0, parts: int = 1) -> DataFrame:
    """FO feed with its period and the two fault buckets; or one of several parts, told apart by order."""

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    def of_part(rows: DataFrame, order: str) -> DataFrame:
        # Joins are by order first, so lines meet the same orders in a part as in the whole.
        return rows if parts == 1 else rows.filter(F.pmod(F.xxhash64(F.col(order).cast("long")), F.lit(parts)) == part)

    line_key = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    # A total order, so that every engine keeps the same row of a repeated key. Spark applies a
    # filter on row_number before the shuffle too, so a hot key sends one row per task.
    first = Window.partitionBy(*line_key).orderBy(
        "l_shipdate", "l_extendedprice", "l_quantity", "l_returnflag", "l_linestatus"
    )
    lines = (
        of_part(table("lineitem"), "l_orderkey")
        .select(
            *line_key, "l_shipdate", "l_extendedprice", "l_quantity", "l_returnflag", "l_linestatus"
        )
        .withColumn("_rank", F.row_number().over(first))
        .filter(F.col("_rank") == 1)
        .drop("_rank", "l_shipdate", "l_extendedprice")
    )
    # What an order tells is put together before its lines are, of which there are several times as many.
    orders = (
        of_part(table("orders"), "o_orderkey")
        .join(table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    joined = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    key = [F.col(c).cast("long") for c in line_key]
    traded = F.col("o_orderdate").cast("date")
    status = (
        F.when(F.col("l_linestatus") == "O", "BOOKED")
        .when(F.col("o_orderstatus") == "F", "SETTLED")
        .when(F.col("o_orderstatus") == "P", "PENDING")
        .when(F.col("o_orderstatus") == "O", "CONFIRMED")
    )
    currencies = F.array(*[F.lit(c) for c in C.CURRENCIES])
    return joined.select(
        F.concat_ws("_", F.lit("TRD"), *key).alias("Trade_ID"),
        traded.alias("Trade_Date"),
        F.date_add(traded, (1 + fault_bucket(*key) % 3).cast("int")).alias("Settlement_Date"),
        F.col("s_name").alias("Trader"),
        F.col("c_mktsegment").alias("Desk"),
        F.col("p_brand").alias("Portfolio"),
        F.col("n_name").alias("Counterparty"),
        F.col("p_type").alias("Asset_Class"),
        F.col("p_name").alias("Symbol"),
        F.when(F.col("l_returnflag") == "R", "SELL").otherwise("BUY").alias("Buy_Sell"),
        F.col("l_quantity").cast("long").alias("Quantity"),
        F.col("p_retailprice").alias("Price"),
        F.get(currencies, F.col("n_regionkey")).alias("Currency"),
        status.alias("Trade_Status"),
        (F.year(traded) * 100 + F.month(traded)).cast("int").alias(PERIOD),
        fault_bucket(*key).cast("int").alias("Fault_Bucket"),
        fault_variant(*key).cast("int").alias("Fault_Variant"),
    )


def back_office(front: DataFrame) -> DataFrame:
    """BO feed: every injection of ``perturb`` applied to the FO feed, which collapses to one projection."""
    second = F.col("Copy") == 2
    bo = perturb.drop_rows(front, hit("missing"))
    bo = perturb.copy_rows(bo, hit("unexpected") | hit("duplicate"), "Copy")
    bo = perturb.rename_ids(bo, hit("unexpected") & second, UNEXPECTED_PREFIX)
    bo = perturb.scale_price(bo, hit("price"), F.lit(1.08))
    bo = perturb.add_to_price(bo, (F.col("Fault_Bucket") == DIFFERING_DUPLICATE) & second, 1.0)
    bo = perturb.add_to_price(bo, hit("price_inside_tolerance"), 0.005)
    bo = perturb.add_to_price(bo, hit("price_on_tolerance"), 0.01)
    bo = perturb.add_to_quantity(bo, hit("quantity"), F.lit(100))
    both = hit("price") & F.col("Fault_Variant").between(*PRICE_AND_STATUS_VARIANTS)
    bo = perturb.replace_status(bo, hit("status") | both)
    bo = perturb.shift_trade_date(bo, hit("trade_date"), F.lit(2))
    bo = perturb.shift_settlement_date(bo, hit("settlement_date"), F.lit(3))
    bo = perturb.replace_currency(bo, hit("currency"))
    return bo.drop("Copy")


def injected_truth(front: DataFrame) -> DataFrame:
    """The breaks the faults of ``back_office`` are meant to cause, one row each."""
    bo = front
    both = hit("price") & F.col("Fault_Variant").between(*PRICE_AND_STATUS_VARIANTS)
    changes = {
        C.PRICE: (hit("price"), "Price", perturb.scaled_price(F.lit(1.08))),
        C.QUANTITY: (hit("quantity"), "Quantity", perturb.raised_quantity(F.lit(100))),
        C.STATUS: (hit("status") | both, "Trade_Status", perturb.other_status()),
        C.TRADE_DATE: (hit("trade_date"), "Trade_Date", F.date_sub("Trade_Date", 2)),
        C.SETTLEMENT_DATE: (hit("settlement_date"), "Settlement_Date", F.date_add("Settlement_Date", 3)),
        C.CURRENCY: (hit("currency"), "Currency", perturb.other_currency()),
    }
    differing = F.col("Fault_Bucket") == DIFFERING_DUPLICATE
    id_col = F.col("Trade_ID")
    entries = [
        perturb.truth_entry(hit("missing"), id_col, C.MISSING, F.lit(C.MISSING_EXPECTED), F.lit(C.MISSING_ACTUAL)),
        perturb.truth_entry(
            hit("unexpected"),
            F.concat(F.lit(UNEXPECTED_PREFIX), id_col),
            C.UNEXPECTED,
            F.lit(C.UNEXPECTED_EXPECTED),
            F.lit(C.UNEXPECTED_ACTUAL),
        ),
        perturb.truth_entry(
            hit("duplicate"),
            id_col,
            C.DUPLICATE,
            F.lit(C.DUPLICATE_EXPECTED),
            F.lit(C.DUPLICATE_ACTUAL + " (2)"),
        ),
        perturb.truth_field_entry(differing, C.PRICE, "Price", F.col("Price") + 1.0),
        *[perturb.truth_field_entry(cond, kind, col, new) for kind, (cond, col, new) in changes.items()],
    ]
    return perturb.truth_table(bo, entries)


def run_id() -> Column:
    """Run id of a backfill: one run per feed period."""
    return F.concat(F.lit("REC_"), F.col(PERIOD).cast("string"))


def period_of_run() -> Column:
    """The feed period a backfilled run belongs to."""
    return F.substring(C.RUN, 5, 6).cast("int")


def as_of() -> Column:
    """Time stamp of a backfilled run: the last day of its month."""
    return F.last_day(F.to_date(F.substring(C.RUN, 5, 6), "yyyyMM")).cast("timestamp_ntz")
