from __future__ import annotations

import datetime as dt
import os
import sys

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from breakwater import constants as C  # noqa: E402
from breakwater.operators.skew import SkewPolicy  # noqa: E402

DATA = "/root/testdata"

# Looks at every row and calls a key hot from its third row on.
TOUCHY = SkewPolicy(share=0.0, min_rows=3, fraction=1)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_dir():
    return f"{DATA}/sf0.001"


@pytest.fixture(scope="session")
def medium_dir():
    return f"{DATA}/sf0.01"


DEFAULT_TRADE = {
    "Trade_ID": "T1",
    "Trade_Date": dt.date(2024, 1, 2),
    "Settlement_Date": dt.date(2024, 1, 4),
    "Trader": "Ann",
    "Desk": "Rates",
    "Portfolio": "P1",
    "Counterparty": "Bank A",
    "Asset_Class": "Bond",
    "Symbol": "XYZ",
    "Buy_Sell": "BUY",
    "Quantity": 100,
    "Price": 10.0,
    "Currency": "USD",
    "Trade_Status": "BOOKED",
}


@pytest.fixture(scope="session")
def feed(spark):
    """Builds a feed from partial rows; ``Run_ID`` is added when a row names one."""

    def build(*rows: dict):
        full = [{**DEFAULT_TRADE, **r} for r in rows]
        fields = list(C.FEED_SCHEMA.fields)
        if any(C.RUN in r for r in rows):
            fields.append(T.StructField(C.RUN, T.StringType()))
        schema = T.StructType(fields)
        return spark.createDataFrame([tuple(r.get(f.name) for f in fields) for r in full], schema)

    return build


@pytest.fixture(scope="session")
def breaks_of():
    """Collects breaks as sorted (id, type, expected, actual) tuples."""

    def rows(df, *columns):
        columns = columns or ("Trade_ID", "Break_Type", "Expected_Value", "Actual_Value")
        return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)

    return rows
