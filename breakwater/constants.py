"""Fixed values of the trade-control domain.

Everything in this module is data: column lists, domains, labels and thresholds whose exact text
has to be kept so that results stay comparable between systems.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: feed layout -------------------------------------------------------------------
FEED_SCHEMA = T.StructType(
    [
        T.StructField("Trade_ID", T.StringType()),
        T.StructField("Trade_Date", T.DateType()),
        T.StructField("Settlement_Date", T.DateType()),
        T.StructField("Trader", T.StringType()),
        T.StructField("Desk", T.StringType()),
        T.StructField("Portfolio", T.StringType()),
        T.StructField("Counterparty", T.StringType()),
        T.StructField("Asset_Class", T.StringType()),
        T.StructField("Symbol", T.StringType()),
        T.StructField("Buy_Sell", T.StringType()),
        T.StructField("Quantity", T.LongType()),
        T.StructField("Price", T.DoubleType()),
        T.StructField("Currency", T.StringType()),
        T.StructField("Trade_Status", T.StringType()),
    ]
)
FEED_COLUMNS = FEED_SCHEMA.names

# --- fixed values: domains -----------------------------------------------------------------------
CURRENCIES = ["USD", "EUR", "GBP", "JPY", "INR"]
TRADE_STATUSES = ["BOOKED", "CONFIRMED", "SETTLED", "PENDING"]
SIDES = ["BUY", "SELL"]
SEVERITIES = ["CRITICAL", "HIGH", "MEDIUM", "LOW"]
RESOLUTION_STATUSES = ["UNRESOLVED", "RESOLVED", "ESCALATED", "UNDER_REVIEW"]

# --- fixed values: break types, their severity and their labels ----------------------------------
MISSING = "Missing Trade"
UNEXPECTED = "Unexpected Trade"
DUPLICATE = "Duplicate Trade"
PRICE = "Price Mismatch"
QUANTITY = "Quantity Mismatch"
STATUS = "Status Mismatch"
TRADE_DATE = "Trade Date Mismatch"
SETTLEMENT_DATE = "Settlement Date Mismatch"
CURRENCY = "Currency Mismatch"

SEVERITY_BY_BREAK = {
    MISSING: "CRITICAL",
    UNEXPECTED: "CRITICAL",
    DUPLICATE: "HIGH",
    QUANTITY: "HIGH",
    PRICE: "MEDIUM",
    CURRENCY: "MEDIUM",
    STATUS: "LOW",
    TRADE_DATE: "LOW",
    SETTLEMENT_DATE: "LOW",
}
DEFAULT_SEVERITY = "MEDIUM"
BREAK_TYPES = list(SEVERITY_BY_BREAK)

MISSING_EXPECTED, MISSING_ACTUAL = "Present in BO", "Missing in BO"
UNEXPECTED_EXPECTED, UNEXPECTED_ACTUAL = "Absent in BO", "Present in BO"
DUPLICATE_EXPECTED, DUPLICATE_ACTUAL = "Single Trade", "Duplicate Entry in BO"

# --- fixed values: thresholds --------------------------------------------------------------------
PRICE_TOLERANCE = 0.01
MATCH_RATE_TARGET = 95
EXCEPTION_RATE_ALERT = 5

# --- fixed values: labels used when neither feed knows a trade ------------------------------------
ENRICHMENT_DEFAULTS = {
    "Trader": "N/A",
    "Desk": "Unassigned",
    "Portfolio": "Unassigned",
    "Counterparty": "Unassigned",
    "Asset_Class": "Unassigned",
    "Symbol": "N/A",
    "Buy_Sell": "N/A",
    "Currency": "USD",
}

# --- fixed values: defaults of a resolution request ------------------------------------------------
DEFAULT_ACTION = {
    "New_Status": "RESOLVED",
    "Reason": "Approved by Product Control",
    "Action_By": "Product Controller",
    "Notes": "",
}

# --- fixed values: defaults of a free-form trade record ---------------------------------------------
TRADE_RECORD_DEFAULTS = {
    "trade_id": "",
    "counterparty": "",
    "asset_class": "",
    "quantity": 0.0,
    "price": 0.0,
    "currency": "USD",
    "trade_date": "",
    "settlement_date": "",
    "trader_id_or_book": "DEFAULT_DESK",
    "source_system": "FRONT_OFFICE",
    "status": "NEW",
}
TRADE_RECORD_REQUIRED = [
    "trade_id",
    "counterparty",
    "asset_class",
    "quantity",
    "price",
    "currency",
    "trade_date",
]

# --- fixed values: run-summary columns counted per break type and per severity ----------------------
RUN_COUNT_COLUMNS = {
    MISSING: "Missing_Count",
    UNEXPECTED: "Unexpected_Count",
    PRICE: "Price_Mismatch_Count",
    QUANTITY: "Quantity_Mismatch_Count",
    STATUS: "Status_Mismatch_Count",
    TRADE_DATE: "Trade_Date_Mismatch_Count",
    SETTLEMENT_DATE: "Settlement_Date_Mismatch_Count",
    CURRENCY: "Currency_Mismatch_Count",
    DUPLICATE: "Duplicate_Count",
}
SEVERITY_COUNT_COLUMNS = {
    "CRITICAL": "Critical_Breaks",
    "HIGH": "High_Breaks",
    "MEDIUM": "Medium_Breaks",
    "LOW": "Low_Breaks",
}
DIMENSIONS = ["Desk", "Portfolio", "Counterparty", "Asset_Class"]

# --- fixed values: header of the filtered-breaks extract (Field_Name has no source, stays empty) -----
FILTERED_EXTRACT_COLUMNS = [
    "Break_ID",
    "Run_ID",
    "Trade_ID",
    "Break_Type",
    "Severity",
    "Field_Name",
    "Expected_Value",
    "Actual_Value",
    "Trader",
    "Desk",
    "Portfolio",
    "Counterparty",
    "Asset_Class",
    "Resolution_Status",
    "Resolution_Reason",
]

# Name of the column that tells reconciliation runs apart in feeds, breaks and summaries.
RUN = "Run_ID"

#: The names of the analytics datasets.
DATASETS = [
    "reconciliation_runs",
    "reconciliation_breaks",
    "trade_details",
    "desk_summary",
    "portfolio_summary",
    "counterparty_summary",
    "asset_class_summary",
    "severity_summary",
    "break_type_summary",
]
