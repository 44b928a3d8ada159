"""The registered queries as single SQL statements over the source tables, for checking results."""

from __future__ import annotations

from breakwater import constants as C

FEED = ", ".join(C.FEED_COLUMNS)


def _list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _price_text(value: str) -> str:
    digits = f"rtrim(CAST(CAST({value} AS DECIMAL(28,10)) AS VARCHAR), '0')"
    return f"CASE WHEN {digits} LIKE '%.' THEN {digits} || '0' ELSE {digits} END"


def _notional(quantity: str = "Quantity", price: str = "Price") -> str:
    return f"abs(CAST({price} AS DECIMAL(20,8)) * CAST({quantity} AS DECIMAL(17,0)))"


def _money(amount: str, places: int = 2) -> str:
    return f"CAST(round({amount}, {places}) AS DOUBLE)"


def _percent(part: str, whole: str) -> str:
    return (
        f"CASE WHEN {whole} > 0 THEN CAST((20000 * CAST({part} AS BIGINT) + CAST({whole} AS BIGINT)) "
        f"// (2 * CAST({whole} AS BIGINT)) AS DOUBLE) / 100.0 ELSE 0.0 END"
    )


def _severity(kind: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{s}'" for k, s in C.SEVERITY_BY_BREAK.items())
    return f"CASE {kind} {whens} ELSE '{C.DEFAULT_SEVERITY}' END"


def _rank(severity: str) -> str:
    whens = " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(C.SEVERITIES, start=1))
    return f"CASE {severity} {whens} ELSE {len(C.SEVERITIES) + 1} END"


def _count(condition: str, name: str) -> str:
    return f"count(CASE WHEN {condition} THEN 1 END) AS {name}"


def _count_critical() -> str:
    return _count("Severity = 'CRITICAL'", "Critical_Breaks")


_OTHER_STATUS = "CASE WHEN Trade_Status = 'SETTLED' THEN 'PENDING' ELSE 'SETTLED' END"
_OTHER_CURRENCY = "CASE WHEN Currency = 'USD' THEN 'EUR' ELSE 'USD' END"


def _scaled(factor: str) -> str:
    return (
        f"CAST(CAST(CAST(Price AS DECIMAL(18,2)) * CAST({factor} AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS DOUBLE)"
    )


# --- building blocks, in the order they depend on each other -------------------------------------------

_BLOCKS: dict[str, str] = {}

_BLOCKS["fo"] = """
    SELECT 'TRD_' || l_orderkey || '_' || l_partkey || '_' || l_suppkey || '_' || l_linenumber AS Trade_ID,
           d AS Trade_Date, CAST(d + INTERVAL 1 DAY * CAST(1 + k % 3 AS INTEGER) AS DATE) AS Settlement_Date,
           s_name AS Trader, c_mktsegment AS Desk, p_brand AS Portfolio, n_name AS Counterparty,
           p_type AS Asset_Class, p_name AS Symbol,
           CASE WHEN l_returnflag = 'R' THEN 'SELL' ELSE 'BUY' END AS Buy_Sell,
           CAST(l_quantity AS BIGINT) AS Quantity, p_retailprice AS Price,
           CASE n_regionkey WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP'
                            WHEN 3 THEN 'JPY' WHEN 4 THEN 'INR' END AS Currency,
           CASE WHEN l_linestatus = 'O' THEN 'BOOKED' WHEN o_orderstatus = 'F' THEN 'SETTLED'
                WHEN o_orderstatus = 'P' THEN 'PENDING' WHEN o_orderstatus = 'O' THEN 'CONFIRMED' END AS Trade_Status,
           CAST(year(d) * 100 + month(d) AS INTEGER) AS Feed_Month, k, k2
    FROM (
        SELECT *, CAST(o_orderdate AS DATE) AS d,
               (l_orderkey * 7919 + l_partkey * 104729 + l_suppkey * 1299709 + l_linenumber * 31) % 1000 AS k,
               (l_orderkey * 31 + l_partkey * 17 + l_suppkey * 13 + l_linenumber) % 50 AS k2
        FROM (
            SELECT *, row_number() OVER (
                PARTITION BY l_orderkey, l_partkey, l_suppkey, l_linenumber
                ORDER BY l_shipdate, l_extendedprice, l_quantity, l_returnflag, l_linestatus) AS rn
            FROM lineitem) AS li
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey
        JOIN part ON l_partkey = p_partkey
        JOIN supplier ON l_suppkey = s_suppkey
        WHERE rn = 1) AS j
"""

_BLOCKS["bo"] = f"""
    SELECT CASE WHEN k BETWEEN 18 AND 29 AND copy = 2 THEN 'UNX_' || Trade_ID ELSE Trade_ID END AS Trade_ID,
           CASE WHEN k BETWEEN 65 AND 71 THEN CAST(Trade_Date - INTERVAL 2 DAY AS DATE)
                ELSE Trade_Date END AS Trade_Date,
           CASE WHEN k BETWEEN 72 AND 76 THEN CAST(Settlement_Date + INTERVAL 3 DAY AS DATE)
                ELSE Settlement_Date END AS Settlement_Date,
           Trader, Desk, Portfolio, Counterparty, Asset_Class, Symbol, Buy_Sell,
           CASE WHEN k BETWEEN 46 AND 55 THEN Quantity + 100 ELSE Quantity END AS Quantity,
           CASE WHEN k BETWEEN 30 AND 45 THEN {_scaled('1.08')}
                WHEN k = 88 AND copy = 2 THEN Price + CAST(1.0 AS DOUBLE)
                WHEN k BETWEEN 89 AND 92 THEN Price + CAST(0.005 AS DOUBLE)
                WHEN k BETWEEN 93 AND 96 THEN Price + CAST(0.01 AS DOUBLE)
                ELSE Price END AS Price,
           CASE WHEN k BETWEEN 77 AND 84 THEN {_OTHER_CURRENCY} ELSE Currency END AS Currency,
           CASE WHEN k BETWEEN 18 AND 29 AND copy = 2 THEN 'BOOKED'
                WHEN k BETWEEN 56 AND 64 OR (k BETWEEN 30 AND 45 AND k2 < 5) THEN {_OTHER_STATUS}
                ELSE Trade_Status END AS Trade_Status,
           Feed_Month
    FROM fo, (VALUES (1), (2)) AS copies(copy)
    WHERE k > 17 AND (copy = 1 OR k BETWEEN 18 AND 29 OR k BETWEEN 85 AND 88)
"""


def _mismatch(kind: str, column: str, tolerance: str | None = None) -> str:
    if column == "Price":
        condition = f"abs(f.Price - b.Price) > CAST({tolerance or C.PRICE_TOLERANCE} AS DOUBLE)"
        left, right = _price_text("f.Price"), _price_text("b.Price")
    else:
        condition = f"f.{column} <> b.{column}"
        left, right = f"CAST(f.{column} AS VARCHAR)", f"CAST(b.{column} AS VARCHAR)"
    return f"""
    SELECT DISTINCT f.Feed_Month, f.Trade_ID, '{kind}' AS Break_Type, {left} AS Expected_Value, {right} AS Actual_Value
    FROM fo AS f JOIN bo AS b ON f.Trade_ID = b.Trade_ID AND f.Feed_Month = b.Feed_Month WHERE {condition}
"""


_DETECTORS = {
    "missing_trades": f"""
    SELECT f.Feed_Month, f.Trade_ID, '{C.MISSING}' AS Break_Type,
           '{C.MISSING_EXPECTED}' AS Expected_Value, '{C.MISSING_ACTUAL}' AS Actual_Value
    FROM fo AS f
    WHERE NOT EXISTS (SELECT 1 FROM bo AS b WHERE b.Trade_ID = f.Trade_ID AND b.Feed_Month = f.Feed_Month)
""",
    "unexpected_trades": f"""
    SELECT DISTINCT b.Feed_Month, b.Trade_ID, '{C.UNEXPECTED}' AS Break_Type,
           '{C.UNEXPECTED_EXPECTED}' AS Expected_Value, '{C.UNEXPECTED_ACTUAL}' AS Actual_Value
    FROM bo AS b
    WHERE NOT EXISTS (SELECT 1 FROM fo AS f WHERE b.Trade_ID = f.Trade_ID AND b.Feed_Month = f.Feed_Month)
""",
    "duplicate_trades": f"""
    SELECT Feed_Month, Trade_ID, '{C.DUPLICATE}' AS Break_Type, '{C.DUPLICATE_EXPECTED}' AS Expected_Value,
           '{C.DUPLICATE_ACTUAL} (' || count(*) || ')' AS Actual_Value
    FROM bo GROUP BY Feed_Month, Trade_ID HAVING count(*) > 1
""",
    "price_mismatches": _mismatch(C.PRICE, "Price"),
    "quantity_mismatches": _mismatch(C.QUANTITY, "Quantity"),
    "status_mismatches": _mismatch(C.STATUS, "Trade_Status"),
    "trade_date_mismatches": _mismatch(C.TRADE_DATE, "Trade_Date"),
    "settlement_date_mismatches": _mismatch(C.SETTLEMENT_DATE, "Settlement_Date"),
    "currency_mismatches": _mismatch(C.CURRENCY, "Currency"),
}

_BLOCKS["found"] = " UNION ALL ".join(_DETECTORS.values())

_BLOCKS["breaks"] = f"""
    SELECT 'REC_' || Feed_Month AS Run_ID, Feed_Month, Trade_ID, Break_Type, Expected_Value, Actual_Value,
           {_severity('Break_Type')} AS Severity,
           md5('REC_' || Feed_Month || '|' || Trade_ID || '|' || Break_Type || '|' || Expected_Value || '|'
               || Actual_Value) AS Break_ID,
           CAST(last_day(make_date(Feed_Month // 100, Feed_Month % 100, 1)) AS TIMESTAMP) AS Detected_At
    FROM found
"""

_UNMATCHING = f"Break_Type NOT IN ('{C.UNEXPECTED}', '{C.DUPLICATE}')"
_TYPE_COUNTS = ", ".join(_count(f"Break_Type = '{k}'", c) for k, c in C.RUN_COUNT_COLUMNS.items())
_SEVERITY_COUNTS = ", ".join(_count(f"Severity = '{s}'", c) for s, c in C.SEVERITY_COUNT_COLUMNS.items())
_RUN_COUNTS = [*C.RUN_COUNT_COLUMNS.values(), *C.SEVERITY_COUNT_COLUMNS.values()]
_TOTAL = " + ".join(C.SEVERITY_COUNT_COLUMNS.values())


def _summary(group: str) -> str:
    """Run summary per value of a grouping expression over Feed_Month."""
    return f"""
    SELECT f.g AS Run_ID, f.n AS Front_Count, o.n AS Back_Count,
           greatest(0, f.n - coalesce(b.unmatched, 0)) AS Matched_Count,
           {', '.join(f'coalesce(b.{c}, 0) AS {c}' for c in _RUN_COUNTS)},
           {_percent('greatest(0, f.n - coalesce(b.unmatched, 0))', 'f.n')} AS Match_Percentage
    FROM (SELECT {group} AS g, count(*) AS n FROM fo GROUP BY 1) AS f
    JOIN (SELECT {group} AS g, count(*) AS n FROM bo GROUP BY 1) AS o ON f.g = o.g
    LEFT JOIN (
        SELECT {group} AS g, count(DISTINCT CASE WHEN {_UNMATCHING} THEN Trade_ID END) AS unmatched,
               {_TYPE_COUNTS}, {_SEVERITY_COUNTS}
        FROM breaks GROUP BY 1) AS b ON f.g = b.g
"""


_BLOCKS["runs"] = f"""
    SELECT *, CAST(last_day(make_date(CAST(substr(Run_ID, 5, 4) AS INTEGER), CAST(substr(Run_ID, 9, 2) AS INTEGER), 1))
                   AS TIMESTAMP) AS Created_At
    FROM ({_summary("'REC_' || Feed_Month")}) AS s
"""

_ONLY_MISSING = ", ".join(
    f"{'Front_Count - Back_Count' if c in (C.RUN_COUNT_COLUMNS[C.MISSING], C.SEVERITY_COUNT_COLUMNS[C.SEVERITY_BY_BREAK[C.MISSING]]) else '0'} AS {c}"
    for c in _RUN_COUNTS
)
# Second runs of a year whose BO rows were corrected to FO's, but for the missing ones.
_BLOCKS["corrected"] = f"""
    SELECT 'REC_' || Feed_Month || '_2' AS Run_ID, Front_Count, Back_Count, Back_Count AS Matched_Count, {_ONLY_MISSING},
           {_percent('Back_Count', 'Front_Count')} AS Match_Percentage,
           CAST(last_day(make_date(Feed_Month // 100, Feed_Month % 100, 1)) AS TIMESTAMP) AS Created_At
    FROM (SELECT Feed_Month, count(*) AS Front_Count, {_count("k > 17", "Back_Count")} FROM fo
          WHERE Feed_Month // 100 = 1996 GROUP BY Feed_Month) AS y
"""

_ATTRIBUTES = list(C.ENRICHMENT_DEFAULTS)
_BLOCKS["bo_first"] = f"""
    SELECT Feed_Month, Trade_ID, {', '.join(_ATTRIBUTES)}, Quantity, Price
    FROM (SELECT *, row_number() OVER (PARTITION BY Feed_Month, Trade_ID ORDER BY {', '.join(_ATTRIBUTES)}) AS rn FROM bo) AS b
    WHERE rn = 1
"""
_FILLED = ", ".join(
    f"coalesce(f.{a}, o.{a}, '{default}') AS {a}" for a, default in C.ENRICHMENT_DEFAULTS.items()
)
_BREAK = "b.Break_ID, b.Run_ID, b.Trade_ID, b.Break_Type, b.Expected_Value, b.Actual_Value, b.Severity, b.Detected_At"
_LOOKUP = """
    LEFT JOIN fo AS f ON b.Feed_Month = f.Feed_Month AND b.Trade_ID = f.Trade_ID
    LEFT JOIN {back} AS o ON b.Feed_Month = o.Feed_Month AND b.Trade_ID = o.Trade_ID
"""
_BLOCKS["enriched"] = f"SELECT {_BREAK}, {_FILLED} FROM breaks AS b {_LOOKUP.format(back='bo_first')}"

_BLOCKS["keyed"] = """
    SELECT *, (CAST(split_part(t, '_', 2) AS BIGINT) * 7919 + CAST(split_part(t, '_', 3) AS BIGINT) * 104729
               + CAST(split_part(t, '_', 4) AS BIGINT) * 1299709 + CAST(split_part(t, '_', 5) AS BIGINT) * 31) % 1000 AS k
    FROM (SELECT *, CASE WHEN Trade_ID LIKE 'UNX_%' THEN substr(Trade_ID, 5) ELSE Trade_ID END AS t FROM breaks) AS b
"""


def _step(hit: str, status: str, seq: int, key: str = "Break_ID") -> str:
    return (
        f"SELECT {key} AS Break_ID, Trade_ID, Detected_At, k, '{status}' AS status, {seq} AS Action_Seq "
        f"FROM keyed WHERE {hit}"
    )


_BLOCKS["requests"] = f"""
    SELECT Break_ID, Trade_ID, upper(status) AS New_Status, Action_Seq,
           CASE WHEN k % 2 = 1 THEN 'Checked with desk' ELSE '{C.DEFAULT_ACTION["Reason"]}' END AS Reason,
           CASE WHEN k % 4 <> 0 THEN 'Analyst ' || (k % 6) ELSE '{C.DEFAULT_ACTION["Action_By"]}' END AS Action_By,
           '' AS Notes, Detected_At + to_days(Action_Seq) AS Created_At,
           CASE WHEN Break_ID IS NULL THEN 'Missing break id' WHEN status = 'CLOSED' THEN 'Invalid status'
                WHEN Break_ID LIKE 'gone-%' THEN 'Unknown break' END AS Reject_Reason
    FROM (
        {_step("k % 5 = 1", "RESOLVED", 1)}
        UNION ALL {_step("k % 5 = 2", "ESCALATED", 1)}
        UNION ALL {_step("k % 5 = 3", "UNDER_REVIEW", 1)}
        UNION ALL {_step("k % 5 = 3", "RESOLVED", 2)}
        UNION ALL {_step("k % 5 = 4", "RESOLVED", 1)}
        UNION ALL {_step("k % 5 = 4", "UNRESOLVED", 2)}
        UNION ALL {_step("k % 50 = 7", "CLOSED", 3)}
        UNION ALL {_step("k % 50 = 8", "RESOLVED", 3, "'gone-' || Break_ID")}
        UNION ALL {_step("k % 50 = 9", "RESOLVED", 3, "CAST(NULL AS VARCHAR)")}) AS s
"""
_BLOCKS["actions"] = "SELECT * FROM requests WHERE Reject_Reason IS NULL"
_BLOCKS["state"] = """
    SELECT b.Break_ID, b.Run_ID, b.Trade_ID, b.Break_Type, b.Expected_Value, b.Actual_Value, b.Severity, b.Detected_At,
           coalesce(a.New_Status, 'UNRESOLVED') AS Resolution_Status, a.Reason AS Resolution_Reason,
           a.Action_By AS Resolved_By, a.Created_At AS Resolved_At
    FROM breaks AS b
    LEFT JOIN (
        SELECT *, row_number() OVER (PARTITION BY Break_ID ORDER BY Created_At DESC, Action_Seq DESC) AS rn
        FROM actions) AS a ON a.Break_ID = b.Break_ID AND a.rn = 1
"""
_BLOCKS["enriched_state"] = f"""
    SELECT e.*, s.Resolution_Status, s.Resolution_Reason, s.Resolved_By, s.Resolved_At
    FROM enriched AS e JOIN state AS s ON e.Break_ID = s.Break_ID
"""


def _defect(low: int, high: int, value: str) -> str:
    return f"WHEN k BETWEEN {low} AND {high} THEN {value}"


_BLOCKS["defective"] = f"""
    SELECT CASE WHEN k < 5 THEN ' ' {_defect(5, 9, 'NULL')} ELSE Trade_ID END AS Trade_ID, Trade_Date,
           CASE {_defect(50, 54, 'CAST(Trade_Date - INTERVAL 1 DAY AS DATE)')} ELSE Settlement_Date END AS Settlement_Date,
           CASE {_defect(55, 59, 'NULL')} ELSE Trader END AS Trader,
           Desk, Portfolio, Counterparty, Asset_Class, Symbol, Buy_Sell,
           CASE {_defect(10, 14, '-Quantity')} {_defect(15, 19, 'NULL')} ELSE Quantity END AS Quantity,
           CASE {_defect(20, 24, '0.0')} {_defect(25, 29, 'NULL')} {_defect(65, 69, '1e15')} ELSE Price END AS Price,
           CASE {_defect(30, 34, "'XXX'")} {_defect(35, 39, 'lower(Currency)')} ELSE Currency END AS Currency,
           CASE {_defect(40, 44, "'CANCELLED'")} {_defect(45, 49, 'NULL')} ELSE Trade_Status END AS Trade_Status, k
    FROM fo, (VALUES (1), (2)) AS copies(copy) WHERE copy = 1 OR k BETWEEN 60 AND 64
"""
_BLOCKS["records"] = """
    SELECT coalesce(Trade_ID, '') AS trade_id, Counterparty AS counterparty, Asset_Class AS asset_class,
           CASE WHEN k BETWEEN 70 AND 74 THEN 0.0 ELSE coalesce(CAST(Quantity AS DOUBLE), 0.0) END AS quantity,
           CAST(CASE WHEN k BETWEEN 75 AND 79 THEN '1e15' WHEN k BETWEEN 80 AND 84 THEN 'NaN'
                WHEN k BETWEEN 85 AND 89 THEN 'Infinity' ELSE coalesce(CAST(Price AS VARCHAR), '0') END AS DOUBLE) AS price, Currency AS currency, CAST(Trade_Date AS VARCHAR) AS trade_date,
           CAST(Settlement_Date AS VARCHAR) AS settlement_date, 'DEFAULT_DESK' AS trader_id_or_book,
           'FRONT_OFFICE' AS source_system, coalesce(Trade_Status, 'NEW') AS status
    FROM defective
"""
_BLOCKS["details"] = f"SELECT {FEED}, {_money(_notional())} AS Trade_Notional FROM fo"


def _weighted(every_copy: bool) -> str:
    """Breaks next to the dimensions of their trade, once, or once per BO row of the trade."""
    dims = ", ".join(f"coalesce(f.{d}, o.{d}) AS {d}" for d in C.DIMENSIONS)
    back = "bo" if every_copy else "bo_first"
    return f"SELECT b.Trade_ID, b.Severity, {dims} FROM breaks AS b {_LOOKUP.format(back=back)}"


_BLOCKS["placed"] = _weighted(False)
_BLOCKS["placed_fanout"] = _weighted(True)


def _dimension(dimension: str, severities=(), source: str = "placed") -> str:
    columns = "".join(f", coalesce(b.{c}, 0) AS {c}" for c in severities)
    return f"""
    SELECT t.{dimension}, t.n AS Total_Trades, {_money('t.v')} AS Total_Notional,
           coalesce(b.n, 0) AS Total_Breaks{columns}, {_percent('coalesce(b.hit, 0)', 't.n')} AS Exception_Rate
    FROM (SELECT {dimension}, count(DISTINCT Trade_ID) AS n, sum({_notional()}) AS v FROM fo GROUP BY 1) AS t
    LEFT JOIN (
        SELECT {dimension}, count(*) AS n, count(DISTINCT Trade_ID) AS hit, {_SEVERITY_COUNTS}
        FROM {source} GROUP BY 1) AS b ON t.{dimension} = b.{dimension}
"""


_ALL_SEVERITIES = list(C.SEVERITY_COUNT_COLUMNS.values())
_BLOCKS["entities"] = " UNION ALL ".join(
    f"SELECT '{d}' AS Dimension, {d} AS Entity, * EXCLUDE ({d}) FROM ({_dimension(d, _ALL_SEVERITIES)}) AS x"
    for d in C.DIMENSIONS
)


def _distribution(column: str) -> str:
    share = _percent("count(*)", "(SELECT count(*) FROM breaks)")
    return f"SELECT {column}, count(*) AS Break_Count, {share} AS Percentage FROM breaks GROUP BY {column}"


_VALUE = f"coalesce({_notional('f.Quantity', 'f.Price')}, o.v)"
_BO_VALUE = f"(SELECT Feed_Month, Trade_ID, min({_notional()}) AS v FROM bo GROUP BY 1, 2)"
_BLOCKS["valued"] = (
    f"SELECT b.Trade_ID, b.Severity, {_VALUE} AS v FROM breaks AS b {_LOOKUP.format(back=_BO_VALUE)}"
)

_DEPENDS = {
    "fo": [],
    "bo": ["fo"],
    "found": ["fo", "bo"],
    "breaks": ["found"],
    "runs": ["breaks"],
    "corrected": ["fo"],
    "bo_first": ["bo"],
    "enriched": ["breaks", "bo_first"],
    "keyed": ["breaks"],
    "requests": ["keyed"],
    "actions": ["requests"],
    "state": ["actions"],
    "enriched_state": ["enriched", "state"],
    "defective": ["fo"],
    "records": ["defective"],
    "details": ["fo"],
    "placed": ["breaks", "bo_first"],
    "placed_fanout": ["breaks"],
    "entities": ["placed"],
    "valued": ["breaks"],
}


def _with(blocks: list[str], body: str) -> str:
    needed: set[str] = set()

    def need(name: str) -> None:
        for other in _DEPENDS[name]:
            need(other)
        needed.add(name)

    for name in blocks:
        need(name)
    ctes = ", ".join(f"{name} AS MATERIALIZED ({_BLOCKS[name]})" for name in _BLOCKS if name in needed)
    return f"WITH {ctes} {body}"


def _feed_after(columns: dict[str, str], where: str = "TRUE", source: str = "fo") -> str:
    """The FO feed with some columns replaced."""
    chosen = ", ".join(f"{columns[c]} AS {c}" if c in columns else c for c in C.FEED_COLUMNS)
    return _with(["fo"], f"SELECT {chosen} FROM {source} WHERE {where}")


_COPIES = "fo, (VALUES (1), (2)) AS copies(copy)"
_HISTORY = ", ".join(
    ["Run_ID", "Created_At", "Front_Count", "Back_Count", "Matched_Count", "Match_Percentage"]
)
_DATE_TEXT = """
    CASE k % 8 WHEN 0 THEN strftime(Trade_Date, '%Y/%m/%d')
         WHEN 1 THEN year(Trade_Date) || '-' || month(Trade_Date) || '-' || day(Trade_Date)
         WHEN 2 THEN year(Trade_Date) || '-13-01' WHEN 3 THEN year(Trade_Date) || '-02-30'
         WHEN 4 THEN substr(CAST(Trade_Date AS VARCHAR), 3, 8)
         WHEN 5 THEN CAST(Trade_Date AS VARCHAR) || ' 00:00' ELSE CAST(Trade_Date AS VARCHAR) END
"""
_AUDIT_COLUMNS = ["Break_ID", "Trade_ID", "Break_Type", "Expected_Value", "Actual_Value", "Severity"]
_SEARCHED = ["Trade_ID", "Trader", "Counterparty", "Symbol"]


def _contains(text: str) -> str:
    return "(" + " OR ".join(f"contains(lower(coalesce({c}, '')), '{text}')" for c in _SEARCHED) + ")"


def _rules() -> str:
    conditions = {
        "TRADE_ID_BLANK": "Trade_ID IS NULL OR trim(Trade_ID) = ''",
        "QUANTITY_NOT_POSITIVE": "Quantity <= 0",
        "PRICE_NOT_POSITIVE": "Price <= 0",
        "PRICE_OUT_OF_RANGE": "Price IS NOT NULL AND TRY_CAST(Price AS DECIMAL(20,8)) IS NULL",
        "CURRENCY_OUTSIDE_DOMAIN": f"Currency IS NULL OR Currency NOT IN ({_list(C.CURRENCIES)})",
        "STATUS_OUTSIDE_DOMAIN": f"Trade_Status IS NULL OR Trade_Status NOT IN ({_list(C.TRADE_STATUSES)})",
        "SETTLED_BEFORE_TRADED": "Settlement_Date < Trade_Date",
        **{
            f"{c}_MISSING".upper(): f"{c} IS NULL"
            for c in C.FEED_COLUMNS
            if c not in ("Trade_ID", "Currency", "Trade_Status")
        },
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS Rule, count(CASE WHEN {cond} THEN 1 END) AS Violations FROM defective"
        for name, cond in conditions.items()
    )


def _truth() -> str:
    def one(hit: str, kind: str, expected: str, actual: str, trade_id: str = "Trade_ID") -> str:
        return (
            f"SELECT {trade_id} AS Trade_ID, '{kind}' AS Break_Type, {expected} AS Expected_Value, "
            f"{actual} AS Actual_Value, '{C.SEVERITY_BY_BREAK[kind]}' AS Severity FROM fo WHERE {hit}"
        )

    text = "CAST({} AS VARCHAR)".format
    return " UNION ALL ".join(
        [
            one("k <= 17", C.MISSING, f"'{C.MISSING_EXPECTED}'", f"'{C.MISSING_ACTUAL}'"),
            one(
                "k BETWEEN 18 AND 29",
                C.UNEXPECTED,
                f"'{C.UNEXPECTED_EXPECTED}'",
                f"'{C.UNEXPECTED_ACTUAL}'",
                "'UNX_' || Trade_ID",
            ),
            one("k BETWEEN 85 AND 88", C.DUPLICATE, f"'{C.DUPLICATE_EXPECTED}'", f"'{C.DUPLICATE_ACTUAL} (2)'"),
            one("k BETWEEN 30 AND 45", C.PRICE, _price_text("Price"), _price_text(_scaled("1.08"))),
            one("k = 88", C.PRICE, _price_text("Price"), _price_text("(Price + CAST(1.0 AS DOUBLE))")),
            one("k BETWEEN 46 AND 55", C.QUANTITY, text("Quantity"), text("greatest(10, Quantity + 100)")),
            one(
                "k BETWEEN 56 AND 64 OR (k BETWEEN 30 AND 45 AND k2 < 5)", C.STATUS, "Trade_Status", _OTHER_STATUS
            ),
            one(
                "k BETWEEN 65 AND 71",
                C.TRADE_DATE,
                text("Trade_Date"),
                text("CAST(Trade_Date - INTERVAL 2 DAY AS DATE)"),
            ),
            one(
                "k BETWEEN 72 AND 76",
                C.SETTLEMENT_DATE,
                text("Settlement_Date"),
                text("CAST(Settlement_Date + INTERVAL 3 DAY AS DATE)"),
            ),
            one("k BETWEEN 77 AND 84", C.CURRENCY, "Currency", _OTHER_CURRENCY),
        ]
    )


def _measures() -> str:
    notional = f"(SELECT CAST(sum(round({_notional()}, 2)) AS DOUBLE) FROM fo)"
    singles = {
        "Total_Trades": "(SELECT CAST(sum(Front_Count) AS DOUBLE) FROM runs)",
        "Matched_Trades": "(SELECT CAST(sum(Matched_Count) AS DOUBLE) FROM runs)",
        "Total_Breaks": "(SELECT CAST(count(*) AS DOUBLE) FROM breaks)",
        "Affected_Trades": "(SELECT CAST(count(DISTINCT Trade_ID) AS DOUBLE) FROM breaks)",
        **{
            c: f"(SELECT CAST(count(*) AS DOUBLE) FROM breaks WHERE Severity = '{s}')"
            for s, c in C.SEVERITY_COUNT_COLUMNS.items()
        },
        "Total_Notional": notional,
    }
    rate = "CASE WHEN {0} > 0 THEN {1} / {0} * 100 ELSE 0.0 END".format
    singles["Match_Rate"] = rate(singles["Total_Trades"], singles["Matched_Trades"])
    singles["Exception_Rate"] = rate(singles["Total_Trades"], singles["Affected_Trades"])
    return " UNION ALL ".join(f"SELECT '{n}' AS Measure, {v} AS Value" for n, v in singles.items())


def _kpis(seconds: str = "0.0") -> str:
    rows = [
        ("Run ID", "Run_ID"),
        ("Execution Time", f"printf('%.4f seconds', CAST({seconds} AS DOUBLE))"),
        ("Generated On", "strftime(Created_At, '%Y-%m-%d %H:%M:%S')"),
        ("Front Office Trades", "CAST(Front_Count AS VARCHAR)"),
        ("Back Office Trades", "CAST(Back_Count AS VARCHAR)"),
        ("Matched Trades", "CAST(Matched_Count AS VARCHAR)"),
        ("Match Percentage", "printf('%.2f%%', Match_Percentage)"),
        ("Critical Issues", "CAST(Critical_Breaks AS VARCHAR)"),
        ("High Issues", "CAST(High_Breaks AS VARCHAR)"),
        ("Medium Issues", "CAST(Medium_Breaks AS VARCHAR)"),
        ("Low Issues", "CAST(Low_Breaks AS VARCHAR)"),
    ]
    latest = "(SELECT * FROM runs ORDER BY Created_At DESC, Run_ID DESC LIMIT 1) AS r"
    return " UNION ALL ".join(
        f"SELECT {i} AS Position, '{name}' AS Attribute, {value} AS Value FROM {latest}"
        for i, (name, value) in enumerate(rows, start=1)
    )


def _cards() -> str:
    cards = [
        ("Total FO Trades", "format('{:,}', Front_Count)"),
        ("Total BO Trades", "format('{:,}', Back_Count)"),
        ("Matched Trades", "format('{:,}', Matched_Count)"),
        ("Match Rate %", "printf('%.2f%%', Match_Percentage)"),
        ("Total Exceptions", f"format('{{:,}}', {_TOTAL})"),
        ("Critical Breaks", "format('{:,}', Critical_Breaks)"),
    ]
    latest = "(SELECT * FROM runs ORDER BY Created_At DESC, Run_ID DESC LIMIT 1) AS r"
    return " UNION ALL ".join(
        f"SELECT {i} AS Position, '{name}' AS Card, {value} AS Value FROM {latest}"
        for i, (name, value) in enumerate(cards, start=1)
    )


def _refusals() -> str:
    """Texts of refusals; counts come from the feeds."""
    front, back = "front_office_trades", "back_office_trades"
    lost = "string_agg(Rule || ' (' || Violations || ')', ', ' ORDER BY place)"
    rules = _rules().split(" UNION ALL ")
    numbered = " UNION ALL ".join(f"SELECT {i} AS place, * FROM ({rule}) AS r" for i, rule in enumerate(rules))
    repeated = f"'{front}: Trade_ID ''' || (SELECT min(Trade_ID) FROM fo) || ''' is not unique'"
    cases = {
        "rows against the rules": f"(SELECT '{front}: ' || {lost} FROM ({numbered}) AS v"
        " WHERE Violations > 0 AND Rule <> 'SETTLED_BEFORE_TRADED')",
        "column missing": f"'{front}: missing columns [''Desk'', ''Price'']'",
        "column missing in a file": "'file: missing columns [''Price'']'",
        "id repeated": repeated,
        "id repeated by appending": repeated,
        "feed without rows": f"'{back}: no rows'",
        "rows without a run": "'a feed has rows without a run'",
        "export without history": "'no reconciliation run on record'",
    }
    return " UNION ALL ".join(f"SELECT '{case}' AS Input, {text} AS Refusal" for case, text in cases.items())


def _sizes(name: str, count: str, cast: str = "count(*)") -> str:
    tables = {
        "front_office_trades": "fo",
        "back_office_trades": "bo",
        "reconciliation_breaks": "breaks",
        "reconciliation_summary": "runs",
        "break_resolutions_history": "actions",
    }
    return " UNION ALL ".join(f"SELECT '{t}' AS {name}, {cast} AS {count} FROM {cte}" for t, cte in tables.items())


def statements() -> dict[str, str]:
    """Query name -> SQL with the same columns and rows."""
    severity = _severity("Break_Type")
    single = {
        name: _with(
            ["bo"],
            f"SELECT Trade_ID, Break_Type, Expected_Value, Actual_Value, {severity} AS Severity FROM ({sql}) AS x",
        )
        for name, sql in {
            **_DETECTORS,
            "price_mismatches_narrow_tolerance": _mismatch(C.PRICE, "Price", "0.001"),
            "price_mismatches_wide_tolerance": _mismatch(C.PRICE, "Price", "0.50"),
            "price_mismatches_widest_tolerance": _mismatch(C.PRICE, "Price", "75.0"),
        }.items()
    }
    break_rows = "SELECT Run_ID, Trade_ID, Break_Type, Expected_Value, Actual_Value, Severity FROM breaks"
    stored = f"SELECT {_BREAK.replace('b.', '')} FROM breaks"
    pick = "CASE k % {n} {whens} END".format

    def picked(*values) -> str:
        whens = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
        return pick(n=len(values), whens=whens)

    def hit(low: int, high: int, value: str, column: str) -> dict[str, str]:
        return {column: f"CASE WHEN k BETWEEN {low} AND {high} THEN {value} ELSE {column} END"}

    json_fields = ", ".join(f"'{c}', {c}" for c in _AUDIT_COLUMNS)
    json_fields += ", 'Detected_At', strftime(Detected_At, '%Y-%m-%dT%H:%M:%S.%g'), 'Run_ID', Run_ID"
    found = {
        "front_office_feed": _with(["fo"], f"SELECT {FEED}, Feed_Month FROM fo"),
        "back_office_feed": _with(["bo"], f"SELECT {FEED}, Feed_Month FROM bo"),
        "scan_front_office": _with(["fo"], f"SELECT {FEED}, Feed_Month FROM fo"),
        "scan_back_office": _with(["bo"], f"SELECT {FEED}, Feed_Month FROM bo"),
        "csv_roundtrip_fo": _with(["fo"], f"SELECT {FEED} FROM fo"),
        "csv_roundtrip_bo": _with(["bo"], f"SELECT {FEED} FROM bo"),
        "append_feed": _with(["fo"], f"SELECT {FEED}, Feed_Month FROM fo"),
        "replaced_feed": _with(["fo"], f"SELECT {FEED}, Feed_Month FROM fo WHERE Feed_Month >= 199601"),
        "cleared_tables": _with(
            ["actions"],
            " UNION ALL ".join(
                f"SELECT '{t}' AS Table_Name, CAST(0 AS BIGINT) AS Row_Count"
                for t in ("front_office_trades", "back_office_trades", "reconciliation_breaks", "reconciliation_summary")
            )
            + " UNION ALL SELECT 'break_resolutions_history', count(*) FROM actions",
        ),
        "refused_inputs": _with(["defective"], _refusals()),
        "trade_lookup": _with(["fo"], f"SELECT {FEED} FROM fo WHERE Trade_ID = (SELECT min(Trade_ID) FROM fo) LIMIT 1"),
        "table_counts": _with(["runs", "actions"], _sizes("Table_Name", "Row_Count")),
        "control_status": _with(
            ["runs", "actions"],
            _sizes("Item", "Value", "CAST(count(*) AS VARCHAR)")
            + " UNION ALL SELECT i.Item, CASE i.Item WHEN 'latest_run' THEN Run_ID"
            " WHEN 'latest_match_percentage' THEN printf('%.2f', Match_Percentage)"
            " ELSE strftime(Created_At, '%Y-%m-%d') END AS Value"
            " FROM (SELECT * FROM runs ORDER BY Created_At DESC, Run_ID DESC LIMIT 1) AS r,"
            " (VALUES ('latest_run'), ('latest_match_percentage'), ('latest_created_at')) AS i(Item)",
        ),
        "distinct_runs": _with(["breaks"], "SELECT DISTINCT Run_ID FROM breaks"),
        "param_query": _with(
            ["breaks"],
            "SELECT Run_ID, Trade_ID, Break_Type FROM breaks WHERE Severity = 'HIGH' AND Run_ID >= 'REC_199601'",
        ),
        **single,
        "all_breaks": _with(["breaks"], break_rows),
        "all_breaks_one_by_one": _with(["breaks"], break_rows),
        "severity_map": _with(
            ["breaks"],
            f"SELECT DISTINCT Break_Type, {severity} AS Severity FROM ("
            "SELECT Break_Type FROM breaks UNION ALL SELECT 'Unlisted ' || Break_Type FROM breaks) AS x",
        ),
        "run_summary": _with(["breaks"], _summary("'REC_ALL'")),
        "backfill_runs": _with(["runs"], "SELECT * FROM runs"),
        "break_history": _with(["breaks"], stored),
        "rerun_history": _with(["runs"], "SELECT * FROM runs"),
        "backfill_changed": _with(
            ["runs", "corrected"], "SELECT * FROM runs UNION ALL BY NAME SELECT * FROM corrected"
        ),
        "reconciliation_runs": _with(
            ["runs"], f"SELECT {_HISTORY}, {_TOTAL} AS Total_Breaks, {', '.join(_ALL_SEVERITIES)} FROM runs"
        ),
        "latest_run": _with(["runs"], "SELECT * FROM runs ORDER BY Created_At DESC, Run_ID DESC LIMIT 1"),
        "match_rate_trend": _with(
            ["runs"],
            "SELECT Run_ID, CAST(Created_At AS DATE) AS Run_Date, Match_Percentage, CAST(95 AS DOUBLE) AS Target_Rate,"
            " Match_Percentage < 95 AS Below_Target FROM runs",
        ),
        "match_rate_change": _with(
            ["runs"],
            "SELECT Run_ID, Created_At, Match_Percentage, p AS Previous_Match_Percentage,"
            " round(Match_Percentage - p, 2) AS Match_Rate_Change"
            " FROM (SELECT *, lag(Match_Percentage) OVER (ORDER BY Created_At, Run_ID) AS p FROM runs) AS x",
        ),
        "volume_trend": _with(
            ["runs"],
            f"SELECT Run_ID, Created_At, Front_Count, Back_Count, Matched_Count, {_TOTAL} AS Total_Breaks FROM runs",
        ),
        "critical_trend": _with(
            ["breaks"],
            f"SELECT Run_ID, count(*) AS Total_Breaks, {_count_critical()} FROM breaks GROUP BY Run_ID",
        ),
        "run_status_bands": _with(
            ["runs"],
            "SELECT Run_ID, Match_Percentage, CASE WHEN Match_Percentage >= 90 THEN 'HEALTHY'"
            " WHEN Match_Percentage >= 80 THEN 'WARNING' ELSE 'CRITICAL' END AS Control_Status,"
            " CASE WHEN Match_Percentage >= 95 THEN 'OPTIMAL' WHEN Match_Percentage >= 90 THEN 'ACCEPTABLE'"
            " ELSE 'ATTENTION' END AS Dashboard_Status FROM runs",
        ),
        "executive_kpis": _with(["runs"], _kpis()),
        "executive_kpis_timed": _with(["runs"], _kpis("round(Front_Count / 1000, 4)")),
        "measures_timed": _with(
            ["runs", "breaks"],
            _measures() + " UNION ALL SELECT 'Average_Processing_Time', CAST(sum(CAST(round(Front_Count / 1000, 4)"
            " AS DECIMAL(18,4))) AS DOUBLE) / count(*) FROM runs",
        ),
        "execution_times": _with(["runs"], "SELECT Run_ID, true AS Is_Timed, true AS Is_Shown FROM runs"),
        "kpi_cards": _with(["runs"], _cards()),
        "measures": _with(["runs", "breaks"], _measures()),
        "breaks_enriched": _with(["enriched_state"], "SELECT * FROM enriched_state"),
        "breaks_enriched_fanout": _with(
            ["breaks"],
            f"SELECT {_BREAK}, {_FILLED}, count(*) AS Row_Copies FROM breaks AS b {_LOOKUP.format(back='bo')} GROUP BY ALL",
        ),
        "star_breaks": _with(
            ["runs", "breaks"],
            "SELECT b.Break_ID, b.Run_ID, b.Trade_ID, b.Break_Type, b.Severity, f.Desk, f.Portfolio, f.Counterparty,"
            f" f.Asset_Class, {_money(_notional('f.Quantity', 'f.Price'))} AS Trade_Notional, r.Created_At, r.Match_Percentage"
            " FROM breaks AS b JOIN fo AS f ON b.Feed_Month = f.Feed_Month AND b.Trade_ID = f.Trade_ID"
            " JOIN runs AS r ON r.Run_ID = b.Run_ID",
        ),
        "recent_breaks": _with(
            ["enriched_state"], "SELECT * FROM enriched_state ORDER BY Detected_At DESC, Break_ID DESC LIMIT 500"
        ),
        "top_critical": _with(
            ["enriched_state"],
            "SELECT Break_ID, Trade_ID, Desk, Counterparty, Break_Type, Severity, Resolution_Status FROM enriched_state"
            " WHERE Severity = 'CRITICAL' OR NOT EXISTS (SELECT 1 FROM breaks WHERE Severity = 'CRITICAL')"
            " ORDER BY Detected_At, Break_ID LIMIT 8",
        ),
        "search_breaks": _with(["enriched"], f"SELECT * FROM enriched WHERE {_contains('nation_7')}"),
        "filter_breaks": _with(
            ["enriched_state"],
            f"SELECT * FROM enriched_state WHERE {_contains('supplier')} AND Break_Type = '{C.PRICE}'"
            " AND Resolution_Status = 'RESOLVED'",
        ),
        "filter_breaks_dims": _with(
            ["enriched"],
            "SELECT * FROM enriched WHERE CAST(Detected_At AS DATE) BETWEEN DATE '1994-01-01' AND DATE '1996-12-31'"
            " AND Desk IN ('BUILDING', 'MACHINERY') AND Counterparty IN ('NATION_1', 'NATION_2', 'NATION_3')"
            " AND Severity IN ('CRITICAL', 'HIGH')",
        ),
        "break_table": _with(
            ["enriched_state"],
            "SELECT Break_ID, Run_ID, Trade_ID, Severity, Break_Type, coalesce(Expected_Value, '-') AS Expected_Value,"
            " coalesce(Actual_Value, '-') AS Actual_Value, Desk, Counterparty, Asset_Class,"
            " replace(Resolution_Status, '_', ' ') AS Resolution_Status,"
            " strftime(Detected_At, '%Y-%m-%d') AS Detected_On FROM enriched_state",
        ),
        "filtered_breaks_export": _with(
            ["enriched_state"],
            "SELECT Break_ID, Run_ID, Trade_ID, Break_Type, Severity, CAST(NULL AS VARCHAR) AS Field_Name,"
            " Expected_Value, Actual_Value, Trader, Desk, Portfolio, Counterparty, Asset_Class,"
            " Resolution_Status, Resolution_Reason FROM enriched_state"
            " WHERE Severity = 'HIGH' AND Resolution_Status = 'RESOLVED'",
        ),
        "desk_summary": _with(["placed"], _dimension("Desk", _ALL_SEVERITIES)),
        "desk_summary_fanout": _with(["placed_fanout"], _dimension("Desk", _ALL_SEVERITIES, "placed_fanout")),
        "portfolio_summary": _with(["placed"], _dimension("Portfolio")),
        "counterparty_summary": _with(["placed"], _dimension("Counterparty", ["Critical_Breaks"])),
        "asset_class_summary": _with(["placed"], _dimension("Asset_Class")),
        "entity_summary": _with(["entities"], "SELECT * FROM entities"),
        "desk_risk": _with(
            ["placed"],
            f"SELECT *, Exception_Rate > 5 AS Is_Elevated FROM ({_dimension('Desk', ['Critical_Breaks'])}) AS x",
        ),
        "top_entities": _with(
            ["entities"],
            "SELECT Dimension, Entity, Total_Trades, Total_Breaks, Critical_Breaks, Exception_Rate FROM entities"
            " ORDER BY Total_Breaks DESC, Dimension, Entity LIMIT 10",
        ),
        "top_counterparties": _with(
            ["enriched"],
            f"SELECT Counterparty, count(*) AS Total_Breaks, {_count_critical()} FROM enriched GROUP BY Counterparty"
            " ORDER BY Total_Breaks DESC, Counterparty LIMIT 10",
        ),
        "severity_summary": _with(
            ["breaks"], f"SELECT *, {_rank('Severity')} AS Severity_Rank FROM ({_distribution('Severity')}) AS x"
        ),
        "break_type_summary": _with(["breaks"], _distribution("Break_Type")),
        "severity_exposure": _with(
            ["valued"],
            f"SELECT Severity, {_rank('Severity')} AS Severity_Rank, count(*) AS Break_Count,"
            f" {_percent('count(*)', '(SELECT count(*) FROM breaks)')} AS Percentage,"
            f" {_money('sum(v)')} AS Notional_Exposure FROM valued GROUP BY Severity",
        ),
        "exposure_by_counterparty": _with(
            ["breaks"],
            "SELECT Counterparty, CAST(sum(n) AS BIGINT) AS Total_Breaks, count(*) AS Affected_Trades,"
            f" {_money('sum(v)')} AS Notional_Exposure FROM ("
            f" SELECT b.Feed_Month, b.Trade_ID, any_value(coalesce(f.Counterparty, o.c)) AS Counterparty, any_value({_VALUE}) AS v,"
            " count(*) AS n FROM breaks AS b"
            " LEFT JOIN fo AS f ON b.Feed_Month = f.Feed_Month AND b.Trade_ID = f.Trade_ID"
            f" LEFT JOIN (SELECT Feed_Month, Trade_ID, min(Counterparty) AS c, min({_notional()}) AS v FROM bo GROUP BY 1, 2) AS o"
            " ON b.Feed_Month = o.Feed_Month AND b.Trade_ID = o.Trade_ID"
            " GROUP BY 1, 2) AS x GROUP BY Counterparty",
        ),
        "breaks_by_desk": _with(
            ["enriched"], f"SELECT Desk, count(*) AS Total_Breaks, {_count_critical()} FROM enriched GROUP BY Desk"
        ),
        "breaks_by_asset_class": _with(
            ["enriched"],
            f"SELECT Asset_Class, count(*) AS Total_Breaks, {_count_critical()} FROM enriched GROUP BY Asset_Class",
        ),
        "trade_details": _with(["details"], "SELECT * FROM details"),
        "trade_population": _with(["details"], "SELECT * FROM details ORDER BY Trade_ID LIMIT 500"),
        "search_trades": _with(["details"], f"SELECT * FROM details WHERE {_contains('nation_1')}"),
        "trade_model": _with(
            ["records"],
            "SELECT *, "
            + _money("TRY_CAST(price AS DECIMAL(20,8)) * TRY_CAST(quantity AS DECIMAL(17,4))", 4)
            + " AS notional_amount FROM records",
        ),
        "trade_is_valid": _with(
            ["records"],
            "SELECT trade_id, quantity, price, trim(trade_id) <> '' AND quantity > 0 AND price > 0 AS is_valid FROM records",
        ),
        "dq_violations": _with(["defective"], _rules()),
        "dq_invalid_currency": _with(
            ["defective"],
            f"SELECT Currency, count(*) AS Row_Count FROM defective WHERE Currency NOT IN ({_list(C.CURRENCIES)}) GROUP BY Currency",
        ),
        "dq_invalid_status": _with(
            ["defective"],
            "SELECT Trade_Status, count(*) AS Row_Count FROM defective WHERE Trade_Status IS NULL"
            f" OR Trade_Status NOT IN ({_list(C.TRADE_STATUSES)}) GROUP BY Trade_Status",
        ),
        "dq_duplicate_fo_ids": _with(
            ["defective"],
            "SELECT Trade_ID, count(*) AS Row_Count FROM defective GROUP BY Trade_ID HAVING count(*) > 1",
        ),
        "dq_null_counts": _with(
            ["defective"],
            " UNION ALL ".join(
                f"SELECT '{c}' AS Column_Name, count(*) - count({c}) AS Null_Count FROM defective" for c in C.FEED_COLUMNS
            ),
        ),
        "dq_date_format": _with(
            ["fo"],
            "SELECT Trade_ID, t AS Date_Text, regexp_matches(t, '^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$')"
            f" AND try_strptime(t, '%Y-%m-%d') IS NOT NULL AS Is_Valid FROM (SELECT Trade_ID, {_DATE_TEXT} AS t FROM fo) AS x",
        ),
        "dq_orphan_breaks": _with(
            ["breaks"], "SELECT Run_ID, count(*) AS Row_Count FROM breaks WHERE Feed_Month >= 199601 GROUP BY Run_ID"
        ),
        "dq_orphan_actions": _with(
            ["requests"],
            "SELECT Break_ID, count(*) AS Row_Count FROM requests"
            " WHERE Break_ID IS NULL OR Break_ID NOT IN (SELECT Break_ID FROM breaks) GROUP BY Break_ID",
        ),
        "resolution_apply": _with(["state"], "SELECT * FROM state"),
        "resolution_history": _with(
            ["actions"],
            "SELECT Break_ID, Trade_ID, lag(New_Status, 1, 'UNRESOLVED')"
            " OVER (PARTITION BY Break_ID ORDER BY Created_At, Action_Seq) AS Previous_Status,"
            " New_Status, Reason, Action_By, Notes, Created_At, Action_Seq FROM actions",
        ),
        "resolution_rejects": _with(
            ["requests"],
            "SELECT Break_ID, New_Status, Reject_Reason, Created_At, Action_Seq FROM requests"
            " WHERE Reject_Reason IS NOT NULL",
        ),
        "report_input": _with(
            ["runs", "breaks"],
            f"SELECT {_BREAK}, r.Front_Count, r.Back_Count, r.Match_Percentage FROM breaks AS b"
            " JOIN (SELECT * FROM runs ORDER BY Created_At DESC, Run_ID DESC LIMIT 1) AS r ON r.Run_ID = b.Run_ID",
        ),
        "breaks_by_category_extract": _with(["breaks"], stored),
        "breaks_json": _with(
            ["breaks"], f"SELECT Break_ID, CAST(json_object({json_fields}) AS VARCHAR) AS Json FROM breaks"
        ),
        "run_audit_json": _with(["runs"], "SELECT * FROM runs"),
        "json_document": _with(["runs"], "SELECT * FROM runs"),
        "summary_extract": _with(["runs"], "SELECT * FROM runs"),
        "analytics_export": _with(
            ["runs", "breaks"],
            "SELECT 'reconciliation_runs' AS Dataset, count(*) AS Row_Count FROM runs"
            " UNION ALL SELECT 'reconciliation_breaks', count(*) FROM breaks"
            " UNION ALL SELECT 'trade_details', count(*) FROM fo"
            " UNION ALL SELECT 'desk_summary', count(DISTINCT Desk) FROM fo"
            " UNION ALL SELECT 'portfolio_summary', count(DISTINCT Portfolio) FROM fo"
            " UNION ALL SELECT 'counterparty_summary', count(DISTINCT Counterparty) FROM fo"
            " UNION ALL SELECT 'asset_class_summary', count(DISTINCT Asset_Class) FROM fo"
            " UNION ALL SELECT 'severity_summary', count(DISTINCT Severity) FROM breaks"
            " UNION ALL SELECT 'break_type_summary', count(DISTINCT Break_Type) FROM breaks",
        ),
        "inject_missing": _feed_after({}, "k > 17"),
        "inject_unexpected": _feed_after(
            {
                "Trade_ID": "CASE WHEN copy = 2 THEN 'UNX_' || Trade_ID ELSE Trade_ID END",
                "Trade_Status": "CASE WHEN copy = 2 THEN 'BOOKED' ELSE Trade_Status END",
            },
            "copy = 1 OR k BETWEEN 18 AND 29",
            _COPIES,
        ),
        "inject_price": _feed_after(hit(30, 45, _scaled(f"({picked('1.08', '0.92', '1.15')})"), "Price")),
        "inject_quantity": _feed_after(
            hit(46, 55, f"greatest(10, Quantity + ({picked('100', '-50', '500')}))", "Quantity")
        ),
        "inject_status": _feed_after(hit(56, 64, _OTHER_STATUS, "Trade_Status")),
        "inject_trade_date": _feed_after(
            hit(65, 71, f"CAST(Trade_Date - to_days({picked('1', '2', '3')}) AS DATE)", "Trade_Date")
        ),
        "inject_settlement_date": _feed_after(
            hit(72, 76, f"CAST(Settlement_Date + to_days({picked('2', '3', '4', '5')}) AS DATE)", "Settlement_Date")
        ),
        "inject_currency": _feed_after(hit(77, 84, _OTHER_CURRENCY, "Currency")),
        "inject_duplicates": _feed_after({}, "copy = 1 OR k BETWEEN 85 AND 88", _COPIES),
        "injected_truth": _with(["fo"], _truth()),
        "injected_counts": _with(
            ["fo"], f"SELECT Break_Type, count(*) AS Injected FROM ({_truth()}) AS t GROUP BY Break_Type"
        ),
    }
    same = [name for name in C.DATASETS if name != "reconciliation_breaks"]
    exported = {name: found[name] for name in same}
    exported["reconciliation_breaks"] = _with(["enriched"], "SELECT * EXCLUDE (Break_ID) FROM enriched")
    exported["reconciliation_breaks_in_order"] = _with(
        ["enriched"],
        "SELECT * EXCLUDE (Break_ID), row_number() OVER (ORDER BY Detected_At, Break_ID) AS Position FROM enriched",
    )
    exported["trade_details_in_order"] = _with(
        ["details"], "SELECT *, row_number() OVER (ORDER BY Trade_ID) AS Position FROM details"
    )
    return found | {f"analytics_export_{name}": sql for name, sql in exported.items()}
