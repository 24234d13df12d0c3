"""Common table expressions of the checking SQL, in order of dependency."""

from __future__ import annotations

import re

LOAD_1 = "2024-01-01 00:00:00"
LOAD_2 = "2024-02-01 00:00:00"
LOAD_2_END = "2024-01-31 23:59:59"
OPEN_END = "2099-12-31 00:00:00"
BATCH_1 = "batch-1"
BATCH_2 = "batch-2"


def sha(*columns: str, prefix: str = "") -> str:
    parts = ", ".join(f"coalesce(CAST({prefix}{name} AS VARCHAR), '~null~')" for name in columns)
    return f"sha256(concat_ws('|', {parts}))" if columns else "sha256('')"


SILVER_TRACKED = ("Close", "Currency", "Date", "ExchangeName", "ExchangeTimeZone", "High", "Low",
                  "Open", "Symbol", "Type", "Volume")
SILVER_KEY = ("Symbol", "ExchangeName", "Currency", "Date")
DIM_KEY = ("Symbol", "ExchangeName", "Currency")
DIM_TRACKED = ("Currency", "ExchangeName", "ExchangeTimeZone", "Industry", "Logo", "Sort", "Symbol", "Type")
FACT_KEY = ("SymbolSID", "DateID")
FACT_TRACKED = ("Close", "High", "Low", "Open", "Volume")


#: Every column of the three versioned tables, in the order of their declarations.
VERSION = "__CurrentFlag, __DeletedFlag, __EffectiveStartDateTime, __EffectiveEndDateTime"
BATCH = "__CreatedBatchLogId, __UpdatedBatchLogId, __CreateDateTime, __UpdateDateTime"


def _growths(name: str, source: str, by: str) -> dict[str, str]:
    """daily / anchor / bounds / growth chain for one grouping."""
    def on(left: str, right: str) -> str:
        return " AND ".join(f"{left}.{c.strip()} IS NOT DISTINCT FROM {right}.{c.strip()}" for c in by.split(",")) if by else "true"
    lead = f"{by}, " if by else ""
    blead = "".join(f"b.{c.strip()}, " for c in by.split(",")) if by else ""
    return {
        f"days{name}": f"""
            SELECT {lead}Date, sum(Open) AS so, sum(Close) AS sc, min(Low) AS lo, max(High) AS hi,
                   sum(Volume) AS sv, count(Volume) AS cv
            FROM {source} GROUP BY {lead}Date""",
        f"anchor{name}": f"""
            SELECT {lead}max(CASE WHEN sc > 0 THEN Date END) AS t1 FROM days{name} {'GROUP BY ' + by if by else ''}""",
        f"bounds{name}": f"""
            SELECT {lead}RangeName, SortOrder, t1, CASE RangeName
                WHEN '30 Days' THEN t1 - 30 WHEN '90 Days' THEN t1 - 90
                WHEN 'YTD' THEN make_date(year(t1), 1, 1)
                WHEN '1Y' THEN make_date(year(t1) - 1, month(t1), 1) + CAST(day(t1) - 1 AS INTEGER)
                WHEN '5Y' THEN make_date(year(t1) - 5, month(t1), 1) + CAST(day(t1) - 1 AS INTEGER)
                END AS t0
            FROM anchor{name}, ranges""",
        f"inrange{name}": f"""
            SELECT b.RangeName, b.SortOrder, b.t0, b.t1, d.*
            FROM bounds{name} b JOIN days{name} d
              ON {on('b', 'd')} AND (b.RangeName = 'MAX' OR d.Date BETWEEN b.t0 AND b.t1)""",
        f"growth{name}": f"""
            SELECT *, (CAST(lc AS DOUBLE) - CAST(fc AS DOUBLE)) / nullif(CAST(fc AS DOUBLE), 0) AS g FROM (
              SELECT {blead}b.RangeName, b.SortOrder, b.t0, b.t1,
                     (SELECT min(i.Date) FROM inrange{name} i
                      WHERE i.so > 0 AND i.RangeName = b.RangeName AND {on('i', 'b')}) AS fd,
                     (SELECT arg_min(i.sc, i.Date) FROM inrange{name} i
                      WHERE i.so > 0 AND i.RangeName = b.RangeName AND {on('i', 'b')}) AS fc,
                     (SELECT arg_max(d.sc, d.Date) FROM days{name} d
                      WHERE d.sc > 0 AND {on('d', 'b')}) AS lc
              FROM bounds{name} b)""",
    }


def silver(source: str, load: str, batch: str) -> str:
    return f"""
        SELECT *, true AS __CurrentFlag, false AS __DeletedFlag,
               TIMESTAMP '{load}' AS __EffectiveStartDateTime, TIMESTAMP '{OPEN_END}' AS __EffectiveEndDateTime,
               TIMESTAMP '{load}' AS __lastmodified,
               {sha(*SILVER_KEY)} AS __HashKey, {sha(*SILVER_TRACKED)} AS __HashValue,
               '{batch}' AS __CreatedBatchLogId, CAST(NULL AS VARCHAR) AS __UpdatedBatchLogId,
               TIMESTAMP '{load}' AS __CreateDateTime, CAST(NULL AS TIMESTAMP) AS __UpdateDateTime
        FROM {source}"""


def customer_dim(source: str, load: str, batch: str) -> str:
    return f"""
        SELECT *, true AS __CurrentFlag, false AS __DeletedFlag,
               TIMESTAMP '{load}' AS __EffectiveStartDateTime, TIMESTAMP '{OPEN_END}' AS __EffectiveEndDateTime,
               {sha('c_custkey')} AS __BusinessKeyHash, {sha('c_acctbal')} AS __Hash1Type,
               {sha('c_custkey', 'c_mktsegment')} AS __Hash2Type,
               '{batch}' AS __CreatedBatchLogId, CAST(NULL AS VARCHAR) AS __UpdatedBatchLogId,
               TIMESTAMP '{load}' AS __CreateDateTime, CAST(NULL AS TIMESTAMP) AS __UpdateDateTime
        FROM {source}"""


CTES: dict[str, str] = {
    "trades": """
        SELECT n_name AS Symbol, r_name AS ExchangeName, CAST(l_shipdate AS DATE) AS Date,
               CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) / 10, 3) AS DECIMAL(18,3)) AS px,
               CAST(l_quantity AS BIGINT) AS qty, row(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS ord
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
             JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "bars": """
        SELECT Symbol, ExchangeName, 'USD' AS Currency, 'Common Stock' AS Type,
               'America/New_York' AS ExchangeTimeZone, CAST(sum(qty) AS BIGINT) AS Volume,
               max(px) AS High, min(px) AS Low, arg_max(px, ord) AS Close, arg_min(px, ord) AS Open, Date
        FROM trades GROUP BY Symbol, ExchangeName, Date""",
    "lookup": """
        SELECT CAST(n_nationkey AS INTEGER) AS Sort, r_name AS Industry, n_name AS Symbol,
               'https://example.org/' || n_name || '.svg' AS Logo
        FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'MIDDLE EAST'""",
    "istar": "SELECT b.*, Sort, Industry, Logo FROM bars b LEFT JOIN lookup USING (Symbol)",
    "ranges": """
        SELECT * FROM (VALUES ('30 Days', 1), ('90 Days', 2), ('YTD', 3), ('1Y', 4), ('5Y', 5), ('MAX', 6))
          AS v(RangeName, SortOrder)""",
    # responses: one per symbol and month
    "months": """
        SELECT Symbol, ExchangeName, Currency, Type, ExchangeTimeZone,
               CAST(date_trunc('month', Date) AS DATE) AS Month, count(*) AS n_days
        FROM bars GROUP BY ALL""",
    "docs": """
        SELECT *, NOT (ExchangeName = 'EUROPE' AND month(Month) = 3) AS has_meta,
               CASE WHEN ExchangeName = 'ASIA' AND month(Month) = 12 THEN 'error' ELSE 'ok' END AS status,
               CASE WHEN ExchangeName = 'AFRICA' AND month(Month) = 6 THEN 0 ELSE n_days END AS n_values,
               CASE WHEN ExchangeName = 'AMERICA' AND month(Month) = 1 THEN 2 ELSE 1 END AS copies
        FROM months""",
    "landed": "SELECT docs.* EXCLUDE (copies) FROM docs, generate_series(1, 2) AS c(k) WHERE k <= copies",
    "accepted": "SELECT * FROM landed WHERE has_meta AND status = 'ok'",
    "flat": """
        SELECT b.Symbol, b.ExchangeName, b.Currency, b.Type, b.ExchangeTimeZone,
               CAST(Volume AS VARCHAR) AS Volume, CAST(High AS VARCHAR) AS High, CAST(Low AS VARCHAR) AS Low,
               CAST(Close AS VARCHAR) AS Close, CAST(Open AS VARCHAR) AS Open, CAST(Date AS VARCHAR) AS Date
        FROM bars b JOIN accepted a
          ON a.Symbol = b.Symbol AND a.Month = CAST(date_trunc('month', b.Date) AS DATE) AND a.n_values > 0""",
    "flatset": "SELECT DISTINCT * FROM flat",
    "typed": """
        SELECT Symbol, ExchangeName, Currency, Type, ExchangeTimeZone, CAST(Volume AS BIGINT) AS Volume,
               CAST(High AS DECIMAL(18,3)) AS High, CAST(Low AS DECIMAL(18,3)) AS Low,
               CAST(Close AS DECIMAL(18,3)) AS Close, CAST(Open AS DECIMAL(18,3)) AS Open,
               CAST(Date AS DATE) AS Date FROM flatset""",
    "corrected": """
        SELECT * REPLACE (CAST(CASE WHEN Close > Open THEN Close + 1 ELSE Close END AS DECIMAL(18,3)) AS Close)
        FROM bars WHERE ExchangeName <> 'EUROPE'""",
    "silver1": silver("bars", LOAD_1, BATCH_1),
    "silver2": silver("corrected", LOAD_2, BATCH_2),
    # silver after the second load, statement by statement
    "silver_expired": f"""
        SELECT t.* REPLACE (
            coalesce(s.__HashValue = t.__HashValue, true) AS __CurrentFlag,
            CASE WHEN s.__HashValue <> t.__HashValue THEN TIMESTAMP '{LOAD_2_END}'
                 ELSE t.__EffectiveEndDateTime END AS __EffectiveEndDateTime,
            CASE WHEN s.__HashValue <> t.__HashValue THEN TIMESTAMP '{LOAD_2}'
                 ELSE t.__lastmodified END AS __lastmodified,
            CASE WHEN s.__HashValue <> t.__HashValue THEN '{BATCH_2}' END AS __UpdatedBatchLogId,
            CASE WHEN s.__HashValue <> t.__HashValue THEN TIMESTAMP '{LOAD_2}' END AS __UpdateDateTime)
        FROM silver1 t LEFT JOIN silver2 s ON s.__HashKey = t.__HashKey""",
    "silver_merged": """
        SELECT * FROM silver_expired
        UNION ALL
        SELECT * FROM silver2 s WHERE NOT EXISTS (
            SELECT 1 FROM silver_expired t WHERE t.__HashKey = s.__HashKey AND t.__CurrentFlag)""",
    # customers: two loads
    "customers": """
        SELECT c_custkey, c_mktsegment, CAST(c_acctbal AS DECIMAL(18,3)) AS c_acctbal FROM customer""",
    "cust1": "SELECT * FROM customers WHERE NOT (c_mktsegment = 'MACHINERY' AND c_acctbal < 0)",
    "cust2": """
        SELECT c_custkey, CASE WHEN c_acctbal BETWEEN 1000 AND 2000 THEN 'X' ELSE c_mktsegment END AS c_mktsegment,
               CAST(CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 1 ELSE c_acctbal END AS DECIMAL(18,3)) AS c_acctbal
        FROM customers WHERE NOT (c_mktsegment = 'HOUSEHOLD' AND c_acctbal > 9000)""",
    "dim1": customer_dim("cust1", LOAD_1, BATCH_1),
    "dim2": customer_dim("cust2", LOAD_2, BATCH_2),
    "dim_overwritten": f"""
        SELECT t.* REPLACE (
            CASE WHEN s.__Hash1Type <> t.__Hash1Type THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
            CASE WHEN s.__Hash1Type <> t.__Hash1Type THEN s.__Hash1Type ELSE t.__Hash1Type END AS __Hash1Type,
            CASE WHEN s.__Hash1Type <> t.__Hash1Type THEN '{BATCH_2}' END AS __UpdatedBatchLogId,
            CASE WHEN s.__Hash1Type <> t.__Hash1Type THEN TIMESTAMP '{LOAD_2}' END AS __UpdateDateTime)
        FROM dim1 t LEFT JOIN dim2 s ON s.__BusinessKeyHash = t.__BusinessKeyHash""",
    "dim_expired": f"""
        SELECT t.* REPLACE (
            coalesce(s.__Hash2Type = t.__Hash2Type, true) AS __CurrentFlag,
            CASE WHEN s.__Hash2Type <> t.__Hash2Type THEN TIMESTAMP '{LOAD_2_END}'
                 ELSE t.__EffectiveEndDateTime END AS __EffectiveEndDateTime,
            CASE WHEN s.__Hash2Type <> t.__Hash2Type THEN '{BATCH_2}' ELSE t.__UpdatedBatchLogId END AS __UpdatedBatchLogId,
            CASE WHEN s.__Hash2Type <> t.__Hash2Type THEN TIMESTAMP '{LOAD_2}' ELSE t.__UpdateDateTime END AS __UpdateDateTime)
        FROM dim_overwritten t LEFT JOIN dim2 s ON s.__BusinessKeyHash = t.__BusinessKeyHash""",
    "dim_merged": """
        SELECT * FROM dim_expired
        UNION ALL
        SELECT * FROM dim2 s WHERE NOT EXISTS (
            SELECT 1 FROM dim_expired t WHERE t.__BusinessKeyHash = s.__BusinessKeyHash AND t.__CurrentFlag)""",
    # symbol dimension and daily fact
    "symkeys": f"""
        SELECT DISTINCT Symbol, ExchangeName, Currency, Type, ExchangeTimeZone, Sort, Industry, Logo,
               {sha(*DIM_KEY)} AS __BusinessKeyHash
        FROM bars JOIN lookup USING (Symbol)""",
    "dimsym": f"""
        SELECT row_number() OVER (ORDER BY __BusinessKeyHash) AS SymbolSID, *,
               sha256('') AS __Hash1Type, {sha(*DIM_TRACKED)} AS __Hash2Type,
               true AS __CurrentFlag, false AS __DeletedFlag,
               TIMESTAMP '{LOAD_1}' AS __EffectiveStartDateTime, TIMESTAMP '{OPEN_END}' AS __EffectiveEndDateTime,
               '{BATCH_1}' AS __CreatedBatchLogId, CAST(NULL AS VARCHAR) AS __UpdatedBatchLogId,
               TIMESTAMP '{LOAD_1}' AS __CreateDateTime, CAST(NULL AS TIMESTAMP) AS __UpdateDateTime
        FROM symkeys""",
    "factsrc": f"""
        SELECT d.SymbolSID, b.Volume, b.High, b.Low, b.Open, b.Close,
               CAST(strftime(b.Date, '%Y%m%d') AS INTEGER) AS DateID,
               {sha(*DIM_KEY, prefix='b.')} AS member
        FROM bars b LEFT JOIN dimsym d USING (Symbol)""",
    "fact1": f"""
        SELECT * EXCLUDE (member), false AS __DeletedFlag,
               sha256(concat_ws('|', coalesce(CAST(SymbolSID AS VARCHAR), member), DateID)) AS __FactKeyHash, {sha(*FACT_TRACKED)} AS __FactSCD1Hash,
               '{BATCH_1}' AS __CreatedBatchLogId, TIMESTAMP '{LOAD_1}' AS __CreateDateTime
        FROM factsrc""",
    "dates": """
        SELECT CAST(d AS DATE) AS Date FROM generate_series(
            (SELECT min(l_shipdate) FROM lineitem), (SELECT max(l_shipdate) FROM lineitem), INTERVAL 1 DAY) AS g(d)""",
    "cal": """
        SELECT CAST(strftime(Date, '%Y%m%d') AS INTEGER) AS DateID, Date, CAST(day(Date) AS INTEGER) AS Day,
               dayname(Date) AS DayOfWeek, CAST(dayofweek(Date) + 1 AS INTEGER) AS DayOfWeekNumber,
               strftime(Date, '%b') AS MonthName, CAST(month(Date) AS INTEGER) AS MonthNumber,
               CAST(year(Date) AS INTEGER) AS Year, CAST(year(Date) * 100 + month(Date) AS INTEGER) AS YearMonth
        FROM dates""",
    **_growths("_sym", "bars", "Symbol"),
    **_growths("_ind", "istar", "Industry"),
    **_growths("_all", "bars", ""),
    **_growths("_isym", "istar", "Industry, Symbol"),
}


def with_ctes(body: str, **own: str) -> str:
    """``body`` under the expressions it mentions, directly or through others."""
    known = {**CTES, **own}
    needed: dict[str, str] = {}

    def collect(text: str) -> None:
        for name, part in known.items():
            if name not in needed and part is not text and re.search(rf"\b{name}\b", text):
                collect(part)
                needed[name] = part

    collect(body)
    parts = [f"{name} AS ({part.strip()})" for name, part in needed.items()]
    return f"WITH {', '.join(parts)}\n{body.strip()}" if parts else body.strip()
