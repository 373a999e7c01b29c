"""Independent DuckDB SQL for every registered query.

Each statement maps the TPC-H-like tables onto the star schema with plain SQL (same
rules as ``clientele/sources/testdata.py``) and then computes the query the way a SQL
analyst would: single-partition window functions, self-joins and subset enumeration
are fine here because the oracle only runs on the small test scales.

DuckDB details that matter: decimal literals are DECIMAL (so weights are cast to
DOUBLE), ``count`` is BIGINT, ``year``/``month`` are BIGINT (cast to INTEGER to match
Spark), and ``round_even(x * 100, 0) / 100`` equals NumPy's ``round(x, 2)``.
"""

from __future__ import annotations

AS_OF = "DATE '2001-08-02'"

STAR = {
    "dim_customer": """
        SELECT c.c_custkey AS CustomerKey, c.c_name AS CustomerID, c.c_name AS CustomerName,
               lower(c.c_name) || '@example.com' AS Email, CAST(NULL AS VARCHAR) AS Phone,
               COALESCE(CAST(fo.first_order AS DATE), DATE '1995-01-01') AS RegistrationDate,
               TRUE AS IsCurrentRecord
        FROM customer c
        LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY o_custkey) fo
               ON c.c_custkey = fo.o_custkey""",
    "dim_product": """
        SELECT p_partkey AS ProductKey, p_name AS ProductName, p_type AS Category,
               p_brand AS SubCategory
        FROM part""",
    "dim_region": """
        SELECT n.n_nationkey AS RegionKey, r.r_name AS RegionName, n.n_name AS Country,
               'STATE_' || CAST(n.n_nationkey AS VARCHAR) AS State
        FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "fact_sales": """
        SELECT o.o_custkey AS CustomerKey, l.l_partkey AS ProductKey, s.s_nationkey AS RegionKey,
               CAST(l.l_orderkey AS VARCHAR) AS OrderNumber, o.o_orderdate AS TransactionDate,
               round(CAST(l.l_extendedprice AS DECIMAL(15,2))
                     * (1 - CAST(l.l_discount AS DECIMAL(4,2))), 2) AS NetSalesAmount,
               CASE WHEN l.l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS ReturnFlag
        FROM lineitem l
        JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN supplier s ON l.l_suppkey = s.s_suppkey""",
}

VIEW = {
    "cv_lines": """
        SELECT f.CustomerKey, f.TransactionDate, f.NetSalesAmount, f.ReturnFlag,
               r.RegionName, r.Country, r.State, p.Category
        FROM fact_sales f
        LEFT JOIN dim_region r ON f.RegionKey = r.RegionKey
        LEFT JOIN dim_product p ON f.ProductKey = p.ProductKey
        WHERE f.ReturnFlag = 'N'""",
    "cv_metrics": """
        SELECT CustomerKey, max(TransactionDate) AS LastPurchaseDate,
               count(*) AS TransactionCount, sum(NetSalesAmount) AS TotalSpend,
               count(*) FILTER (WHERE ReturnFlag = 'N') AS PurchaseCount,
               count(*) FILTER (WHERE ReturnFlag = 'Y') AS ReturnCount,
               CAST(count(DISTINCT month(TransactionDate)) AS INTEGER) AS MonthsActive,
               max(RegionName) AS PrimaryRegion, max(Country) AS Country, max(State) AS State,
               count(DISTINCT Category) AS CategoriesPurchased
        FROM cv_lines GROUP BY CustomerKey""",
    "customer_view": f"""
        SELECT c.CustomerKey, c.CustomerID, c.CustomerName, c.Email, c.Phone, c.RegistrationDate,
               CAST(date_diff('day', CAST(m.LastPurchaseDate AS DATE), {AS_OF}) AS INTEGER) AS RecencyDays,
               m.TransactionCount, m.TotalSpend, m.PurchaseCount, m.ReturnCount,
               CAST(m.TotalSpend AS DOUBLE) / CAST(NULLIF(m.PurchaseCount, 0) AS DOUBLE) AS AvgOrderValue,
               CAST(date_diff('day', c.RegistrationDate, {AS_OF}) AS INTEGER) AS CustomerTenureDays,
               CAST(year(c.RegistrationDate) AS INTEGER) AS CohortYear,
               CAST(quarter(c.RegistrationDate) AS INTEGER) AS CohortQuarter,
               CAST(month(c.RegistrationDate) AS INTEGER) AS CohortMonth,
               m.MonthsActive, m.PrimaryRegion, m.Country, m.State, m.LastPurchaseDate,
               m.CategoriesPurchased
        FROM dim_customer c JOIN cv_metrics m ON c.CustomerKey = m.CustomerKey
        WHERE c.IsCurrentRecord""",
    "customer_view_banded": """
        SELECT *, CASE WHEN RecencyDays IS NULL THEN 'Never Purchased'
                       WHEN RecencyDays <= 30 THEN 'Very Recent'
                       WHEN RecencyDays <= 90 THEN 'Recent'
                       WHEN RecencyDays <= 180 THEN 'Moderate'
                       ELSE 'Distant' END AS RecencyCategory
        FROM customer_view""",
    "extract": "SELECT * FROM customer_view_banded WHERE TotalSpend > 0",
}


def _status(n: str) -> str:
    return f"CASE WHEN {n} < 5 THEN 'New' WHEN {n} < 10 THEN 'Active' ELSE 'Loyal' END"


# Two loads of the customer dimension, and the view over lines keyed by version.
VERSIONS = {
    "order_counts": """
        SELECT o_custkey, count(*) FILTER (WHERE o_orderdate < TIMESTAMP '1998-01-01') AS early,
               count(*) AS total FROM orders GROUP BY o_custkey""",
    "known": f"""
        SELECT c.* EXCLUDE (CustomerKey, IsCurrentRecord), c.CustomerKey AS SourceKey,
               COALESCE(n.early, 0) AS early, {_status('COALESCE(n.early, 0)')} AS early_status,
               {_status('COALESCE(n.total, 0)')} AS end_status
        FROM dim_customer c LEFT JOIN order_counts n ON c.CustomerKey = n.o_custkey""",
    "load1": """
        SELECT row_number() OVER (ORDER BY CustomerID) AS CustomerKey, * FROM known WHERE early > 0""",
    "load2": """
        SELECT (SELECT COALESCE(max(CustomerKey), 0) FROM load1)
                 + row_number() OVER (ORDER BY CustomerID) AS CustomerKey, *
        FROM known WHERE early = 0 OR early_status <> end_status""",
    "customer_versions": """
        SELECT * EXCLUDE (early_status, end_status, early), early_status AS LifecycleStatus,
               DATE '1900-01-01' AS ValidFrom,
               CASE WHEN early_status <> end_status THEN DATE '1998-01-01' END AS ValidTo,
               early_status = end_status AS IsCurrentRecord
        FROM load1
        UNION ALL BY NAME
        SELECT * EXCLUDE (early_status, end_status, early), end_status AS LifecycleStatus,
               DATE '1998-01-01' AS ValidFrom, CAST(NULL AS DATE) AS ValidTo, TRUE AS IsCurrentRecord
        FROM load2""",
    "fact_versions": """
        SELECT f.* EXCLUDE (CustomerKey), v.CustomerKey
        FROM fact_sales f LEFT JOIN customer_versions v
             ON f.CustomerKey = v.SourceKey AND v.ValidFrom <= f.TransactionDate
                AND f.TransactionDate < COALESCE(v.ValidTo, DATE '9999-01-01')""",
}
VERSIONED_VIEW = {name: body.replace("fact_sales f", "fact_versions f")
                  .replace("dim_customer c", "customer_versions c") for name, body in VIEW.items()}


def _tile(rank: str, tiles: int = 5) -> str:
    return (f"CASE WHEN n > 1 THEN greatest(1, ({tiles} * ({rank} - 1) + n - 2) // (n - 1)) "
            f"ELSE 1 END")


SCORED = {
    "ranked": """
        SELECT *,
               row_number() OVER (ORDER BY RecencyDays, TotalSpend DESC, CustomerKey) AS r_rank,
               row_number() OVER (ORDER BY TransactionCount, TotalSpend DESC, CustomerKey) AS f_rank,
               row_number() OVER (ORDER BY TotalSpend, CustomerKey) AS m_rank,
               count(*) OVER () AS n
        FROM extract""",
    "scores": f"""
        SELECT *, CAST(6 - {_tile('r_rank')} AS INTEGER) AS R_Score,
               CAST({_tile('f_rank')} AS INTEGER) AS F_Score,
               CAST({_tile('m_rank')} AS INTEGER) AS M_Score
        FROM ranked""",
    "indexed": """
        SELECT *, round_even(((R_Score * CAST(1.0 AS DOUBLE) + F_Score * CAST(1.2 AS DOUBLE))
                              + M_Score * CAST(1.5 AS DOUBLE)) / CAST(3.7 AS DOUBLE) * 100, 0) / 100
                  AS RFM_Score
        FROM scores""",
    "segmented": """
        SELECT *, CASE WHEN RFM_Score >= 4.5 THEN 'Champions'
                       WHEN F_Score >= 4 AND M_Score >= 4 THEN 'Loyal Customers'
                       WHEN R_Score >= 4 AND F_Score >= 3 THEN 'Potential Loyalists'
                       WHEN R_Score >= 3 AND RFM_Score >= 3 THEN 'Customers Needing Attention'
                       WHEN R_Score <= 2 AND F_Score >= 3 AND M_Score >= 3 THEN 'At Risk'
                       WHEN R_Score <= 2 AND F_Score <= 2 THEN 'Hibernating'
                       ELSE 'New/Low Value' END AS Segment
        FROM indexed""",
    "valued": """
        SELECT *, round_even(COALESCE(AvgOrderValue, 0.0)
                             * (CAST(COALESCE(PurchaseCount, 1) AS DOUBLE)
                                / (CAST(COALESCE(CustomerTenureDays, 365) AS DOUBLE) / 365.0 + 1.0))
                             * 100, 0) / 100 AS AnnualRevenue
        FROM segmented""",
    "results": """
        SELECT *, round_even(AnnualRevenue * CAST(5 AS DOUBLE) * 100, 0) / 100 AS CLV_Predicted
        FROM valued""",
}


def day(col: str) -> str:
    """DATE as ISO text (see report_types in queries.py)."""
    return f"strftime({col}, '%Y-%m-%d') AS {col}"


def instant(col: str) -> str:
    """TIMESTAMP as ISO text."""
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S') AS {col}"


def with_ctes(*groups: dict[str, str], final: str) -> str:
    parts = []
    for g in groups:
        parts.extend(f"{name} AS ({body.strip()})" for name, body in g.items())
    return "WITH " + ",\n".join(parts) + "\n" + final.strip()


def base(final: str, *extra: dict[str, str]) -> str:
    """Star mapping + customer view + scoring, then ``final``."""
    return with_ctes(STAR, VIEW, SCORED, *extra, final=final)


def round2(expr: str) -> str:
    return f"round_even(({expr}) * 100, 0) / 100"


def ratio(num: str, den: str) -> str:
    return f"CAST({num} AS DOUBLE) / CAST(NULLIF({den}, 0) AS DOUBLE)"


def exact_mean(col: str) -> str:
    return ratio(f"sum(CAST({col} AS DECIMAL(18,2)))", f"count({col})")


COHORT = {
    "cohort_facts": """
        SELECT CustomerKey, max(TransactionDate) AS LastPurchaseDate, count(*) AS lines,
               sum(CASE WHEN ReturnFlag = 'N' THEN NetSalesAmount ELSE 0 END) AS spend
        FROM fact_sales GROUP BY CustomerKey""",
    "cohort_base": """
        SELECT c.CustomerKey, c.CustomerID, c.RegistrationDate,
               CAST(year(c.RegistrationDate) AS INTEGER) AS CohortYear,
               CAST(quarter(c.RegistrationDate) AS INTEGER) AS CohortQuarter,
               strftime(c.RegistrationDate, '%Y-%m') AS CohortMonth,
               f.LastPurchaseDate, COALESCE(f.lines, 0) AS TransactionCount,
               CASE WHEN f.lines IS NULL THEN 0 ELSE f.spend END AS TotalSpend,
               CAST((year(f.LastPurchaseDate) - year(c.RegistrationDate)) * 12
                    + month(f.LastPurchaseDate) - month(c.RegistrationDate) AS INTEGER) AS MonthsSinceCohort
        FROM dim_customer c LEFT JOIN cohort_facts f ON c.CustomerKey = f.CustomerKey
        WHERE c.IsCurrentRecord""",
    "cohort_cells": """
        SELECT CohortMonth AS Cohort, MonthsSinceCohort, count(*) AS Customers
        FROM cohort_base WHERE MonthsSinceCohort IS NOT NULL GROUP BY CohortMonth, MonthsSinceCohort""",
}


def cohort(final: str, *extra: dict[str, str]) -> str:
    return with_ctes(STAR, COHORT, *extra, final=final)


BASKET = {
    "bitems": """
        SELECT f.OrderNumber, p.ProductName, p.Category
        FROM fact_sales f JOIN dim_product p ON f.ProductKey = p.ProductKey
        WHERE f.ReturnFlag = 'N'""",
    "bsk": """
        SELECT OrderNumber, list_sort(list(DISTINCT ProductName)) AS items
        FROM bitems GROUP BY OrderNumber""",
    "nb": "SELECT count(*) AS n FROM bsk",
    "subsets": """
        SELECT list_filter(items, lambda x, i: ((m >> (i - 1)) & 1) = 1) AS itemset
        FROM (SELECT items, unnest(range(1, (1 << len(items)))) AS m FROM bsk)""",
    "itemset_counts": "SELECT itemset, count(*) AS cnt FROM subsets GROUP BY itemset",
    "itemsets": """
        SELECT itemset, CAST(len(itemset) AS INTEGER) AS Length, cnt AS Count,
               CAST(cnt AS DOUBLE) / CAST(n AS DOUBLE) AS support
        FROM itemset_counts, nb
        WHERE CAST(cnt AS DOUBLE) / CAST(n AS DOUBLE) >= CAST(0.001 AS DOUBLE)""",
    "splits": """
        SELECT list_filter(itemset, lambda x, i: ((m >> (i - 1)) & 1) = 1) AS a,
               list_filter(itemset, lambda x, i: ((m >> (i - 1)) & 1) = 0) AS c, s
        FROM (SELECT itemset, support AS s, unnest(range(1, (1 << len(itemset)) - 1)) AS m
              FROM itemsets WHERE len(itemset) >= 2)""",
    "rule_supports": """
        SELECT sp.a, sp.c, ia.support AS sA, ic.support AS sC, sp.s
        FROM splits sp JOIN itemsets ia ON ia.itemset = sp.a JOIN itemsets ic ON ic.itemset = sp.c""",
    "rules": """
        SELECT array_to_string(a, ', ') AS antecedents, array_to_string(c, ', ') AS consequents,
               sA AS antecedent_support, sC AS consequent_support, s AS support,
               s / sA AS confidence, (s / sA) / sC AS lift, s - sA * sC AS leverage,
               CASE WHEN s / sA < 1 THEN (1 - sC) / (1 - s / sA) ELSE CAST('inf' AS DOUBLE) END AS conviction,
               CASE WHEN greatest(s * (1 - sA), sA * (sC - s)) = 0 THEN CAST(0 AS DOUBLE)
                    ELSE (s - sA * sC) / greatest(s * (1 - sA), sA * (sC - s)) END AS zhangs_metric
        FROM rule_supports WHERE s / sA >= CAST(0.01 AS DOUBLE)""",
}


def basket(final: str) -> str:
    return with_ctes(STAR, BASKET, final=final)


INGEST = {
    "sound": """
        SELECT CAST(l.l_orderkey AS VARCHAR) AS tid, strftime(o.o_orderdate, '%Y-%m-%d') AS dt,
               CAST(o.o_custkey AS VARCHAR) AS cid, p.p_type AS cat, l.l_orderkey % 40 AS kind,
               CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR) AS qty,
               l.l_extendedprice / l.l_quantity AS price,
               CAST(round(CAST(l.l_extendedprice AS DECIMAL(15,2))
                          * (1 - CAST(l.l_discount AS DECIMAL(4,2))), 2) AS DOUBLE) AS total
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN part p ON l.l_partkey = p.p_partkey""",
    "raw": """
        SELECT tid, dt, cid, cat, qty, price, total FROM sound
        UNION ALL
        SELECT 'D' || tid, CASE kind WHEN 0 THEN 'not a date' WHEN 6 THEN '1901-01-01' ELSE dt END,
               CASE WHEN kind <> 4 THEN cid END, CASE WHEN kind <> 5 THEN cat END,
               CASE kind WHEN 1 THEN 'many' WHEN 7 THEN '-1' WHEN 8 THEN qty || '.0' ELSE qty END,
               CASE WHEN kind <> 2 THEN price END, CASE WHEN kind <> 3 THEN total END
        FROM sound WHERE kind <= 8""",
    "tx": """
        SELECT 'ORD_' || tid AS OrderID, try_strptime(dt, '%Y-%m-%d') AS OrderDate,
               'CUST_' || cid AS CustomerID, cat AS Category,
               TRY_CAST(TRY_CAST(qty AS DOUBLE) AS INTEGER) AS Quantity, price AS UnitPrice, total AS NetSalesAmount,
               'PROD_' || replace(upper(cat), ' ', '_') AS ProductID, cat || ' Item' AS ProductName,
               'CUST_' || cid AS CustomerName, lower('CUST_' || cid) || '@example.com' AS Email,
               'Unknown' AS Region, TRY_CAST(TRY_CAST(qty AS DOUBLE) AS INTEGER) * price AS SalesAmount
        FROM raw""",
    "tx1": "SELECT * FROM tx WHERE OrderDate < TIMESTAMP '1998-01-01'",
    "tx2": "SELECT * FROM tx WHERE NOT (OrderDate < TIMESTAMP '1998-01-01') OR OrderDate IS NULL",
    "p1": """
        SELECT row_number() OVER (ORDER BY ProductID) AS ProductKey, ProductID, ProductName, Category
        FROM (SELECT ProductID, ProductName, Category,
                     row_number() OVER (PARTITION BY ProductID ORDER BY ProductName, Category) AS rn
              FROM tx1 WHERE ProductID IS NOT NULL) WHERE rn = 1""",
    "p2": """
        SELECT (SELECT COALESCE(max(ProductKey), 0) FROM p1)
                 + row_number() OVER (ORDER BY ProductID) AS ProductKey, ProductID, ProductName, Category
        FROM (SELECT ProductID, ProductName, Category,
                     row_number() OVER (PARTITION BY ProductID ORDER BY ProductName, Category) AS rn
              FROM tx2 WHERE ProductID NOT IN (SELECT ProductID FROM p1)) WHERE rn = 1""",
    "products": "SELECT * FROM p1 UNION ALL SELECT * FROM p2",
    "c1": """
        SELECT row_number() OVER (ORDER BY CustomerID) AS CustomerKey, CustomerID, CustomerName, Email
        FROM (SELECT DISTINCT CustomerID, CustomerName, Email FROM tx1 WHERE CustomerID IS NOT NULL)""",
    "c2": """
        SELECT (SELECT COALESCE(max(CustomerKey), 0) FROM c1)
                 + row_number() OVER (ORDER BY CustomerID) AS CustomerKey, CustomerID, CustomerName, Email
        FROM (SELECT DISTINCT CustomerID, CustomerName, Email FROM tx2
              WHERE CustomerID NOT IN (SELECT CustomerID FROM c1))""",
    "customers": "SELECT * FROM c1 UNION ALL SELECT * FROM c2",
    "cal": """
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS DateKey
        FROM (SELECT unnest(generate_series(CAST(date_trunc('year', min(o_orderdate)) AS DATE),
                                            make_date(year(max(o_orderdate)), 12, 31),
                                            INTERVAL 1 DAY)) AS d FROM orders)""",
}


def _classified(batch: str, customers: str, products: str) -> str:
    return f"""
        SELECT t.*, c.CustomerKey, p.ProductKey, 1 AS RegionKey,
               CAST(strftime(t.OrderDate, '%Y%m%d') AS INTEGER) AS DateKey,
               CASE WHEN t.OrderDate IS NULL THEN 'bad_date'
                    WHEN t.Quantity IS NULL THEN 'bad_quantity'
                    WHEN t.UnitPrice IS NULL THEN 'bad_price'
                    WHEN t.NetSalesAmount IS NULL THEN 'bad_amount'
                    WHEN c.CustomerKey IS NULL THEN 'unknown_customer'
                    WHEN p.ProductKey IS NULL THEN 'unknown_product'
                    WHEN CAST(strftime(t.OrderDate, '%Y%m%d') AS INTEGER) NOT IN (SELECT DateKey FROM cal)
                         THEN 'date_not_in_calendar'
                    WHEN t.Quantity <= 0 THEN 'quantity_not_positive' END AS RejectReason
        FROM {batch} t LEFT JOIN {customers} c ON t.CustomerID = c.CustomerID
        LEFT JOIN {products} p ON t.ProductID = p.ProductID"""


_FACT_COLS = ("CustomerKey, ProductKey, DateKey, RegionKey, OrderID AS OrderNumber, "
              "OrderDate AS TransactionDate, Quantity, "
              "CAST(CAST(CAST(UnitPrice AS VARCHAR) AS DECIMAL(10,2)) AS DOUBLE) AS UnitPrice, "
              "CAST(CAST(CAST(SalesAmount AS VARCHAR) AS DECIMAL(15,2)) AS DOUBLE) AS SalesAmount, "
              "CAST(CAST(CAST(NetSalesAmount AS VARCHAR) AS DECIMAL(15,2)) AS DOUBLE) AS NetSalesAmount")
# DuckDB's DOUBLE -> DECIMAL cast scales in floating point; rounding the shortest decimal
# text (what the source writes into its INSERT statement) needs the VARCHAR step.
_FACT_ORDER = ("CustomerKey NULLS FIRST, ProductKey NULLS FIRST, DateKey NULLS FIRST, RegionKey NULLS FIRST, "
               "OrderNumber NULLS FIRST, TransactionDate NULLS FIRST, Quantity NULLS FIRST, "
               "UnitPrice NULLS FIRST, SalesAmount NULLS FIRST, NetSalesAmount NULLS FIRST")

INGEST_FACTS = {
    "k1": _classified("tx1", "c1", "p1"),
    "k2": _classified("tx2", "customers", "products"),
    "f1": f"""
        SELECT 1000000 + row_number() OVER (ORDER BY {_FACT_ORDER}) AS SalesID, *
        FROM (SELECT {_FACT_COLS} FROM k1 WHERE RejectReason IS NULL)""",
    "f2": f"""
        SELECT (SELECT greatest(COALESCE(max(SalesID), 0), 1000000) FROM f1)
                 + row_number() OVER (ORDER BY {_FACT_ORDER}) AS SalesID, *
        FROM (SELECT {_FACT_COLS} FROM k2 WHERE RejectReason IS NULL)""",
}


def ingest(final: str, *extra: dict[str, str], facts: bool = False) -> str:
    return with_ctes(INGEST, *([INGEST_FACTS] if facts else []), *extra, final=final)


# The feed as one load from CSV, with lines of another number of fields.
BAD = """
    SELECT 'L' || tid || ',' || dt || ',' || cid || ',' || cat
               || CASE kind WHEN 10 THEN ',1,2,3,4' ELSE '' END AS line
    FROM sound WHERE kind IN (9, 10)"""


def classified_by_key(batch: str) -> str:
    """Reject reasons of one load: every key that is not null is known after it."""
    return f"""
        SELECT OrderID, CustomerID, ProductID,
               CASE WHEN OrderDate IS NULL THEN 'bad_date'
                    WHEN Quantity IS NULL THEN 'bad_quantity'
                    WHEN UnitPrice IS NULL THEN 'bad_price'
                    WHEN NetSalesAmount IS NULL THEN 'bad_amount'
                    WHEN CustomerID IS NULL THEN 'unknown_customer'
                    WHEN ProductID IS NULL THEN 'unknown_product'
                    WHEN CAST(strftime(OrderDate, '%Y%m%d') AS INTEGER) NOT IN (SELECT DateKey FROM cal)
                         THEN 'date_not_in_calendar'
                    WHEN Quantity <= 0 THEN 'quantity_not_positive' END AS RejectReason
        FROM {batch}"""


BAD_LINES = """
    SELECT OrderID, CustomerID, ProductID, RejectReason, CAST(NULL AS VARCHAR) AS BadLine
    FROM kb WHERE RejectReason IS NOT NULL
    UNION ALL
    SELECT NULL, NULL, NULL, 'bad_line', line FROM bad"""


CALENDAR = """
    SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS DateKey, d AS CalendarDate,
           CAST(year(d) AS INTEGER) AS Year, CAST(quarter(d) AS INTEGER) AS Quarter,
           CAST(month(d) AS INTEGER) AS Month, CAST(day(d) AS INTEGER) AS Day,
           CAST(floor((dayofyear(d) + dayofweek(date_trunc('year', d)) + 1 - 2) / 7) + 1 AS INTEGER) AS WeekOfYear,
           CAST(dayofweek(d) + 1 AS INTEGER) AS DayOfWeek, strftime(d, '%A') AS DayName,
           strftime(d, '%B') AS MonthName, dayofweek(d) IN (0, 6) AS IsWeekend, FALSE AS IsHoliday
    FROM (SELECT CAST(unnest(generate_series(CAST(date_trunc('year', min(o_orderdate)) AS DATE),
                                              make_date(year(max(o_orderdate)), 12, 31),
                                              INTERVAL 1 DAY)) AS DATE) AS d FROM orders)"""


# Complete cohort x offset grid for the wide (pivoted) matrices; missing cells are 0.
COHORT_GRID = {
    "offs": "SELECT DISTINCT MonthsSinceCohort AS o FROM cohort_cells",
    "cohs": "SELECT DISTINCT Cohort FROM cohort_cells",
    "grid": """
        SELECT c.Cohort, o.o, COALESCE(x.Customers, 0) AS cnt
        FROM cohs c CROSS JOIN offs o
        LEFT JOIN cohort_cells x ON x.Cohort = c.Cohort AND x.MonthsSinceCohort = o.o""",
    "firsts": "SELECT Cohort, cnt AS f FROM grid WHERE o = (SELECT min(o) FROM offs)",
    "retention_vals": """
        SELECT g.Cohort, g.o,
               CAST(g.cnt AS DOUBLE) / CAST(NULLIF(f.f, 0) AS DOUBLE) * CAST(100 AS DOUBLE) AS v
        FROM grid g JOIN firsts f ON g.Cohort = f.Cohort""",
    "spend_cells": """
        SELECT CohortMonth AS Cohort, MonthsSinceCohort,
               CAST(sum(TotalSpend) AS DOUBLE) / CAST(NULLIF(count(TotalSpend), 0) AS DOUBLE) AS AvgSpend
        FROM cohort_base WHERE MonthsSinceCohort IS NOT NULL GROUP BY CohortMonth, MonthsSinceCohort""",
    "spending_vals": """
        SELECT g.Cohort, g.o, COALESCE(s.AvgSpend, CAST(0 AS DOUBLE)) AS v
        FROM grid g LEFT JOIN spend_cells s ON s.Cohort = g.Cohort AND s.MonthsSinceCohort = g.o""",
}


def cohort_matrix(values: str, name: str) -> str:
    """A wide matrix over its full grid, one row per cell."""
    return cohort(f"SELECT Cohort, o AS MonthsSinceCohort, v AS {name} FROM {values}", COHORT_GRID)
