"""Explicit schemas: no inference pass over the files, stable types across runs."""

from __future__ import annotations

from pyspark.sql.types import (BooleanType, DateType, DecimalType, DoubleType, IntegerType,
                               LongType, StringType, StructField, StructType, TimestampNTZType,
                               TimestampType)


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


# Source tables of the test data (TPC-H-like).
TESTDATA = {
    "region": _s(("r_regionkey", IntegerType()), ("r_name", StringType())),
    "nation": _s(("n_nationkey", IntegerType()), ("n_name", StringType()),
                 ("n_regionkey", IntegerType())),
    "customer": _s(("c_custkey", LongType()), ("c_name", StringType()),
                   ("c_nationkey", IntegerType()), ("c_acctbal", DoubleType()),
                   ("c_mktsegment", StringType())),
    "supplier": _s(("s_suppkey", LongType()), ("s_name", StringType()),
                   ("s_nationkey", IntegerType()), ("s_acctbal", DoubleType())),
    "part": _s(("p_partkey", LongType()), ("p_name", StringType()), ("p_brand", StringType()),
               ("p_type", StringType()), ("p_size", IntegerType()), ("p_retailprice", DoubleType())),
    "orders": _s(("o_orderkey", LongType()), ("o_custkey", LongType()),
                 ("o_orderstatus", StringType()), ("o_totalprice", DoubleType()),
                 ("o_orderdate", TimestampNTZType()), ("o_orderpriority", StringType())),
    "lineitem": _s(("l_orderkey", LongType()), ("l_partkey", LongType()), ("l_suppkey", LongType()),
                   ("l_linenumber", IntegerType()), ("l_quantity", DoubleType()),
                   ("l_extendedprice", DoubleType()), ("l_discount", DoubleType()),
                   ("l_tax", DoubleType()), ("l_returnflag", StringType()),
                   ("l_linestatus", StringType()), ("l_shipdate", TimestampNTZType())),
}

# Star schema of the source database (column names as the reports use them).
DIM_DATE = _s(("DateKey", IntegerType()), ("CalendarDate", DateType()), ("Year", IntegerType()),
              ("Quarter", IntegerType()), ("Month", IntegerType()), ("Day", IntegerType()),
              ("WeekOfYear", IntegerType()), ("DayOfWeek", IntegerType()),
              ("DayName", StringType()), ("MonthName", StringType()),
              ("IsWeekend", BooleanType()), ("IsHoliday", BooleanType()))
DIM_REGION = _s(("RegionKey", IntegerType()), ("RegionID", StringType()), ("RegionName", StringType()),
                ("Country", StringType()), ("State", StringType()), ("City", StringType()),
                ("IsActive", BooleanType()))
DIM_PRODUCT = _s(("ProductKey", LongType()), ("ProductID", StringType()), ("ProductName", StringType()),
                 ("Category", StringType()), ("SubCategory", StringType()),
                 ("UnitPrice", DecimalType(10, 2)), ("IsActive", BooleanType()))
DIM_CUSTOMER = _s(("CustomerKey", LongType()), ("CustomerID", StringType()),
                  ("CustomerName", StringType()), ("Email", StringType()), ("Phone", StringType()),
                  ("RegistrationDate", DateType()), ("LifecycleStatus", StringType()),
                  ("IsCurrentRecord", BooleanType()))
FACT_SALES = _s(("CustomerKey", LongType()), ("ProductKey", LongType()), ("DateKey", IntegerType()),
                ("RegionKey", IntegerType()), ("OrderNumber", StringType()),
                ("OrderLineNumber", IntegerType()), ("TransactionDate", TimestampType()),
                ("Quantity", IntegerType()), ("UnitPrice", DecimalType(10, 2)),
                ("SalesAmount", DecimalType(15, 2)), ("DiscountAmount", DecimalType(10, 2)),
                ("TaxAmount", DecimalType(10, 2)), ("NetSalesAmount", DecimalType(15, 2)),
                ("ReturnFlag", StringType()))

# Raw transaction CSV: read every column as text, cast with try_* so bad values become
# rejected rows instead of failed jobs. Extra columns in a file are ignored.
RAW_TRANSACTIONS = _s(("Transaction ID", StringType()), ("Date", StringType()),
                      ("Customer ID", StringType()), ("Product Category", StringType()),
                      ("Quantity", StringType()), ("Price per Unit", StringType()),
                      ("Total Amount", StringType()))
