"""Load raw transactions into the star schema, set-based.

The source loads row by row (about four round trips per fact row) and silently skips
any row that fails; here the whole feed is one job:

1. ``ingest_transform``: rename, derive ids, cast with ``try_*`` (bad text -> NULL).
2. ``upsert_dim``: distinct business keys of the feed that the dimension does not have
   yet (left anti join), numbered after the dimension's largest key in business-key
   order with an exact distributed row number.
3. ``load_facts``: surrogate-key lookups as joins, the region key is the smallest
   region key, and every row either becomes a fact or a reject with its reason.

Lines with too few or too many fields, or with text behind a closing quote, cannot be read by
name: a missing field shifts all after it. ``read_feed`` keeps such a line whole, beside the
file it stands in, and reads none of its fields; it becomes a reject (``bad_line``), and no
dimension takes a key from it. A blank line is no line.

Dimensions are idempotent (re-running a feed adds nothing); facts are not (the source
has no duplicate guard, and neither does this).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StringType, StructField, StructType

from clientele.functions.dates import date_key
from clientele.operators.ranking import global_row_number
from clientele.session import cut_lineage
from clientele.sources.schemas import RAW_TRANSACTIONS

# Fixed values of the source load.
CUSTOMER_PREFIX = "CUST_"
ORDER_PREFIX = "ORD_"
PRODUCT_PREFIX = "PROD_"
PRODUCT_NAME_SUFFIX = " Item"
EMAIL_DOMAIN = "@example.com"
UNKNOWN_REGION = ("R_UNK", "Unknown", "Unknown")
FIRST_SALES_ID = 1000001
# tried in this order; the most common first, since each failed attempt is costly
DATE_FORMATS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd", "MM/dd/yyyy", "dd-MM-yyyy")

RAW_COLUMNS = [f.name for f in RAW_TRANSACTIONS.fields]
BAD_LINE, SOURCE_FILE = "BadLine", "SourceFile"
_CORRUPT = "_corrupt_line"


def _header(spark: SparkSession, path: str) -> list[str]:
    names = spark.read.option("header", True).csv(path).columns
    missing = [c for c in RAW_COLUMNS if c not in names]
    if names and missing:
        raise ValueError(f"transaction file lacks columns {missing}")
    return names


def _text_schema(names: Sequence[str]) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header row; every column as text, extra columns ignored, the required
    ones selected by name.

    The names come from one header; the schema made of them is explicit and every file's
    own header is held against it (``enforceSchema`` off), so a file with another column
    order fails instead of being read by position. Lines of another length are padded or cut;
    ``read_feed`` keeps them apart.
    """
    names = _header(spark, path)
    if not names:
        return spark.createDataFrame([], RAW_TRANSACTIONS)
    raw = (spark.read.schema(_text_schema(names)).option("header", True)
           .option("enforceSchema", False).option("mode", "PERMISSIVE").csv(path))
    return raw.select(*[F.col(f"`{c}`") for c in RAW_COLUMNS])


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """As ``read_transactions``, with two columns more: ``BadLine``, the whole text of a line
    that does not have the header's fields (its other columns are null; null for a sound
    line), and ``SourceFile``, the file that a row stands in. One scan, no shuffle."""
    names = _header(spark, path)
    if not names:
        return spark.createDataFrame([], _text_schema([*RAW_COLUMNS, BAD_LINE, SOURCE_FILE]))
    raw = (spark.read.schema(_text_schema([*names, _CORRUPT])).option("header", True)
           .option("enforceSchema", False).option("mode", "PERMISSIVE")
           # fields are counted against the whole header, also where not all of them are read
           .option("columnPruning", False)
           .option("columnNameOfCorruptRecord", _CORRUPT).csv(path))
    sound = F.col(_CORRUPT).isNull()
    return raw.select(*[F.when(sound, F.col(f"`{c}`")).alias(c) for c in RAW_COLUMNS],
                      F.col(_CORRUPT).alias(BAD_LINE),
                      F.col("_metadata.file_path").alias(SOURCE_FILE))


def with_origin(tx: DataFrame) -> DataFrame:
    """``BadLine`` and ``SourceFile`` on every feed, null where it was not read as lines, so
    that rejects of all loads have the same columns."""
    return tx.withColumns({c: F.lit(None).cast("string") for c in (BAD_LINE, SOURCE_FILE)
                           if c not in tx.columns})


def parse_timestamp(text) -> F.Column:
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(fmt)) for fmt in DATE_FORMATS])


def parse_feed(raw: DataFrame) -> DataFrame:
    """The columns of ``ingest_transform`` that the others follow from."""
    # whole numbers also come as "2.0": read as a number, then cut to an integer
    quantity = F.col("`Quantity`").try_cast("double").try_cast("int")
    return raw.select(
        F.concat(F.lit(ORDER_PREFIX), F.col("`Transaction ID`")).alias("OrderID"),
        parse_timestamp(F.col("`Date`")).alias("OrderDate"),
        F.concat(F.lit(CUSTOMER_PREFIX), F.col("`Customer ID`")).alias("CustomerID"),
        F.col("`Product Category`").alias("Category"),
        quantity.alias("Quantity"),
        F.col("`Price per Unit`").try_cast("double").alias("UnitPrice"),
        F.col("`Total Amount`").try_cast("double").alias("NetSalesAmount"),
        *[c for c in (BAD_LINE, SOURCE_FILE) if c in raw.columns],
    )


def product_id() -> F.Column:
    return F.concat(F.lit(PRODUCT_PREFIX), F.replace(F.upper("Category"), F.lit(" "), F.lit("_")))


def with_derived(parsed: DataFrame) -> DataFrame:
    """``ingest_transform``'s columns from those of ``parse_feed``, with any others behind."""
    base = ["OrderID", "OrderDate", "CustomerID", "Category", "Quantity", "UnitPrice", "NetSalesAmount"]
    return parsed.select(
        *base,
        product_id().alias("ProductID"),
        F.concat("Category", F.lit(PRODUCT_NAME_SUFFIX)).alias("ProductName"),
        F.col("CustomerID").alias("CustomerName"),
        F.concat(F.lower("CustomerID"), F.lit(EMAIL_DOMAIN)).alias("Email"),
        F.lit(UNKNOWN_REGION[1]).alias("Region"),
        (F.col("Quantity") * F.col("UnitPrice")).alias("SalesAmount"),
        *[c for c in parsed.columns if c not in base and c != "ProductID"],
    )


def ingest_transform(raw: DataFrame) -> DataFrame:
    return with_derived(parse_feed(raw))


def upsert_dim(existing: DataFrame, feed: DataFrame, business_key: str, surrogate_key: str,
               attributes: Sequence[str]) -> DataFrame:
    """Rows to append to a dimension: one per new business key, numbered after the
    dimension's largest surrogate key. When the feed spells one key several ways, the
    smallest attribute tuple wins (the feed has no meaningful row order). Spellings are
    made distinct first, by a hash aggregate, so only they are compared, not feed rows; only
    the keys that are new are written and sorted."""
    spellings = feed.where(F.col(business_key).isNotNull()).select(business_key, *attributes).distinct()
    firsts = (spellings.groupBy(business_key)
              .agg(F.min(F.struct(*attributes)).alias("_first"))
              .select(business_key, *[F.col(f"_first.{a}").alias(a) for a in attributes]))
    new = cut_lineage(firsts.join(existing.select(business_key), business_key, "left_anti"))
    if new.isEmpty():
        return new.select(F.lit(0).cast("long").alias(surrogate_key), business_key, *attributes)
    start = existing.select(F.coalesce(F.max(surrogate_key), F.lit(0)).cast("long")).scalar()
    numbered = global_row_number(new, [F.col(business_key).asc()], rank_col="_n")
    return numbered.select((start + F.col("_n")).alias(surrogate_key), business_key, *attributes)


def region_rows(existing_regions: DataFrame) -> DataFrame:
    spark = existing_regions.sparkSession
    default = spark.range(1).select(F.lit(UNKNOWN_REGION[0]).alias("RegionID"),
                                    F.lit(UNKNOWN_REGION[1]).alias("RegionName"),
                                    F.lit(UNKNOWN_REGION[2]).alias("Country"),
                                    F.lit(True).alias("IsActive"))
    return upsert_dim(existing_regions, default, "RegionID", "RegionKey",
                      ["RegionName", "Country", "IsActive"])


def product_rows(existing_products: DataFrame, tx: DataFrame) -> DataFrame:
    feed = tx.select("ProductID", "ProductName", "Category",
                     F.lit(0).cast(DecimalType(10, 2)).alias("UnitPrice"), F.lit(True).alias("IsActive"))
    return upsert_dim(existing_products, feed, "ProductID", "ProductKey",
                      ["ProductName", "Category", "UnitPrice", "IsActive"])


def customer_rows(existing_customers: DataFrame, tx: DataFrame, as_of: _dt.date) -> DataFrame:
    feed = tx.select("CustomerID", "CustomerName", "Email",
                     F.lit(as_of).alias("RegistrationDate"), F.lit(True).alias("IsCurrentRecord"))
    return upsert_dim(existing_customers, feed, "CustomerID", "CustomerKey",
                      ["CustomerName", "Email", "RegistrationDate", "IsCurrentRecord"])


def _reject_reason() -> F.Column:
    return (F.when(F.col(BAD_LINE).isNotNull(), F.lit("bad_line"))
             .when(F.col("OrderDate").isNull(), F.lit("bad_date"))
             .when(F.col("Quantity").isNull(), F.lit("bad_quantity"))
             .when(F.col("UnitPrice").isNull(), F.lit("bad_price"))
             .when(F.col("NetSalesAmount").isNull(), F.lit("bad_amount"))
             .when(F.col("CustomerKey").isNull(), F.lit("unknown_customer"))
             .when(F.col("ProductKey").isNull(), F.lit("unknown_product"))
             .when(F.col("RegionKey").isNull(), F.lit("no_region"))
             .when(F.col("_in_calendar").isNull(), F.lit("date_not_in_calendar"))
             .when(F.col("Quantity") <= 0, F.lit("quantity_not_positive")))


def classify_facts(tx: DataFrame, customers: DataFrame, products: DataFrame, regions: DataFrame,
                   calendar: DataFrame) -> DataFrame:
    """Every feed row with its keys and ``RejectReason`` (NULL for a loadable row)."""
    region_key = regions.select(F.min("RegionKey")).scalar()
    x = (with_origin(tx).join(customers.select("CustomerID", "CustomerKey"), "CustomerID", "left")
           .join(products.select("ProductID", "ProductKey"), "ProductID", "left")
           .withColumn("RegionKey", region_key)
           .withColumn("DateKey", date_key("OrderDate")))
    x = x.join(calendar.select("DateKey", F.lit(True).alias("_in_calendar")), "DateKey", "left")
    return x.withColumn("RejectReason", _reject_reason()).drop("_in_calendar")


def load_facts(classified: DataFrame, existing_sales: DataFrame | None = None) -> DataFrame:
    """Fact rows for the loadable part of ``classify_facts`` output, with SalesIDs after
    the largest existing one (ties between identical rows do not matter)."""
    ok = classified.where(F.col("RejectReason").isNull())
    facts = ok.select(
        "CustomerKey", "ProductKey", "DateKey", F.col("RegionKey").cast("int").alias("RegionKey"),
        F.col("OrderID").alias("OrderNumber"),
        F.col("OrderDate").alias("TransactionDate"), "Quantity",
        # the source writes the float's decimal text into DECIMAL columns: round half up
        # on that text, which is what Spark's round(double, d) does
        F.round("UnitPrice", 2).cast(DecimalType(10, 2)).alias("UnitPrice"),
        F.round("SalesAmount", 2).cast(DecimalType(15, 2)).alias("SalesAmount"),
        F.round("NetSalesAmount", 2).cast(DecimalType(15, 2)).alias("NetSalesAmount"))
    if existing_sales is None:
        start = F.lit(FIRST_SALES_ID - 1).cast("long")
    else:
        start = existing_sales.select(
            F.greatest(F.coalesce(F.max("SalesID"), F.lit(0)), F.lit(FIRST_SALES_ID - 1)).cast("long")).scalar()
    order = [F.col(c).asc() for c in facts.columns]
    numbered = global_row_number(facts, order, rank_col="_n")
    # what is the same in every row does not go through the sort
    none = F.lit(0).cast(DecimalType(10, 2))
    return numbered.select(
        (start + F.col("_n")).alias("SalesID"), "CustomerKey", "ProductKey", "DateKey", "RegionKey",
        "OrderNumber", F.lit(1).alias("OrderLineNumber"), "TransactionDate", "Quantity", "UnitPrice",
        "SalesAmount", none.alias("DiscountAmount"), none.alias("TaxAmount"), "NetSalesAmount",
        F.lit("N").alias("ReturnFlag"))


def rejects(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("RejectReason").isNotNull())
