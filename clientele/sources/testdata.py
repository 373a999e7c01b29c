"""TPC-H-like parquet tables mapped onto the retail star schema.

The mapping is the same one the DuckDB oracle uses (see ``clientele/plans/oracle.py``):

* Dim_Customer: one row per customer; RegistrationDate is the date of the customer's
  first order (``default_registration`` when the customer has none).
* Dim_Product: one row per part; the product *name* is ``p_name``, the category
  ``p_type``.
* Dim_Region: one row per nation; RegionName is the nation's region name.
* Fact_Sales: one row per order line; the sale date is the order date, the region is
  the supplier's nation, and a line with return flag ``R`` is a return (``Y``).

Every frame is lazy; only the columns a query references are read from parquet.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from clientele.functions.dates import date_key
from clientele.functions.numeric import MONEY
from clientele.session import size_shuffles
from clientele.sources.schemas import TESTDATA
from clientele.sources.sinks import stored_bytes

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# Fixed values of the mapping.
DEFAULT_REGISTRATION = _dt.date(1995, 1, 1)
TESTDATA_AS_OF = _dt.date(2001, 8, 2)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TESTDATA:
        reader = reader.schema(TESTDATA[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def dim_customer(customer: DataFrame, orders: DataFrame,
                 default_registration: _dt.date = DEFAULT_REGISTRATION) -> DataFrame:
    first_order = (orders.groupBy(F.col("o_custkey").alias("_ck"))
                   .agg(F.min("o_orderdate").alias("_first_order")))
    c = customer.join(first_order, customer["c_custkey"] == first_order["_ck"], "left")
    return c.select(
        F.col("c_custkey").cast("long").alias("CustomerKey"),
        F.col("c_name").alias("CustomerID"),
        F.col("c_name").alias("CustomerName"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("Email"),
        F.lit(None).cast("string").alias("Phone"),
        F.coalesce(F.to_date("_first_order"), F.lit(default_registration)).alias("RegistrationDate"),
        F.lit(None).cast("string").alias("LifecycleStatus"),
        F.lit(True).alias("IsCurrentRecord"),
    )


def dim_product(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").cast("long").alias("ProductKey"),
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("ProductID"),
        F.col("p_name").alias("ProductName"),
        F.col("p_type").alias("Category"),
        F.col("p_brand").alias("SubCategory"),
        F.col("p_retailprice").cast(DecimalType(10, 2)).alias("UnitPrice"),
        F.lit(True).alias("IsActive"),
    )


def dim_region(nation: DataFrame, region: DataFrame) -> DataFrame:
    r = nation.join(region, nation["n_regionkey"] == region["r_regionkey"], "left")
    return r.select(
        F.col("n_nationkey").cast("int").alias("RegionKey"),
        F.concat(F.lit("R"), F.col("n_nationkey").cast("string")).alias("RegionID"),
        F.col("r_name").alias("RegionName"),
        F.col("n_name").alias("Country"),
        F.concat(F.lit("STATE_"), F.col("n_nationkey").cast("string")).alias("State"),
        F.lit(None).cast("string").alias("City"),
        F.lit(True).alias("IsActive"),
    )


def fact_sales(lineitem: DataFrame, orders: DataFrame, supplier: DataFrame | None = None) -> DataFrame:
    """One fact row per order line.

    ``supplier`` is only needed for RegionKey; consumers that do not use the region
    pass ``None`` and the supplier join disappears from their plan.
    """
    li = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                         "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag")
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    # Both sides grow with the data: co-partition them on the order key (sort-merge,
    # spills, AQE splits a skewed order) instead of letting the planner broadcast
    # whichever side happens to be small in a test.
    f = li.join(o.hint("merge"), li["l_orderkey"] == o["o_orderkey"])
    region_key = F.lit(None).cast("int")
    if supplier is not None:
        s = supplier.select("s_suppkey", "s_nationkey")
        f = f.join(s, f["l_suppkey"] == s["s_suppkey"])
        region_key = F.col("s_nationkey").cast("int")
    gross = F.col("l_extendedprice").cast(MONEY)
    net = F.round(gross * (F.lit(1) - F.col("l_discount").cast(DecimalType(4, 2))), 2).cast(MONEY)
    qty = F.col("l_quantity").cast("int")
    return f.select(
        F.col("o_custkey").cast("long").alias("CustomerKey"),
        F.col("l_partkey").cast("long").alias("ProductKey"),
        date_key("o_orderdate").alias("DateKey"),
        region_key.alias("RegionKey"),
        F.col("l_orderkey").cast("string").alias("OrderNumber"),
        F.col("l_linenumber").cast("int").alias("OrderLineNumber"),
        F.col("o_orderdate").alias("TransactionDate"),
        qty.alias("Quantity"),
        F.round(F.try_divide(gross, qty), 2).cast(DecimalType(10, 2)).alias("UnitPrice"),
        gross.alias("SalesAmount"),
        (gross - net).cast(DecimalType(10, 2)).alias("DiscountAmount"),
        F.round(net * F.col("l_tax").cast(DecimalType(4, 2)), 2).cast(DecimalType(10, 2)).alias("TaxAmount"),
        net.alias("NetSalesAmount"),
        F.when(F.col("l_returnflag") == "R", F.lit("Y")).otherwise(F.lit("N")).alias("ReturnFlag"),
    )


# one order in so many is copied into the feed with a damaged field (its key's remainder says which)
DAMAGE_EVERY = 40


@dataclass
class Star:
    """The star schema over one directory of testdata parquet files (lazy frames; each
    source table is opened once per Star)."""

    spark: SparkSession
    sf_dir: str
    _tables: dict = field(default_factory=dict, repr=False)

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = read_table(self.spark, self.sf_dir, name)
        return self._tables[name]

    @property
    def customer(self) -> DataFrame:
        return dim_customer(self.table("customer"), self.table("orders"))

    @property
    def product(self) -> DataFrame:
        return dim_product(self.table("part"))

    @property
    def region(self) -> DataFrame:
        return dim_region(self.table("nation"), self.table("region"))

    def sales(self, with_region: bool = True) -> DataFrame:
        return fact_sales(self.table("lineitem"), self.table("orders"),
                          self.table("supplier") if with_region else None)

    def raw_transactions(self) -> DataFrame:
        """The data in the shape of the raw transaction CSV (all columns as text)."""
        li = self.table("lineitem").select("l_orderkey", "l_partkey", "l_quantity",
                                           "l_extendedprice", "l_discount")
        o = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        p = self.table("part").select("p_partkey", "p_type")
        # parts first: where they are no broadcast, lines move before the order widens them
        typed = li.join(p, li["l_partkey"] == p["p_partkey"]).drop("l_partkey", "p_partkey")
        x = typed.join(o.hint("merge"), typed["l_orderkey"] == o["o_orderkey"])
        net = F.round(F.col("l_extendedprice").cast(MONEY)
                      * (F.lit(1) - F.col("l_discount").cast(DecimalType(4, 2))), 2).cast("double")
        return x.select(
            F.col("l_orderkey").cast("string").alias("Transaction ID"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("Date"),
            F.col("o_custkey").cast("string").alias("Customer ID"),
            F.col("p_type").alias("Product Category"),
            F.col("l_quantity").cast("int").cast("string").alias("Quantity"),
            (F.col("l_extendedprice") / F.col("l_quantity")).cast("string").alias("Price per Unit"),
            net.cast("string").alias("Total Amount"),
        )

    def feed(self) -> DataFrame:
        """The whole feed: all sound rows, and copies of some with one field spoiled, by a rule on
        the order key; kind 8 is sound (a whole number written with a decimal point). Copies are
        made row by row, so the lines are joined once."""
        kind = F.col("`Transaction ID`").cast("long") % DAMAGE_EVERY
        both = F.array(F.lit(False), F.lit(True))
        rows = self.raw_transactions().withColumn("_kind", kind).withColumn(
            "_copy", F.explode(F.when(kind <= 8, both).otherwise(F.array(F.lit(False)))))

        def spoil(column: str, kinds: dict[int, str | None]):
            out = F.when(~F.col("_copy"), F.col(f"`{column}`"))
            for k, text in kinds.items():
                out = out.when(F.col("_kind") == k, F.lit(text).cast("string"))
            return out.otherwise(F.col(f"`{column}`")).alias(column)

        quantity = F.when(F.col("_copy") & (F.col("_kind") == 8),
                          F.concat("Quantity", F.lit(".0"))).otherwise(
            spoil("Quantity", {1: "many", 7: "-1"}))
        return rows.select(
            F.when(F.col("_copy"), F.concat(F.lit("D"), F.col("`Transaction ID`")))
             .otherwise(F.col("`Transaction ID`")).alias("Transaction ID"),
            spoil("Date", {0: "not a date", 6: "1901-01-01"}),
            spoil("Customer ID", {4: None}),
            spoil("Product Category", {5: None}),
            quantity.alias("Quantity"),
            spoil("Price per Unit", {2: "free"}),
            spoil("Total Amount", {3: "oops"}),
        )

    def malformed_lines(self) -> DataFrame:
        """CSV lines made of feed rows by the same rule: of kind 9 with three fields missing,
        of kind 10 with one field too many."""
        kind = F.col("`Transaction ID`").cast("long") % DAMAGE_EVERY
        first = F.concat_ws(",", F.concat(F.lit("L"), F.col("`Transaction ID`")), "Date",
                            F.col("`Customer ID`"), F.col("`Product Category`"))
        return self.raw_transactions().where(kind.isin(9, 10)).select(
            F.when(kind == 9, first).otherwise(F.concat(first, F.lit(",1,2,3,4"))).alias("line"))


_STARS: dict[tuple[str, str], Star] = {}


def load_star(spark: SparkSession, sf_dir: str) -> Star:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STARS:
        _STARS[key] = Star(spark, sf_dir)
        size_shuffles(spark, sum(stored_bytes(spark, f"{sf_dir.rstrip('/')}/{t}.parquet") for t in TABLES))
    return _STARS[key]
