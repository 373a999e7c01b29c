"""The ingest job: one feed of raw transactions loaded into a warehouse folder.

Steps, in the order of their dependencies: transform the feed and stage it, add the
default region, new products and new customers, classify every feed row against the
updated dimensions (once, staged), add the rejects with their reasons and the facts
with their sales ids. Dimensions are idempotent: a second load of the same feed adds
nothing to them; facts are added again, as the source has no duplicate guard.

Recovery. A load is a batch. Its rows of every table are one folder, ``<table>/Batch=<id>``,
replaced as a whole when it is written again, and the last write of a load enters the batch
in the ledger. Readers see the rows of batches in the ledger only. So a load that
breaks off at any point is invisible, and is simply run again under the same id: what it left
is replaced, with the same keys, and the tables end as after one clean run. A batch that is in the
ledger is not loaded again. One load at a time writes to a warehouse.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clientele.operators import ingest as I
from clientele.session import cut_lineage
from clientele.sources import schemas as S
from clientele.sources.sinks import read_table, table_exists, write_table

# table -> the columns that an empty warehouse starts with
TABLES: dict[str, tuple[StructType, tuple[str, ...]]] = {
    "dim_region": (S.DIM_REGION, ("RegionKey", "RegionID", "RegionName", "Country", "IsActive")),
    "dim_product": (S.DIM_PRODUCT, ("ProductKey", "ProductID", "ProductName", "Category",
                                    "UnitPrice", "IsActive")),
    "dim_customer": (S.DIM_CUSTOMER, ("CustomerKey", "CustomerID", "CustomerName", "Email",
                                      "RegistrationDate", "IsCurrentRecord")),
}
FACTS, REJECTS = "fact_sales", "fact_rejects"


LEDGER = "load_ledger"
BATCH = "Batch"
_PREFIX = "batch-"  # keeps ids from being read as numbers or dates


def table_path(warehouse: str, name: str) -> str:
    return f"{warehouse.rstrip('/')}/{name}"


def batch_path(warehouse: str, name: str, batch: str) -> str:
    return f"{table_path(warehouse, name)}/{BATCH}={_PREFIX}{batch}"


def loaded_batches(spark: SparkSession, warehouse: str) -> list[str]:
    """Ids of the batches that were loaded to the end (one row each)."""
    path = table_path(warehouse, LEDGER)
    if not table_exists(spark, path):
        return []
    rows = read_table(spark, path).select(BATCH).distinct().collect()
    return sorted(r[0].removeprefix(_PREFIX) for r in rows)


def _table(spark: SparkSession, warehouse: str, name: str, batches: Sequence[str]) -> DataFrame | None:
    path = table_path(warehouse, name)
    if batches and table_exists(spark, path):
        rows = read_table(spark, path)
        return rows.where(F.col(BATCH).isin([_PREFIX + b for b in batches])).drop(BATCH)
    if name in TABLES:
        schema, columns = TABLES[name]
        return spark.createDataFrame([], schema).select(*columns)
    return None


def warehouse_table(spark: SparkSession, warehouse: str, name: str) -> DataFrame:
    """A table of the warehouse, without batches that broke off; an absent dimension is empty."""
    rows = _table(spark, warehouse, name, loaded_batches(spark, warehouse))
    if rows is None:
        raise ValueError(f"nothing was loaded into {name} of {warehouse}")
    return rows


def load_feed(raw: DataFrame, warehouse: str, calendar: DataFrame, as_of: _dt.date,
              batch: str | None = None, staged: bool = False) -> None:
    """Load one feed (see ``ingest.read_feed``) into the tables below ``warehouse``.

    ``batch`` names the load, so that it can be run again if it breaks off; without it
    every call is a load of its own. ``staged``: the feed is read from a table, so its rows are
    not written once more before the load.
    """
    spark = raw.sparkSession
    batch = batch or uuid.uuid4().hex
    before = loaded_batches(spark, warehouse)
    if batch in before:
        return
    parsed = I.parse_feed(raw) if staged else cut_lineage(I.parse_feed(raw))

    def members(key: str) -> DataFrame:
        """Each value of the column that a dimension follows from once, in the feed's columns."""
        values = parsed.select(key).distinct()
        return I.with_derived(values.select(*[F.col(c) if c == key else F.lit(None).cast(t).alias(c)
                                              for c, t in parsed.dtypes]))

    def add(name: str, rows: DataFrame) -> None:
        write_table(rows, batch_path(warehouse, name, batch))

    def extended(name: str, new) -> DataFrame:
        """A dimension with the rows that this batch adds."""
        earlier = _table(spark, warehouse, name, before)
        add(name, new(earlier))
        return _table(spark, warehouse, name, [*before, batch])

    regions = extended("dim_region", I.region_rows)
    products = extended("dim_product", lambda earlier: I.product_rows(earlier, members("Category")))
    customers = extended("dim_customer", lambda earlier: I.customer_rows(
        earlier, members("CustomerID"), as_of))
    # the rows meet their keys narrow; the columns that follow from others come after
    keyed = I.classify_facts(parsed.withColumn("ProductID", I.product_id()),
                             customers, products, regions, calendar)
    classified = I.with_derived(cut_lineage(keyed.drop("ProductID")))
    add(REJECTS, I.rejects(classified))
    add(FACTS, I.load_facts(classified, _table(spark, warehouse, FACTS, before)))
    add(LEDGER, spark.range(1).select(F.lit(str(as_of)).alias("AsOf")))
