"""Written tables in the shared folder of the session, used to cut lineage.

``spark.checkpoint.dir`` names a folder that the driver and all executors reach. A
staged table is plain Parquet there: it survives lost executors, is pruned by column
when read, has a known size (so Spark may broadcast it only when it really is small),
and gives later jobs the very same rows. The shuffle files behind a staged table are deleted
once it is written: nothing reads them again, and over many tables they would add up.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.session import ensure_checkpoint_dir


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # of Spark 4.1; older ones ignore it

_scopes: list[list[Staging]] = []


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Spark deletes the shuffle files of a query that is run inside it when the query ends."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


@contextmanager
def dropped_after() -> Iterator[None]:
    """Delete at its end, also after an error, all folders that were staged inside it. What was
    computed from them must be written by then."""
    _scopes.append([])
    try:
        yield
    finally:
        for stage in _scopes.pop():
            delete_path(stage.spark, stage.path)


class Staging:
    """One folder of staged tables: ``put`` writes and rereads, ``drop`` deletes."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
        if _scopes:
            _scopes[-1].append(self)

    def put(self, df: DataFrame, name: str, mode: str = "errorifexists") -> DataFrame:
        with shuffles_dropped(self.spark):
            df.write.mode(mode).option("compression", "zstd").parquet(f"{self.path}/{name}")
        return self.get(name, df.schema)

    def get(self, name: str, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            delete_path(self.spark, f"{self.path}/{name}")


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's FileSystem, whatever store holds it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered_rows(stage: Staging, docs: DataFrame) -> DataFrame:
    """``docs`` staged as (row, doc): a number that only this row has, and all its columns in one
    struct. So equal rows and rows without id stay apart, no two rows can be taken for each
    other, and no column's name or type can get in the way. ``select("doc.*")`` undoes it."""
    return stage.put(docs.select(F.monotonically_increasing_id().alias("row"),
                                 F.struct("*").alias("doc")), "numbered-rows")


def beside(rows: DataFrame) -> DataFrame:
    """A staged table with a line per numbered row, to be joined with them by a shuffle: row
    numbers compress so well that Spark would take its files for small enough to broadcast."""
    return rows.hint("merge")


def row_key(id_col: str, text_col: str) -> Column:
    """A 64-bit hash of id and text: an order that reruns repeat, not an identity."""
    return F.xxhash64(F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit("")))
