"""Table sinks: replace or append whole tables (set-based, one write per table), and sets of
tables that are replaced together.

A set of tables lives in a folder with one subfolder per version. A version is written beside
the others and becomes visible, with all its tables, by one empty marker file whose name
holds its number. So a reader sees all old or all new tables, a run that breaks off is never
seen, and readers of the version before can finish until it is dropped.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """``overwrite`` replaces the table (the source's ``if_exists='replace'``);
    ``append`` adds rows (its INSERT path). Parquet, optionally partitioned."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _store(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def table_exists(spark: SparkSession, path: str) -> bool:
    store, hadoop = _store(spark, path)
    return bool(store.exists(hadoop))


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of a table's files; 0 if there is none."""
    store, hadoop = _store(spark, path)
    return int(store.getContentSummary(hadoop).getLength()) if store.exists(hadoop) else 0


def drop_table(spark: SparkSession, path: str) -> None:
    store, hadoop = _store(spark, path)
    store.delete(hadoop, True)


MARKERS = "_versions"


def _names(spark: SparkSession, path: str) -> list[str]:
    store, hadoop = _store(spark, path)
    if not store.exists(hadoop):
        return []
    return sorted(f.getPath().getName() for f in store.listStatus(hadoop))


def published_versions(spark: SparkSession, folder: str) -> list[str]:
    """Versions that were published, oldest first."""
    return _names(spark, f"{folder.rstrip('/')}/{MARKERS}")


def new_version(spark: SparkSession, folder: str) -> str:
    """A name after all published ones; its tables belong below ``folder/<name>``."""
    versions = published_versions(spark, folder)
    number = int(versions[-1].split("-")[0]) + 1 if versions else 1
    return f"{number:012d}-{uuid.uuid4().hex[:8]}"


def publish_version(spark: SparkSession, folder: str, version: str) -> None:
    """Make a version the current one, in one step."""
    store, marker = _store(spark, f"{folder.rstrip('/')}/{MARKERS}/{version}")
    if not store.createNewFile(marker):
        raise ValueError(f"version {version} of {folder} was published before")


def read_version(spark: SparkSession, folder: str, version: str | None = None) -> dict[str, DataFrame]:
    """All tables, by name, of one version; of the current one by default."""
    versions = published_versions(spark, folder)
    version = version or (versions[-1] if versions else None)
    if version not in versions:
        raise ValueError(f"{folder} holds no published version {version or ''}".rstrip())
    path = f"{folder.rstrip('/')}/{version}"
    return {name: read_table(spark, f"{path}/{name}") for name in _names(spark, path)}


def drop_versions(spark: SparkSession, folder: str, keep: int = 2) -> list[str]:
    """Drop all but the last ``keep`` published versions; the marker goes first."""
    if keep < 1:
        raise ValueError("the current version stays")
    old = published_versions(spark, folder)[:-keep]
    for version in old:
        drop_table(spark, f"{folder.rstrip('/')}/{MARKERS}/{version}")
        drop_table(spark, f"{folder.rstrip('/')}/{version}")
    return old
