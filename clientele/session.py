"""Spark session and lineage helpers shared by the library, tests and bench."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job of this library assumes. Timestamps are compared as UTC, ANSI
# arithmetic stays on (zero division is handled with try_divide), and AQE is left
# to coalesce small shuffles, split skewed join partitions and turn shuffle joins
# into broadcast joins once the real size of a side is known.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "clientele", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench. On a cluster, use the cluster's session."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SHUFFLE_INPUT_BYTES = 4 << 20


def shuffle_partitions(spark: SparkSession) -> int:
    """Partitions that a shuffle starts with."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(spark.conf.get(INITIAL_PARTITIONS, None) or 0))


def size_shuffles(spark: SparkSession, input_bytes: int) -> None:
    """Let shuffles start with at least one partition per ``SHUFFLE_INPUT_BYTES`` of stored input.

    With a fixed number of partitions what one task sorts and hashes grows with the input,
    until it spills. AQE merges those that turn out small; a larger setting is kept.
    """
    wanted = -(-input_bytes // SHUFFLE_INPUT_BYTES)
    if wanted > shuffle_partitions(spark):
        spark.conf.set(INITIAL_PARTITIONS, str(wanted))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder of the session.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that one is always
    used. Only on a local master (tests, bench), where driver and executors are one
    process, a fresh scratch folder is created when nothing is configured; on any other
    master that would be a folder the executors cannot see, so it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    sc.setCheckpointDir(configured or scratch_folder(sc.master))
    return sc.getCheckpointDir()


def scratch_folder(master: str) -> str:
    if master != "local" and not master.startswith("local["):
        raise ValueError("spark.checkpoint.dir is not set: a cluster needs a folder that the "
                         f"driver and all executors share (master {master})")
    return tempfile.mkdtemp(prefix="clientele-ckpt-")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet into the session's shared folder and read it back.

    Used where a result is consumed by several jobs that must see identical rows or where
    a long plan would otherwise be recomputed. The plan runs once, later readers prune
    columns and push filters down, Spark knows the table's size, and the rows survive the
    loss of executors.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/tables/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
