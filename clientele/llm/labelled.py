"""A bounded, repeatable sample of labelled documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(id_col: str = "doc_id"):
    """Rows that learning never sees: crc32 of the id as text is divisible by FOLDS."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def training_labels(labels: DataFrame, label_col: str, limit: int) -> DataFrame:
    """At most ``limit`` (doc_id, label) outside the held-out fold, in hash order.

    Rows without id or label are left out; an id with several labels takes the highest.
    """
    rows = (labels.where(F.col("doc_id").isNotNull() & F.col(label_col).isNotNull())
            .where(~held_out()).groupBy("doc_id").agg(F.max(label_col).cast("int").alias("label")))
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
