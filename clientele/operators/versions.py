"""Dimensions with versions: a changed member closes its open version and opens another.

A version is a row with its own surrogate key, in force from ``ValidFrom`` up to, not
including, ``ValidTo`` (null while it is open); ``IsCurrentRecord`` marks the open one.

``merge_versions`` compares a feed with the open versions in one full outer join on the
business key. Attributes are compared by value, nulls being equal: both sides meet in that
join anyway, so a hash of them would save nothing and could miss a change. The compared rows
are written once; versions to be closed and to be opened are read from that table, and
only the latter are sorted and numbered. Closed versions are neither joined nor sorted.

* A member that the feed does not name stays as it is; the same feed again changes nothing.
* Null business keys are left out. Of several spellings of one key the smallest attribute
  tuple wins, as in ``ingest.upsert_dim``.
* Loads come in order of their dates: one before the latest ``ValidFrom`` is an error. A second
  change on the same day leaves a version in force for no time, which no lookup finds.

``keys_at`` finds the version in force at a row's own time: a join on the business key with the
interval as a further condition, so a member with a third of all rows is split by AQE as in
any equi-join.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.operators.ranking import global_row_number
from clientele.session import cut_lineage

VALID_FROM, VALID_TO, CURRENT = "ValidFrom", "ValidTo", "IsCurrentRecord"


def merge_versions(existing: DataFrame | None, feed: DataFrame, business_key: str, surrogate_key: str,
                   attributes: Sequence[str], valid_from: _dt.date) -> DataFrame:
    """The whole dimension after the load: surrogate key, business key, attributes, ValidFrom,
    ValidTo, IsCurrentRecord. ``existing`` is an earlier result, or None for an empty dimension."""
    columns = [surrogate_key, business_key, *attributes, VALID_FROM, VALID_TO, CURRENT]
    since = F.lit(str(valid_from)).cast("date")
    values = F.struct(*attributes)
    members = (feed.where(F.col(business_key).isNotNull()).select(business_key, *attributes).distinct()
               .groupBy(business_key).agg(F.min(values).alias("_new")))
    if existing is None:
        start, opened = F.lit(0).cast("long"), members
    else:
        latest = existing.agg(F.max(VALID_FROM)).first()[0]
        if latest is not None and latest > valid_from:
            raise ValueError(f"the dimension holds versions from {latest}, after {valid_from}")
        start = existing.select(F.coalesce(F.max(surrogate_key), F.lit(0)).cast("long")).scalar()
        held = existing.where(CURRENT).select(
            business_key, F.struct(surrogate_key, VALID_FROM).alias("_row"), values.alias("_old"))
        compared = cut_lineage(held.join(members, business_key, "full_outer").withColumn(
            "_changed", F.col("_new").isNotNull() & ~F.col("_new").eqNullSafe(F.col("_old"))))
        opened = compared.where("_changed")

    def rows(df: DataFrame, key: Column, taken: str, begin: Column, closed: Column) -> DataFrame:
        return df.select(key.alias(surrogate_key), business_key,
                         *[F.col(taken)[a].alias(a) for a in attributes], begin.alias(VALID_FROM),
                         F.when(closed, since).alias(VALID_TO), (~closed).alias(CURRENT))

    numbered = global_row_number(opened.select(business_key, "_new"), [F.col(business_key).asc()],
                                 rank_col="_n")
    new = rows(numbered, start + F.col("_n"), "_new", since, F.lit(False))
    if existing is None:
        return new.select(columns)
    kept = rows(compared.where(F.col("_row").isNotNull()), F.col("_row")[surrogate_key], "_old",
                F.col("_row")[VALID_FROM], F.col("_changed"))
    closed = existing.where(~F.col(CURRENT))
    return closed.select(columns).unionByName(kept.select(columns)).unionByName(new.select(columns))


def keys_at(rows: DataFrame, versions: DataFrame, business_key: str, surrogate_key: str,
            at: str) -> DataFrame:
    """``rows`` with the surrogate key of the version in force at their column ``at``; null
    where there is none (unknown member, null time, or a time before its first version)."""
    v = versions.select(F.col(business_key).alias("_member"), surrogate_key,
                        F.col(VALID_FROM).alias("_from"), F.col(VALID_TO).alias("_to"))
    in_force = (F.col("_from") <= F.col(at)) & (F.col("_to").isNull() | (F.col(at) < F.col("_to")))
    met = rows.join(v, (F.col(business_key) == F.col("_member")) & in_force, "left")
    return met.drop("_member", "_from", "_to")
