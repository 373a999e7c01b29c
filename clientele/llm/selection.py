"""Distributed weighted selection: where does a running sum of weights cross a goal?

Per group, rows are thought of as sorted by a 64-bit key. For a goal, the crossing key is
the first key at which the running weight exceeds the goal. It is found digit by digit,
as in radix selection: each pass sums the weights per 12-bit digit among the rows that
share the digits found so far, keeps the digit that crosses, and goes on. A pass is one
partial aggregation; at most 4,096 sums, and the goals that fall among them, are windowed
together. So nothing is sorted globally, and a group that holds a third of all rows costs
no more than the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clientele.llm.staging import Staging

DIGIT = 12


def key_bits(largest: int) -> int:
    """Key width, in whole digits, for keys from 0 to ``largest``."""
    return DIGIT * max(1, -(-largest.bit_length() // DIGIT))


def crossing_keys(stage: Staging, name: str, rows: DataFrame, goals: DataFrame,
                  bits: int = 72) -> DataFrame:
    """g, target, goal, cut, before, at_cut for every goal below its group's total weight.

    ``rows``: g, key (long; below 2**bits, and not negative unless bits is the default, which
    covers every long), w (not negative). ``goals``: g, target, goal. Keys below ``cut`` weigh ``before`` <= goal, and
    rows at ``cut`` weigh ``at_cut``, which exceeds what is left. A goal that its group's
    total does not exceed has no row.
    """
    rows = rows.select("g", "key", F.col("w").cast("double").alias("w"))
    state = goals.select("g", "target", F.col("goal").cast("double").alias("goal"),
                         F.lit(0).cast("long").alias("prefix"), F.lit(0.0).alias("before"),
                         F.lit(0.0).alias("at_cut"))
    for shift in range(bits - DIGIT, -1, -DIGIT):
        top = shift + DIGIT >= bits
        prefix = F.lit(0).cast("long") if top else F.shiftright("key", shift + DIGIT)
        found = rows.select("g", "w", prefix.alias("prefix"),
                            F.shiftright("key", shift).alias("digits"))
        # at the top nothing is found yet that could leave rows out
        found = found.where("g is not null") if top else found.join(state, ["g", "prefix"], "left_semi")
        sums = found.groupBy("g", "prefix", "digits").agg(F.sum("w").alias("at_cut")).where("at_cut > 0")
        # goals and running sums on one line, from high to low: the last sum before a goal is
        # the smallest one above it. Both come together before the sums run, in one shuffle.
        none = F.lit(None).cast("double")
        line = sums.select("g", "prefix", "digits", "at_cut", F.lit(0).alias("kind"), none.alias("goal"),
                           none.alias("before"), F.lit(None).cast(state.schema["target"].dataType).alias("target"))
        line = line.unionByName(state.select(
            "g", "prefix", F.lit(None).cast("long").alias("digits"), none.alias("at_cut"),
            F.lit(1).alias("kind"), "goal", "before", "target"))
        goal = F.col("kind") == 1
        order = Window.partitionBy("g", "prefix").orderBy("digits")
        line = line.withColumn("upto", F.sum("at_cut").over(order)).select(
            "g", "prefix", "kind", "goal", "before", "target",
            F.when(goal, F.col("goal") - F.col("before")).otherwise(F.col("upto")).alias("at"),
            F.when(~goal, F.struct("digits", "upto", "at_cut")).alias("sum"))
        down = (Window.partitionBy("g", "prefix").orderBy(F.desc("at"), F.desc("kind"))
                .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        crossed = line.withColumn("sum", F.last("sum", ignorenulls=True).over(down)).where(
            (F.col("kind") == 1) & F.col("sum").isNotNull())
        state = stage.put(crossed.select(
            "g", "target", "goal", F.col("sum.digits").alias("prefix"),
            (F.col("before") + F.col("sum.upto") - F.col("sum.at_cut")).alias("before"),
            F.col("sum.at_cut").alias("at_cut")), f"{name}-{shift}")
    return state.withColumnRenamed("prefix", "cut")
