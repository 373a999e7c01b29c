"""K-d tree sharding by weighted medians of document metadata.

Method. The tree starts with all rows in one node. A node with k leaves to come is split
along its widest metadata dimension (extent relative to the dimension's extent over all
rows) at the weighted quantile that gives the left child half of the leaves (k // 2 of k)
and their share of the bytes; ties are split by a hash of id and text. All nodes of a
level are split together. There are as many leaves as the target bytes ask for.

Scale. Texts are read once, to size them; the tree works on a staged table of a few numbers
per row. Each level is one aggregation for the extents plus a radix selection for the
medians (``selection.py``), so no level sorts or shuffles rows, and a hot value (one source
with a third of all rows) is split by the tie-break. The number of levels is the logarithm of
the number of leaves. A level's splits are a staged table of one row per node, so that no node
reaches the driver and Spark knows the size of what it joins. Slots come from row numbers
within (shard, partition) plus offsets.

Law: ``bytes``. Leaf sizes differ by about one row's size per level.

Dimensions: whole numbers as they are (by rank if they span 2^62 or more), all else (texts in
code point order, fractions, dates) by the dense rank of the distinct values; nulls before
everything. Defined results. Null text: size 1, checksum of the empty text.
Null ids and repeated rows: each row gets its own slot. Empty table: empty result. Extra
columns: ignored. Fewer rows than leaves, or
a row larger than a leaf: some leaves stay empty.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from clientele.llm.selection import crossing_keys, key_bits
from clientele.llm.staging import Staging, beside, dropped_after, numbered_rows, row_key
from clientele.operators.ranking import global_row_number

TIE_BITS = 36
WIDE = 1 << 62  # a difference beyond this could leave 64 bits


def _ranked(stage: Staging, rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with the column ``name`` as the rank of its value from 1, null as 0."""
    values = global_row_number(rows.select(name).where(F.col(name).isNotNull()).distinct(),
                               [F.col(name)], rank_col="rank")
    values = stage.put(values.select(name, "rank"), f"values-{name}")
    return (rows.join(values, name, "left")
            .withColumn(name, F.coalesce(F.col("rank").cast("long"), F.lit(0).cast("long"))).drop("rank"))


def _from_zero(stage: Staging, rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """``rows`` with all dimensions as longs: null 0, everything else from 1."""
    numbers = [n for n in names if isinstance(rows.schema[n].dataType, IntegralType)]
    bounds = rows.agg(F.count(F.lit(1)), *(F.min(n).alias(f"min_{n}") for n in numbers),
                      *(F.max(n).alias(f"max_{n}") for n in numbers)).first()
    ranked = [n for n in names if n not in numbers
              or (bounds[f"max_{n}"] or 0) - (bounds[f"min_{n}"] or 0) >= WIDE]
    for n in names:
        if n in ranked:
            rows = _ranked(stage, rows, n)
        else:
            lowest = F.lit(bounds[f"min_{n}"] or 0).cast("long")
            rows = rows.withColumn(n, F.coalesce(F.col(n).cast("long") - lowest + 1, F.lit(0).cast("long")))
    return stage.put(rows, "ranked") if ranked else rows


def kd_shards(docs: DataFrame, dims: Sequence[str] = ("lang", "source", "n_chars"),
              target_bytes: int | None = None, shards: int | None = None,
              id_col: str = "doc_id", text_col: str = "text",
              key_col: str | None = None) -> DataFrame:
    """Per row: id, size, text_crc32, shard, slot, row_key (``key_col`` or a hash of id and text).

    Give ``target_bytes`` (leaves of about that size) or the number of ``shards``.
    """
    spark = docs.sparkSession
    stage = Staging(spark, "kd-shards")
    text = F.coalesce(F.col(text_col), F.lit(""))
    names = [f"dim{i}" for i in range(len(dims))]
    rows = docs.select(
        F.col(id_col).alias("row_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"),
        (F.col(key_col) if key_col else row_key(id_col, text_col)).alias("key_of_row"),
        row_key(id_col, text_col).bitwiseAND(F.lit((1 << TIE_BITS) - 1)).alias("tie"),
        *(F.col(d).alias(n) for d, n in zip(dims, names)))
    rows = stage.put(rows, "rows")
    rows = _from_zero(stage, rows, names)
    whole = rows.agg(F.sum("size").alias("bytes"), *(F.max(n).alias(f"max_{n}") for n in names),
                     *(F.min(n).alias(f"min_{n}") for n in names)).first()
    if shards is None:
        shards = max(1, -(-(whole["bytes"] or 0) // target_bytes))
    extent = {n: max(1, (whole[f"max_{n}"] or 0) - (whole[f"min_{n}"] or 0)) for n in names}
    bits = key_bits(max(whole[f"max_{n}"] or 0 for n in names))

    # a node is named by its first leaf; k is the number of leaves below it
    rows = rows.withColumn("node", F.lit(0)).withColumn("k", F.lit(shards))
    value = F.element_at(F.array(*names), F.col("dim"))
    held = ["rows", "ranked"]  # staged tables of all rows; the next one takes their place
    for level in range((shards - 1).bit_length()):
        stats = rows.where("k > 1").groupBy("node", "k").agg(
            F.sum("size").alias("bytes"),
            # the first of the widest dimensions
            F.array_max(F.array(*(F.struct(((F.max(n) - F.min(n)) / F.lit(extent[n])).alias("share"),
                                           F.lit(-i).alias("place"))
                                  for i, n in enumerate(names, 1)))).alias("widest"))
        half = F.floor(F.col("k") / 2).cast("int")
        splits = stage.put(stats.select(
            F.col("node").alias("g"), F.lit(0).alias("target"), (-F.col("widest.place")).alias("dim"),
            half.alias("half"), (F.col("bytes") * half / F.col("k")).alias("goal")), f"splits-{level}")
        keyed = rows.join(splits, F.col("node") == F.col("g")).select(
            "g", value.alias("key"), "tie", F.col("size").alias("w"))
        cut = crossing_keys(stage, f"value-{level}", keyed, splits.select("g", "target", "goal"), bits)
        # among equal values the tie-break decides
        ties = keyed.join(cut.select("g", "cut"), "g").where("key = cut")
        rest = cut.select("g", "target", (F.col("goal") - F.col("before")).alias("goal"))
        tie_cut = crossing_keys(stage, f"tie-{level}", ties.select("g", F.col("tie").alias("key"), "w"),
                                rest, TIE_BITS)
        tie_cut = tie_cut.select(
            "g", F.col("cut").alias("tie_cut"),
            # the row at the border goes to the side whose size it brings nearer to the goal
            (F.col("before") + F.col("at_cut") - F.col("goal")
             < F.col("goal") - F.col("before")).alias("take"))
        borders = splits.select("g", "dim", "half").join(cut.select("g", "cut"), "g").join(
            tie_cut, "g", "left")
        left = ((value < F.col("cut"))
                | ((value == F.col("cut"))
                   & ((F.col("tie") < F.coalesce("tie_cut", F.lit(0)))
                      | ((F.col("tie") == F.col("tie_cut")) & F.coalesce("take", F.lit(False))))))
        done = F.col("g").isNull()
        right = ~done & ~F.coalesce(left, F.lit(False))
        rows = rows.join(borders, F.col("node") == F.col("g"), "left").select(
            *(c for c in rows.columns if c not in ("node", "k")),
            F.when(right, F.col("node") + F.col("half")).otherwise(F.col("node")).alias("node"),
            F.when(done, F.col("k")).when(right, F.col("k") - F.col("half"))
            .otherwise(F.col("half")).alias("k"))
        rows = stage.put(rows, f"level-{level}")
        stage.drop(*held)
        held = [f"level-{level}"]

    placed = rows.select("row_id", "key_of_row", "size", "crc", F.col("node").alias("shard"),
                         F.spark_partition_id().alias("part"),
                         F.monotonically_increasing_id().alias("at"))
    placed = stage.put(placed, "placed")
    stage.drop(*held)
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    counts = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    offsets = stage.put(counts.select("shard", "part", (F.sum("n").over(before) - F.col("n"))
                                      .alias("offset")), "offsets")
    inside = Window.partitionBy("shard", "part").orderBy("at")
    numbered = placed.withColumn("nth", F.row_number().over(inside) - 1)
    return numbered.join(offsets, ["shard", "part"]).select(
        F.col("row_id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard",
        (F.col("offset") + F.col("nth")).cast("long").alias("slot"),
        F.col("key_of_row").alias("row_key"))


def shard_documents(docs: DataFrame, dims: Sequence[str] = ("lang", "source", "n_chars"),
                    target_bytes: int | None = None, shards: int | None = None,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns as they are, with shard and slot (in place of columns of
    these names, if there are any). Rows are told apart by a number of their own, so other
    columns may have any name and type."""
    stage = Staging(docs.sparkSession, "shard-documents")
    rows = numbered_rows(stage, docs.drop("shard", "slot"))
    doc, names = F.col("doc"), [f"dim{i}" for i in range(len(dims))]
    parts = rows.select("row", doc[id_col].alias("doc_id"), doc[text_col].alias("text"),
                        *(doc[d].alias(n) for d, n in zip(dims, names)))
    with dropped_after():  # of the tree's tables only the rows' places are needed
        placed = kd_shards(parts, names, target_bytes, shards, key_col="row")
        placed = stage.put(placed.select(F.col("row_key").alias("row"), "shard", "slot"), "places")
    return rows.join(beside(placed), "row").select("doc.*", "shard", "slot")
