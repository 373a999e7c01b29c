"""Market-basket analysis: baskets, frequent itemsets and association rules.

* Items are purchase lines joined to the product; an item is the product *name*.
* A basket is the set of distinct names of one order (repeated items collapse, as
  boolean encoding does; the miner rejects repeated items).
* Frequent itemsets: every itemset with support = count / baskets >= min_support,
  any length, mined by pattern growth on projected baskets (tables, weighted rows).
* Rules: for each frequent itemset, **every** non-empty proper split into antecedent
  and consequent (MLlib's own ``associationRules`` only emits one-item consequents).
  The splits grow level by level in the consequent and stop where the confidence falls short; the
  two sides' supports come from two equi-joins on the sorted item arrays.

Metrics, for sA, sC, s = supports of antecedent, consequent and both:
confidence = s/sA, lift = confidence/sC, leverage = s - sA*sC,
conviction = (1 - sC)/(1 - confidence) (infinite when confidence is 1),
zhangs_metric = leverage / max(s*(1 - sA), sA*(sC - s)) (0 when that is 0).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.operators.ranking import global_row_number, top_k
from clientele.session import cut_lineage

# Thresholds of the source analysis.
MIN_SUPPORT = 0.001
MIN_CONFIDENCE = 0.01
ITEM_SEPARATOR = ", "


def basket_items(sales: DataFrame, product: DataFrame, purchase_flag: str = "N") -> DataFrame:
    lines = sales.where(F.col("ReturnFlag") == purchase_flag).select("OrderNumber", "ProductKey")
    return lines.join(product.select("ProductKey", "ProductName", "Category"), "ProductKey").select(
        "OrderNumber", "ProductName", "Category")


def baskets(items: DataFrame, item_col: str = "ProductName") -> DataFrame:
    """One row per order: sorted array of its distinct items (partial aggregation
    de-duplicates before the shuffle, so a huge order sends one set per task)."""
    return items.groupBy("OrderNumber").agg(F.sort_array(F.collect_set(item_col)).alias("items"))


def basket_stats(items: DataFrame, item_col: str = "ProductName") -> DataFrame:
    # one read: per order its lines and distinct items, then per item; both are partial sums
    pairs = items.groupBy("OrderNumber", F.col(item_col).alias("_item")).agg(
        F.count(F.lit(1)).alias("_lines"))
    return pairs.agg(
        F.coalesce(F.sum("_lines"), F.lit(0)).alias("Lines"),
        F.count_distinct("OrderNumber").alias("Orders"),
        F.try_divide(F.sum("_lines").cast("double"), F.count_distinct("OrderNumber").cast("double"))
        .alias("AvgLinesPerOrder"),
        F.count_distinct("_item").alias("DistinctItems"))


def frequent_itemsets(basket_df: DataFrame, min_support: float = MIN_SUPPORT,
                      num_partitions: int | None = None) -> DataFrame:
    """items (sorted array), Length, Count, support, where count / baskets >= min_support.

    Pattern growth on projected baskets, as FP-growth does it, with tables for trees. Frequent
    items get numbers, baskets shrink to them, and equal baskets become one row with a weight.
    A row of a level is a frequent itemset (``prefix``), the items after it in a basket that
    can extend it (``rest``), and the weight of all baskets with this rest. Each level counts
    the items of the rests per prefix, drops the infrequent ones from the rests, extends the
    prefixes and merges rows that became equal. No task holds a tree; what is counted and merged is
    combined map-side and can spill.
    """
    basket_df = cut_lineage(basket_df.select(F.monotonically_increasing_id().alias("basket"), "items"))
    n, repeated = basket_df.agg(F.count(F.lit(1)), F.coalesce(F.bool_or(
        F.size("items") > F.size(F.array_distinct("items"))), F.lit(False))).first()
    if repeated:
        raise ValueError("items of a basket must be unique")
    if n == 0:
        return basket_df.sparkSession.createDataFrame(
            [], "items array<string>, Length int, Count long, support double")
    support = F.col("Count").cast("double") / F.lit(float(n))
    enough = support >= F.lit(min_support)
    single = basket_df.select("basket", F.explode("items").alias("item"))
    # rare items first: they have the longest rests, and few baskets
    items = cut_lineage(global_row_number(
        single.groupBy("item").agg(F.count(F.lit(1)).alias("Count")).where(enough),
        [F.col("Count").asc(), F.col("item").asc()], rank_col="code"))
    coded = single.join(items.select("item", "code"), "item").groupBy("basket").agg(
        F.sort_array(F.collect_list("code")).alias("rest"))
    if num_partitions:
        coded = coded.repartition(num_partitions)
    weighted = coded.where(F.size("rest") > 1).groupBy("rest").agg(F.count(F.lit(1)).alias("weight"))
    rows = _extended(weighted.withColumn("prefix", F.array().cast("array<bigint>")))
    levels = [items.select(F.array("code").alias("codes"), "Count")]
    while True:
        counted = cut_lineage(
            rows.select("prefix", F.explode("rest").alias("item"), "weight")
            .groupBy("prefix", "item").agg(F.sum("weight").alias("Count")).where(enough))
        if counted.isEmpty():
            break
        levels.append(counted.select(F.concat("prefix", F.array("item")).alias("codes"), "Count"))
        extending = counted.groupBy("prefix").agg(F.collect_list("item").alias("_frequent"))
        rows = _extended(rows.join(extending, "prefix").withColumn(
            "rest", F.array_intersect("rest", "_frequent")))
    found = levels[0]
    for level in levels[1:]:
        found = found.unionByName(level)
    named = (found.select("codes", "Count", F.explode("codes").alias("code"))
             .join(items.select("code", "item"), "code").groupBy("codes", "Count")
             .agg(F.sort_array(F.collect_list("item")).alias("items")))
    return cut_lineage(named.select("items", F.size("items").alias("Length"), "Count",
                                    support.alias("support")))


def _extended(rows: DataFrame) -> DataFrame:
    """Every prefix extended by every item of its rest that has items after it."""
    grown = rows.where(F.size("rest") > 1).select(
        "prefix", "rest", "weight", F.explode(F.sequence(F.lit(1), F.size("rest") - 1)).alias("at"))
    return cut_lineage(
        grown.select(F.concat("prefix", F.array(F.element_at("rest", F.col("at")))).alias("prefix"),
                     F.slice("rest", F.col("at") + 1, F.size("rest")).alias("rest"), "weight")
        .groupBy("prefix", "rest").agg(F.sum("weight").alias("weight")))


def association_rules(itemsets: DataFrame, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """All-split rules of ``frequent_itemsets`` output, filtered by confidence."""
    itemsets = cut_lineage(itemsets.select("items", "Length", "support"))
    supports = itemsets.select("items", "support")
    antecedents = supports.select(F.col("items").alias("antecedent"), F.col("support").alias("sA"))
    last = F.lit(0)  # place of the consequent's last item; the next one comes after it
    level = (itemsets.where("Length >= 2")
             .select("items", "support", F.array().cast("array<string>").alias("consequent"),
                     last.alias("last")))
    longest = itemsets.agg(F.max("Length")).first()[0] or 0
    levels = []
    for _ in range(1, longest):
        grown = (level.where(F.size("consequent") + 1 < F.size("items"))
                 .where(F.col("last") < F.size("items"))
                 .withColumn("next", F.explode(F.sequence(F.col("last") + 1, F.size("items"))))
                 .select("items", "support", F.col("next").alias("last"),
                         F.concat("consequent", F.array(F.element_at("items", F.col("next"))))
                         .alias("consequent")))
        grown = grown.withColumn("antecedent", F.array_except("items", "consequent"))
        level = cut_lineage(grown.join(antecedents, "antecedent")
                            .where(F.col("support") / F.col("sA") >= F.lit(min_confidence)))
        if not level.take(1):
            break
        levels.append(level)
    if not levels:
        level = level.withColumns({"antecedent": F.col("consequent"), "sA": F.lit(0.0)}).where(F.lit(False))
        levels.append(level)
    sides = levels[0].select("antecedent", "consequent", "sA", "support")
    for more in levels[1:]:
        sides = sides.unionByName(more.select("antecedent", "consequent", "sA", "support"))
    c = supports.select(F.col("items").alias("consequent"), F.col("support").alias("sC"))
    r = sides.withColumnRenamed("support", "s").join(c, "consequent")
    s, sa, sc = F.col("s"), F.col("sA"), F.col("sC")
    confidence = s / sa
    leverage = s - sa * sc
    zhang_den = F.greatest(s * (F.lit(1.0) - sa), sa * (sc - s))
    return r.select(
        "antecedent", "consequent",
        sa.alias("antecedent_support"), sc.alias("consequent_support"), s.alias("support"),
        confidence.alias("confidence"),
        (confidence / sc).alias("lift"),
        leverage.alias("leverage"),
        F.when(confidence < F.lit(1.0), (F.lit(1.0) - sc) / (F.lit(1.0) - confidence))
         .otherwise(F.lit(float("inf"))).alias("conviction"),
        F.when(zhang_den == F.lit(0.0), F.lit(0.0)).otherwise(leverage / zhang_den).alias("zhangs_metric"),
    )


def rules_as_text(rules: DataFrame) -> DataFrame:
    """antecedents / consequents as sorted, comma-separated text (the persisted form)."""
    cols = [c for c in rules.columns if c not in ("antecedent", "consequent")]
    return rules.select(F.array_join("antecedent", ITEM_SEPARATOR).alias("antecedents"),
                        F.array_join("consequent", ITEM_SEPARATOR).alias("consequents"), *cols)


def top_rules(rules: DataFrame, k: int = 10) -> DataFrame:
    """Strongest k rules by lift, ties by rule text."""
    t = rules_as_text(rules)
    return top_k(t, [F.col("lift").desc(), F.col("antecedents").asc(), F.col("consequents").asc()], k)
