"""Recency / frequency / monetary scores, weighted index and segments.

Scores are quintiles of an exact rank (``rank(method='first')`` then ``qcut``), not
``ntile``. The rank follows the row order the scores were computed on: customers
sorted by spend descending, ties by CustomerKey. Hence the total orders

* R: RecencyDays asc, TotalSpend desc, CustomerKey asc   -> R = tiles + 1 - bin
* F: TransactionCount asc, TotalSpend desc, CustomerKey asc  -> F = bin
* M: TotalSpend asc, CustomerKey asc                     -> M = bin

(at equal frequency the higher spender ranks lower, as in the source).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.functions.numeric import round2
from clientele.operators.ranking import Order, at_or_before, rows_at
from clientele.session import cut_lineage

# Default weights of R, F and M in the index.
DEFAULT_WEIGHTS = (1.0, 1.2, 1.5)

# Segment names, in the order the rules are tried (see segment_of).
SEGMENT_NAMES = (
    "Champions",
    "Loyal Customers",
    "Potential Loyalists",
    "Customers Needing Attention",
    "At Risk",
    "Hibernating",
    "New/Low Value",
)
CHURN_SEGMENTS = ("At Risk", "Hibernating")

# Fills applied before scoring.
RECENCY_FILL = 365
FREQUENCY_FILL = 0
MONETARY_FILL = 0


def _score(order: Order, cuts: dict[int, tuple], ends: Sequence[int], tiles: int,
           invert: bool) -> Column:
    """Quantile bin by comparing a row with the rows at the bins' upper borders."""
    bin_ = F.lit(1)
    for rank, cut in cuts.items():
        # a rank that ends several bins (n < tiles) moves the rows after it on by as many
        bin_ = bin_ + F.when(F.expr(at_or_before(order, cut)), 0).otherwise(ends.count(rank))
    return F.lit(tiles + 1) - bin_ if invert else bin_


def rfm_scores(df: DataFrame, tiles: int = 5, tie_break: Sequence[str] = ("CustomerKey",)) -> DataFrame:
    """Add R_Score, F_Score, M_Score (1..tiles).

    The input is written once to the shared folder. ``rows_at`` finds the ``tiles - 1``
    customers at the bins' borders of every score by counting; then one pass compares every
    row with these few cut keys. No rank column, no shuffle of customers, no join.
    """
    d = df.withColumns({
        "RecencyDays": F.coalesce(F.col("RecencyDays"), F.lit(RECENCY_FILL)),
        "TransactionCount": F.coalesce(F.col("TransactionCount"), F.lit(FREQUENCY_FILL)),
        "TotalSpend": F.coalesce(F.col("TotalSpend"), F.lit(MONETARY_FILL).cast(
            df.schema["TotalSpend"].dataType)),
    })
    d = cut_lineage(d)
    n = d.count()
    ties = [(c, True) for c in tie_break]
    orders = {
        "R_Score": ([("RecencyDays", True), ("TotalSpend", False), *ties], True),
        "F_Score": ([("TransactionCount", True), ("TotalSpend", False), *ties], False),
        "M_Score": ([("TotalSpend", True), *ties], False),
    }
    # bin k of ``qcut`` over ranks 1..n ends at rank 1 + floor(k * (n - 1) / tiles);
    # with one row (or none) every row is in bin 1
    ends = [1 + k * (n - 1) // tiles for k in range(1, tiles)] if n > 1 else []
    cuts = rows_at(d, n, {name: (order, sorted(set(ends))) for name, (order, _) in orders.items()})
    return d.withColumns({name: _score(order, cuts[name], ends, tiles, invert).cast("int")
                          for name, (order, invert) in orders.items()})


def rfm_index(df: DataFrame, weights: Sequence[float] = DEFAULT_WEIGHTS) -> DataFrame:
    """RFM_Score = round2(weighted mean of the three scores), in DOUBLE as the source."""
    wr, wf, wm = (float(w) for w in weights)
    total = wr + wf + wm
    raw = (F.col("R_Score") * F.lit(wr) + F.col("F_Score") * F.lit(wf)
           + F.col("M_Score") * F.lit(wm)) / F.lit(total)
    return df.withColumn("RFM_Score", round2(raw))


def segment_of(r: Column, f: Column, m: Column, s: Column) -> Column:
    """First matching rule wins (fixed thresholds of the source)."""
    champions, loyal, potential, attention, at_risk, hibernating, other = SEGMENT_NAMES
    return (F.when(s >= 4.5, champions)
             .when((f >= 4) & (m >= 4), loyal)
             .when((r >= 4) & (f >= 3), potential)
             .when((r >= 3) & (s >= 3.0), attention)
             .when((r <= 2) & (f >= 3) & (m >= 3), at_risk)
             .when((r <= 2) & (f <= 2), hibernating)
             .otherwise(other))


def rfm_segments(df: DataFrame) -> DataFrame:
    return df.withColumn("Segment", segment_of(F.col("R_Score"), F.col("F_Score"),
                                               F.col("M_Score"), F.col("RFM_Score")))


def rfm(df: DataFrame, tiles: int = 5, weights: Sequence[float] = DEFAULT_WEIGHTS) -> DataFrame:
    """Scores, index and segment in one call."""
    return rfm_segments(rfm_index(rfm_scores(df, tiles), weights))
