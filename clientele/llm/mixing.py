"""Mixing sources to target weights by entropy balancing (DataFrame functions only).

Targets. Sources in code-point order, null last, get the weights in turn. Together the
sources share ``share`` times all tokens in proportion to their weights; a source's target
stops at ``cap`` times its own tokens, and the excess is shared anew by weight until no
target is above its stop.

Rates. Within a source s, document i gets the rate r_i = min(cap, exp(l_s * z_i)), z_i its
size relative to the source's mean. This is the choice closest in entropy to taking every
document once, subject to the token constraint sum(r_i * size_i) = target_s and r_i <= cap;
the multipliers l_s solve the convex dual. Newton's method finds them for all sources at
once: an iteration is one aggregation that gives each source its constraint's value and
slope, and a step that would leave the known bracket is replaced by its midpoint. A source
at its stop takes everything ``cap`` times.

Copies. floor(r_i) copies are certain. The fractions are rounded by sequential Poisson
sampling: documents come in order of (hash / fraction), and as many get one copy more as
the source's remaining tokens allow, so the total misses the target by less than one
document; a few rounds over smaller documents that still fit fill what is left. Hashes are
of id and text: reruns agree.

Scale. Texts are read once, to count tokens, into a staged table of four numbers per row.
All later work is aggregation by source with partial sums (a hot source costs no more), and
joins with per-source tables that Spark broadcasts only if they are small and otherwise
shuffles, splitting hot sources. The order of rounding uses radix selection
(``selection.py``): no sort, no window over documents.

Defined results. Null or empty text: size 0, takes 0. Null source: a source of its own,
last. Source without tokens: target 0. Repeated rows: each row is a document of its own;
rows equal in id and text are rounded alike where they tie. Empty table: empty result.
Extra columns: ignored, whatever their names.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.selection import crossing_keys
from clientele.llm.staging import Staging, beside, dropped_after, numbered_rows, row_key
from clientele.operators.ranking import global_row_number

TOKEN = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
CAP = 2.0
TOLERANCE = 1e-6
MAX_STEPS = 40
FILL_ROUNDS = 3
KEY_BITS = 48


def source_targets(sources: DataFrame, weights: Sequence[float], share: float,
                   cap: float) -> DataFrame:
    """Add weight and target to (source, tokens, ...)."""
    stage = Staging(sources.sparkSession, "targets")
    ranked = global_row_number(sources, [F.col("source").asc_nulls_last()], rank_col="place")
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    ranked = stage.put(ranked.withColumn("weight", F.element_at(
        cycle, ((F.col("place") - 1) % len(weights) + 1).cast("int"))), "weights")
    stop = F.col("tokens") * F.lit(float(cap))
    total = ranked.agg(F.sum("tokens").alias("n")).first().n or 0
    level, budget = 0.0, share * total
    while total:
        # stopped sources leave their stop; the others share what remains by weight
        stopped = stop <= F.col("weight") * F.lit(level)
        left = ranked.agg(F.sum(F.when(stopped, stop).otherwise(0.0)).alias("fixed"),
                          F.sum(F.when(stopped, 0.0).otherwise(F.col("weight"))).alias("weight")).first()
        if not left.weight:
            break
        higher = (budget - left.fixed) / left.weight
        if higher <= level * (1 + 1e-12):
            break
        level = higher
    return ranked.withColumn("target", F.least(stop, F.col("weight") * F.lit(level))).drop("place")


def _rate(cap: float):
    tilt = F.exp(F.least(F.col("multiplier") * F.col("size") / F.col("mean"), F.lit(50.0)))
    return F.when(F.col("stopped"), F.lit(cap)).otherwise(F.least(F.lit(cap), tilt))


def solve_multipliers(stage: Staging, rows: DataFrame, sources: DataFrame, cap: float) -> DataFrame:
    """Newton on the dual for all sources together; one staged table per step."""
    stopped = F.col("target") >= F.col("tokens") * F.lit(cap * (1 - 1e-12))
    state = stage.put(sources.select(
        "s", "tokens", "target", F.greatest("mean", F.lit(1.0)).alias("mean"),
        stopped.alias("stopped"), F.lit(0.0).alias("multiplier"),
        F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"),
        stopped.alias("solved")), "newton-0")
    for step in range(1, MAX_STEPS + 1):
        moving = state.where(~F.col("solved"))
        rate = _rate(cap)
        slope = F.when(rate < cap, rate * F.col("size") * F.col("size") / F.col("mean")).otherwise(0.0)
        sums = (rows.where("size > 0").join(moving, "s").groupBy("s")
                .agg(F.sum(rate * F.col("size")).alias("value"), F.sum(slope).alias("slope")))
        miss = F.col("target") - F.col("value")
        lo = F.when(miss > 0, F.col("multiplier")).otherwise(F.col("lo"))
        hi = F.when(miss < 0, F.col("multiplier")).otherwise(F.col("hi"))
        newton = F.col("multiplier") + F.try_divide(miss, F.col("slope"))
        inside = (newton > F.coalesce(F.col("new_lo"), newton - 1)) & (
            newton < F.coalesce(F.col("new_hi"), newton + 1))
        # without a bracket on one side, step out by doubling
        midpoint = (F.when(F.col("new_lo").isNull(), F.col("new_hi") * 2 - 1)
                    .when(F.col("new_hi").isNull(), F.col("new_lo") * 2 + 1)
                    .otherwise((F.col("new_lo") + F.col("new_hi")) / 2))
        solved = F.col("solved") | F.coalesce(
            F.abs(miss) <= F.lit(TOLERANCE) * F.greatest("target", F.lit(1.0)), F.lit(True))
        state = stage.put(
            state.join(sums, "s", "left").withColumn("new_lo", lo).withColumn("new_hi", hi)
            .select("s", "tokens", "target", "mean", "stopped",
                    F.when(solved, F.col("multiplier"))
                    .when(F.coalesce(inside, F.lit(False)), newton).otherwise(midpoint)
                    .alias("multiplier"),
                    F.col("new_lo").alias("lo"), F.col("new_hi").alias("hi"),
                    solved.alias("solved")), f"newton-{step}")
        if not state.where(~F.col("solved")).take(1):
            return state
    rest = state.where(~F.col("solved")).agg(F.count(F.lit(1)).alias("n"), F.min("s").alias("s")).first()
    if rest.n:
        name = sources.where(F.col("s") == rest.s).first()["source"]
        warnings.warn(f"{rest.n} sources did not meet their target within {MAX_STEPS} Newton steps, "
                      f"among them {name!r}; their last multiplier is used", stacklevel=2)
    return state


def mix_sources(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
                cap: float = CAP, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", key_col: str | None = None) -> DataFrame:
    """Per row: id, source, size, source_size, target, rate, copies, taken, row_key (the column
    ``key_col``, or a hash of id and text). Warns if a source's multiplier did not converge."""
    stage = Staging(docs.sparkSession, "mixing")
    own_key = [F.col(key_col).alias("own_key")] if key_col else []
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(
        F.col(id_col).alias("row_id"), F.col(source_col).cast("string").alias("source"),
        F.regexp_count(text, F.lit(TOKEN)).cast("long").alias("size"),
        row_key(id_col, text_col).alias("hash"), *own_key)
    base = stage.put(base, "rows")
    sizes = F.col("size").cast("double")
    sources = base.groupBy("source").agg(
        F.sum("size").alias("tokens"),
        F.coalesce(F.try_divide(F.sum(sizes * sizes), F.sum(sizes)), F.lit(1.0)).alias("mean"))
    sources = stage.put(
        source_targets(sources, weights, share, cap)
        .withColumn("s", F.monotonically_increasing_id()), "sources")
    named = sources.select("s", F.col("source").alias("name"))
    rows = stage.put(base.join(named, F.col("source").eqNullSafe(F.col("name"))).drop("name"),
                     "numbered")
    solved = solve_multipliers(stage, rows, sources, cap)

    rate = F.when(F.col("size") > 0, _rate(cap)).otherwise(F.lit(1.0))
    uniform = (F.shiftrightunsigned("hash", 11).cast("double") + 1) / float(1 << 53)
    rated = rows.join(solved.select("s", "tokens", "target", "mean", "stopped", "multiplier"), "s")
    rated = (rated.withColumn("rate", rate).withColumn("copies", F.floor("rate").cast("long"))
             .withColumn("fraction", F.col("rate") - F.col("copies")))
    order = F.least(uniform / F.greatest("fraction", F.lit(1e-12)) * float(1 << 24),
                    F.lit(float((1 << KEY_BITS) - 1))).cast("long")
    rated = stage.put(
        rated.withColumn("key", order)
        .select("s", "row_id", "source", "size", "hash", "key", "rate", "copies", "fraction",
                *(["own_key"] if key_col else [])), "rated")

    more = (F.col("fraction") > 0) & (F.col("size") > 0)
    for k in range(1 + FILL_ROUNDS):
        taken = rated.groupBy("s").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"))
        gaps = stage.put(sources.select("s", "target").join(taken, "s")
                         .select(F.col("s").alias("g"), F.lit(0).alias("target"),
                                 (F.col("target") - F.col("taken")).alias("goal")), f"gaps-{k}")
        if k:  # later rounds: any smaller document that still fits
            more = (F.col("copies") + 1 <= cap) & (F.col("size") > 0)
            allowed = rated.where(more).join(gaps.select(F.col("g").alias("s"), "goal"), "s").where(
                "size <= goal")
        else:
            allowed = rated.where(more)
        cut = crossing_keys(stage, f"round-{k}", allowed.select(
            F.col("s").alias("g"), "key", F.col("size").alias("w")), gaps, KEY_BITS)
        borders = gaps.select(F.col("g").alias("s"), "goal").join(
            cut.select(F.col("g").alias("s"), "cut"), "s", "left")
        fits = F.col("goal") > 0 if not k else F.col("size") <= F.col("goal")
        extra = more & fits & (F.col("cut").isNull() | (F.col("key") < F.col("cut")))
        rated = stage.put(
            rated.join(borders, "s").withColumn("copies", F.col("copies") + extra.cast("long"))
            .drop("goal", "cut"), f"copies-{k}")
    facts = sources.select("s", F.col("tokens").alias("source_size"), "target")
    return rated.join(facts, "s").select(
        F.col("row_id").alias(id_col), "source", "size", "source_size", "target", "rate",
        "copies", (F.col("copies") * F.col("size")).alias("taken"),
        F.col("own_key" if key_col else "hash").alias("row_key"))


def take_mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
             cap: float = CAP, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source") -> DataFrame:
    """The mix itself: every document as many times as it has copies, all columns as they are.
    Rows are told apart by a number of their own, so columns may have any name and type."""
    stage = Staging(docs.sparkSession, "take-mix")
    rows = numbered_rows(stage, docs)
    doc = F.col("doc")
    with dropped_after():  # of the balancing's tables only the numbers of copies are needed
        plan = mix_sources(
            rows.select("row", doc[id_col].alias("doc_id"), doc[text_col].alias("text"),
                        doc[source_col].alias("source")),
            weights, share, cap, key_col="row").where("copies > 0")
        plan = stage.put(plan.select(F.col("row_key").alias("row"), "copies"), "copies")
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return rows.join(beside(plan), "row").select("doc", copies.alias("copy")).select("doc.*")
