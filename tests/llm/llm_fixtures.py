"""Small tables with the awkward cases that every operator has to survive."""

import random

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# names that the operators use inside themselves
CLASHING = ("node", "key", "h", "row", "size", "g", "n", "digest", "component", "bucket", "label",
            "rate", "copies", "target", "shard", "slot", "words", "window", "kind", "score", "a", "b")


def sentence(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
                    for _ in range(n))


def awkward_rows(seed: int = 5) -> list[tuple]:
    rng = random.Random(seed)
    base = sentence(rng, 60)
    words = base.split()
    near = " ".join(words[:30] + ["changed"] + words[31:])
    far = " ".join(w if i % 3 else "other" for i, w in enumerate(words))
    texts = [base, base, base.upper(), near, far, base + "\n", "", None, " \t\n", "one two", "one  TWO",
             "alone", "alone alone alone alone", sentence(rng, 4), "é ñ ß 中文   \U0001f600 x y z",
             sentence(rng, 40_000), "a " * 500, base.replace(" ", "   ")]
    texts += [sentence(rng, rng.randint(5, 120)) for _ in range(30)]
    rows = [(i * 3, t, ("en", "de", None)[i % 3], ("s1", "s0", "S2", None)[i % 4],
             None if i % 5 == 0 else len(t or "")) for i, t in enumerate(texts)]
    rows.append(rows[0])                      # a repeated row
    rows.append((None, sentence(rng, 20), "en", "s0", 1))
    rows.append((None, None, None, None, None))
    return rows


def frame(spark, rows, clashing: bool = False):
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    if clashing:
        df = df.select("*", *(F.lit("x").alias(c) for c in CLASHING))
    return df


def with_odd_columns(df):
    """``df`` with columns of types that cannot be hashed or compared, and of names the
    operators use inside themselves."""
    return df.select(
        "*", F.create_map(F.lit("a"), F.col("doc_id")).alias("tags"),
        F.array(F.create_map(F.lit(1), F.lit(2))).alias("many"), F.lit("x").alias("_row_key"),
        F.lit("y").alias("row"), F.lit("z").alias("doc"), F.lit("c").alias("copies"),
        F.lit("o").alias("own_key"), F.lit("d").alias("dim0"), F.lit("k").alias("k"))


def shingles(text: str | None, size: int = 5) -> set:
    w = (text or "").encode().lower().split()
    if not w:
        return set()
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))}
