"""Benchmark decontamination: a prefix-filtered containment join.

Which words of a document lie inside an occurrence of a benchmark window? A window is
``window`` consecutive words of an item; an item with fewer words (but not none) is one
window by itself.

Method. Every window is a set of positioned shingles (``SHINGLE`` words, or the whole
window where it is shorter). Shingles are ordered by rarity: how often each occurs in all
documents. An occurrence of the window holds all its shingles, so the necessary prefix
has length one: the rarest shingle. Documents are joined with the windows on that token
alone; the token's place in the window then bounds the place of the occurrence
(positional bound: it must start inside the document; length bound: it must end there),
and the words of that stretch are compared with the window's.

Scale. Documents are read twice and never shuffled: the first pass counts benchmark
shingles, the second emits candidates, a few dozen words each. Both look shingles up in a
bitmap of fixed size (``FILTER_BITS`` bits, 1 MB, whatever the benchmark's size); false
hits fall out in the joins. The joins are on narrow candidates between two plain
shuffles, so Spark splits a passage that many documents share. What is grouped per
document is bounded by that document's own words.

Defined results. Null or empty text, or text without words: 0 words, 0 hits, never
contaminated. Items without words: no window. Items with equal words: each counts. Null
item ids: hit words count, the item is left out of ``items``. Repeated documents: judged
row by row, whatever their ids. Empty tables: empty result, or nothing contaminated.
Extra columns: ignored, whatever their names. Texts are used whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.bitmap import bitmap, in_bitmap
from clientele.llm.staging import Staging, beside, dropped_after, numbered_rows, row_key
from clientele.llm.words import ALPHANUMERIC, blocks, whole_shingles
from clientele.llm.workers import tidy

WINDOW = 10
SHINGLE = 4
FILTER_BITS = 1 << 23


def _item_windows(window: int):
    """item_id, window (words joined by spaces), n_words, shingles (hashes by offset)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, words in blocks(batch, "text", ALPHANUMERIC):
                ids, texts, sizes, shingles = [], [], [], []
                item_ids = part.column("item_id").to_pylist()
                by_size = {}
                for i, item in enumerate(item_ids):
                    lo, hi = int(words.first[i]), int(words.first[i + 1])
                    if lo == hi:
                        continue
                    n = min(window, hi - lo)
                    s = min(SHINGLE, n)
                    if s not in by_size:
                        at, h = whole_shingles(words, s)
                        by_size[s] = dict(zip(at.tolist(), h.view(np.int64).tolist()))
                    spelled = [words.text(w) for w in range(lo, hi)]
                    for w in range(lo, hi - n + 1):
                        ids.append(item)
                        texts.append(" ".join(spelled[w - lo:w - lo + n]))
                        sizes.append(n)
                        shingles.append([by_size[s][w + o] for o in range(n - s + 1)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(texts, pa.string()),
                     pa.array(sizes, pa.int32()), pa.array(shingles, pa.list_(pa.int64()))],
                    names=["item_id", "window", "n_words", "shingles"])
    return run


def _found(words, sizes: list[int], bits: np.ndarray):
    for size in sizes:
        at, h = whole_shingles(words, size)
        hit = in_bitmap(bits, h)
        yield size, at[hit], h[hit]


def _count_shingles(sizes: list[int], bits: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, words in blocks(batch, "text", ALPHANUMERIC):
                for _, _, h in _found(words, sizes, bits):
                    values, counts = np.unique(h, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(values.view(np.int64)), pa.array(counts.astype(np.int64))],
                        names=["h", "n"])
    return run


def _candidates(sizes: list[int], bits: np.ndarray, window: int):
    """Per document its word count and, per candidate, token, place and the words around."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, words in blocks(batch, "text", ALPHANUMERIC):
                found: list[list] = [[] for _ in range(part.num_rows)]
                for size, at, h in _found(words, sizes, bits):
                    owner = np.searchsorted(words.first, at, side="right") - 1
                    for w, token, i in zip(at.tolist(), h.view(np.int64).tolist(), owner.tolist()):
                        lo, hi = int(words.first[i]), int(words.first[i + 1])
                        a, b = max(lo, w - (window - size)), min(hi, w + window)
                        found[i].append({"h": token, "at": w - lo, "lead": w - a,
                                         "near": [words.text(k) for k in range(a, b)]})
                kind = pa.struct([("h", pa.int64()), ("at", pa.int32()), ("lead", pa.int32()),
                                  ("near", pa.list_(pa.string()))])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("key"),
                     pa.array(np.diff(words.first).astype(np.int64)),
                     pa.array(found, pa.list_(kind))], names=["doc_id", "key", "n_words", "found"])
    return run


def _covered(places):
    """Number of words covered by the (start, n) stretches, sorted by start."""
    zero = F.struct(F.lit(0).cast("long").alias("covered"), F.lit(0).alias("end"))

    def step(acc, x):
        end = x["start"] + x["n"]
        gain = F.greatest(end - F.greatest(acc["end"], x["start"]), F.lit(0))
        return F.struct((acc["covered"] + gain).alias("covered"),
                        F.greatest(acc["end"], end).alias("end"))
    return F.aggregate(F.array_sort(places), zero, step, lambda acc: acc["covered"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text",
                  key_col: str | None = None) -> DataFrame:
    """Per document: id, n_words, n_hit, items (sorted array of item ids as strings), row_key (the
    long column ``key_col``, or a hash of id and text)."""
    stage = Staging(docs.sparkSession, "decontaminate")
    items = benchmark.select(F.col(item_id_col).cast("long").alias("item_id"),
                             F.coalesce(F.col(item_text_col), F.lit("")).alias("text"))
    key = F.col(key_col) if key_col else row_key(id_col, text_col)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), key.alias("key"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    owned = stage.put(items.mapInArrow(
        tidy(_item_windows(window)),
        "item_id long, window string, n_words int, shingles array<long>"), "windows")
    windows = owned.groupBy("window").agg(F.first("n_words").alias("n_words"),
                                          F.first("shingles").alias("shingles"))
    shingles = windows.select("window", "n_words", F.posexplode("shingles").alias("place", "h"))
    sizes = sorted({min(SHINGLE, r.n_words) for r in
                    owned.groupBy("n_words").agg(F.count(F.lit(1))).collect()})

    counts = (texts.mapInArrow(tidy(_count_shingles(sizes, bitmap(shingles.select("h"), FILTER_BITS))),
                               "h long, n long").groupBy("h").agg(F.sum("n").alias("n")))
    rarity = F.struct(F.coalesce("n", F.lit(0)), "h", "place")
    prefix = stage.put(
        shingles.join(counts, "h", "left").groupBy("window", "n_words")
        .agg(F.min(rarity).alias("rarest"))
        .select("window", "n_words", "rarest.h", "rarest.place"), "prefix")

    rows = texts.mapInArrow(
        tidy(_candidates(sizes, bitmap(prefix.select("h"), FILTER_BITS), window)),
        "doc_id long, key long, n_words long, found array<struct<h:long,at:int,lead:int,near:array<string>>>")
    rows = stage.put(rows.withColumn("row", F.monotonically_increasing_id()), "candidates")

    tokens = (rows.where(F.size("found") > 0).select("row", F.explode("found").alias("c"))
              .select("row", "c.h", "c.at", "c.lead", "c.near"))
    # positional bound: the window starts inside the document; length bound: it ends there
    lead = F.col("lead") - F.col("place")
    fits = (lead >= 0) & (lead + F.col("n_words") <= F.size("near"))
    same = F.array_join(F.slice("near", F.greatest(lead, F.lit(0)) + 1, F.col("n_words")), " ") == F.col("window")
    hits = stage.put(
        tokens.join(prefix, "h").where(fits).where(same)
        .select("row", "window", (F.col("at") - F.col("place")).alias("start"),
                F.col("n_words").alias("n")), "hits")

    covered = hits.groupBy("row").agg(
        _covered(F.collect_set(F.struct("start", "n"))).alias("n_hit"))
    named = (hits.select("row", "window").distinct()
             .join(owned.select("window", "item_id").distinct(), "window")
             .groupBy("row").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string")))
                                 .alias("items")))
    # staged, so that the join below is between narrow tables of known size
    judged = stage.put(covered.join(named, "row", "left"), "judged")
    return rows.select("row", "doc_id", "key", "n_words").join(judged, "row", "left").select(
        F.col("doc_id").alias(id_col), "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("key").alias("row_key"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns as they are, without any benchmark window. Rows are told
    apart by a number of their own, so columns may have any name and type."""
    stage = Staging(docs.sparkSession, "drop-contaminated")
    rows = numbered_rows(stage, docs)
    doc = F.col("doc")
    with dropped_after():  # of the search's tables only the rows that are hit are needed
        found = decontaminate(rows.select("row", doc[id_col].alias("doc_id"), doc[text_col].alias("text")),
                              benchmark, window, key_col="row")
        hit = stage.put(found.where("n_hit > 0").select(F.col("row_key").alias("row")), "hit")
    return rows.join(beside(hit), "row", "left_anti").select("doc.*")
