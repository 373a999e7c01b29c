"""Near-duplicate documents: fast similarity sketching, banding, exact verification.

Two documents are linked when their sets of distinct five-word shingles have a Jaccard
similarity of at least 75 %; groups are the connected components of the links.

Sketch. ``BANDS * ROWS`` coordinates (t) are filled in rounds. In each of the first t rounds
every shingle is hashed to one coordinate and a value; round t + k puts every shingle into
coordinate k, so that after 2t rounds every coordinate is filled, however small the set.
Values are ordered by round first; a coordinate keeps its smallest. A set stops after the
round that fills its last coordinate, a few rounds for common sizes, so a sketch costs
about |set| + t log t steps instead of |set| * t. Two sketches agree in a coordinate with
the probability of their similarity, with the concentration of independent minima.

Banding. Documents that agree in all ``ROWS`` coordinates of one of ``BANDS`` bands share a
bucket. At the threshold a pair shares none with probability (1 - 0.75^5)^50, about 1e-6.

Verification is exact, on the full sets, and loses no link between bucket mates:
1. equal sets are one class (128-bit digest of the set); the rest works on classes;
2. in every bucket each class is compared with the bucket's centre, its smallest set;
3. in buckets that still hold several components, every class is compared with those of
   other components if the bucket is small, and with a second centre otherwise;
4. classes of large buckets that still hold several components go through an exact
   prefix-filtered join: shingles ordered by rarity, the necessary prefix of each set joined,
   length and positional bounds applied, pairs inside one component left out.
So a group of thousands of near copies costs a few comparisons per document, not all pairs,
and documents that merely share a passage meet only if their rarest shingles do.

Scale. Texts are read once for sketches and once more for the classes that share a bucket;
of the others, a bitmap of fixed size leaves out all but a few before that shuffle. Bands are 50 narrow rows per class. Every join is between staged tables or
plain shuffles, so hot buckets, centres and classes can be split by Spark.

Defined results. A text with fewer than five words is one shingle; without words (or null),
the set is empty and linked with nothing. Repeated rows are one class. Null ids: such a row
is grouped like any other; a group's id is the smallest id that is not null (null if there is
none). Empty table: empty result. Extra columns: ignored. Texts are used whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.bitmap import bitmap, in_bitmap
from clientele.llm.components import connected_components
from clientele.llm.staging import Staging, beside, dropped_after, numbered_rows, row_key
from clientele.llm.words import NOT_SPACE, Words, blocks, mix, shingle_hashes
from clientele.llm.workers import tidy

SHINGLE = 5
ROWS, BANDS = 5, 50
THRESHOLD = 75  # per cent
SMALL_BUCKET = 16
BLOCK = 1 << 19
FILTER_BITS = 1 << 26  # 8 MB

_SEEDS = np.random.default_rng(577215664).integers(0, 1 << 63, 4 * ROWS * BANDS, dtype=np.uint64)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_sets(words: Words, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes per text."""
    h = shingle_hashes(words.hashes, size)
    out = []
    for lo, hi in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if hi - lo >= size:
            out.append(np.unique(h[lo:hi - size + 1]))
        elif hi > lo:
            out.append(shingle_hashes(words.hashes[lo:hi], hi - lo))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def sketches(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """One row of ``coordinates`` values per set; sets must not be empty."""
    n, t = len(sets), coordinates
    values = np.full(n * t, _EMPTY)
    elements = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(n, dtype=np.int64), [len(s) for s in sets])
    begin, several = 0, 1
    while len(elements) and begin < 2 * t:
        rounds = np.arange(begin, min(begin + several, 2 * t))
        for r in np.array_split(rounds, -(-len(rounds) * len(elements) // (1 << 20))):
            h = mix(elements[None, :] + _SEEDS[r][:, None])
            place = ((h >> np.uint64(32)) * np.uint64(t) >> np.uint64(32)).astype(np.int64)
            late = r >= t
            place[late] = (r[late] - t)[:, None]
            value = (r.astype(np.uint64) << np.uint64(32))[:, None] | (h & np.uint64(0xFFFFFFFF))
            np.minimum.at(values, (owner[None, :] * t + place).ravel(), value.ravel())
        begin += several
        if begin >= 4:  # later rounds concern few and small sets: take more at once
            several *= 2
        open_sets = (values.reshape(n, t) == _EMPTY).any(axis=1)
        going = open_sets[owner]
        elements, owner = elements[going], owner[going]
    return values.reshape(n, t)


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    key = np.broadcast_to(mix(np.arange(bands, dtype=np.uint64) + np.uint64(1))[None, :],
                          (len(sketch), bands)).copy()
    parts = sketch.reshape(len(sketch), bands, rows)
    for r in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r])
    return key


def set_digest(s: np.ndarray) -> tuple[int, int]:
    """128 bits that depend on the set alone (its members are sorted)."""
    a = mix(s + np.uint64(0x243F6A8885A308D3)).sum(dtype=np.uint64)
    b = mix(s * np.uint64(0x13198A2E03707345) + np.uint64(len(s))).sum(dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))


SKETCHED = "n_shingles long, d1 long, d2 long, bands array<long>"


def _sketch_rows(bands: int, rows: int, carried: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, words in blocks(batch, "text", NOT_SPACE, BLOCK):
                sets = shingle_sets(words)
                full = [i for i, s in enumerate(sets) if len(s)]
                keys = band_keys(sketches([sets[i] for i in full], bands * rows), bands, rows)
                lists: list = [None] * len(sets)
                for i, row in zip(full, keys.view(np.int64)):
                    lists[i] = row
                digests = [set_digest(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in carried),
                     pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([d[0] for d in digests], pa.int64()),
                     pa.array([d[1] for d in digests], pa.int64()),
                     pa.array(lists, pa.list_(pa.int64()))],
                    names=[*carried, "n_shingles", "d1", "d2", "bands"])
    return run


def _own_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep the texts whose shingle set is the one of their class."""
    for batch in batches:
        for part, words in blocks(batch, "text", NOT_SPACE):
            wanted = zip(part.column("d1").to_pylist(), part.column("d2").to_pylist())
            same = [set_digest(s) == w for s, w in zip(shingle_sets(words), wanted)]
            yield part.select(["node", "text"]).filter(pa.array(same, pa.bool_()))


def _similar(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                known: dict[int, np.ndarray] = {}
                for side in ("a", "b"):
                    nodes = part.column(side).to_pylist()
                    fresh = [i for i, x in enumerate(nodes) if x not in known]
                    fresh = list({nodes[i]: i for i in fresh}.values())
                    texts = pa.RecordBatch.from_arrays(
                        [pa.array(fresh), part.column(f"text_{side}").take(pa.array(fresh, pa.int64()))],
                        names=["i", "text"])
                    for block, words in blocks(texts, "text", NOT_SPACE):
                        known.update(zip((nodes[i] for i in block.column("i").to_pylist()),
                                         shingle_sets(words)))
                linked = []
                for a, b in zip(part.column("a").to_pylist(), part.column("b").to_pylist()):
                    x, y = known[a], known[b]
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    linked.append(100 * shared >= threshold * (len(x) + len(y) - shared))
                yield part.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))
    return run


class Verifier:
    """Checks candidate pairs of classes on their full sets; remembers what was checked."""

    def __init__(self, stage: Staging, texts: DataFrame, threshold: int):
        self.stage, self.texts, self.threshold = stage, texts, threshold
        self.checked: DataFrame | None = None

    def check(self, pairs: DataFrame, name: str) -> DataFrame:
        """``pairs``: a, b (any order). The similar ones among those not checked before."""
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if self.checked is not None:
            pairs = pairs.join(self.checked, ["a", "b"], "left_anti")
        pairs = self.stage.put(pairs, f"pairs-{name}")
        left = self.texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
        right = self.texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
        similar = pairs.join(left, "b").join(right, "a").mapInArrow(
            tidy(_similar(self.threshold)), "a long, b long")
        similar = self.stage.put(similar, f"links-{name}")
        self.checked = pairs if self.checked is None else self.checked.union(pairs)
        return similar


def _fits(threshold: int, x: str, y: str):
    """Length bound: the smaller set is at least ``threshold`` per cent of the larger."""
    return F.least(x, y) * 100 >= F.greatest(x, y) * threshold


def _with_components(members: DataFrame, components: DataFrame) -> DataFrame:
    return members.join(components, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))


def _prefix_pairs(stage: Staging, texts: DataFrame, nodes: DataFrame, threshold: int) -> DataFrame:
    """Pairs of different components among ``nodes`` (node, component) that can be similar:
    an exact prefix-filtered join."""
    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, words in blocks(batch, "text", NOT_SPACE, BLOCK):
                sets = shingle_sets(words)
                owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
                flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                sizes = np.array([len(s) for s in sets], dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("node").take(pa.array(owner)), part.column("component").take(pa.array(owner)),
                     pa.array(sizes[owner]), pa.array(flat.view(np.int64))],
                    names=["node", "component", "n", "h"])

    rows = stage.put(texts.join(nodes, "node").mapInArrow(
        tidy(tokens), "node long, component long, n long, h long"), "tokens")
    counts = stage.put(rows.groupBy("h").agg(F.count(F.lit(1)).alias("df"),
                                             F.min("component").alias("c1"),
                                             F.max("component").alias("c2")), "token-counts")
    # per document: its own shingles in order of rarity, cut to the necessary prefix
    prefix = (rows.join(counts, "h").groupBy("node", "component", "n")
              .agg(F.array_sort(F.collect_list(F.struct("df", "h", (F.col("c1") != F.col("c2"))
                                                        .alias("mixed")))).alias("order"))
              .withColumn("order", F.slice("order", 1, (F.col("n") - F.ceil(F.col("n") * threshold / 100) + 1)
                                           .cast("int")))
              .select("node", "component", "n", F.posexplode("order").alias("place", "token"))
              .where("token.mixed").select("node", "component", "n", "place", "token.h"))
    prefix = stage.put(prefix, "prefix")
    # pairs inside a token's largest component are not needed: all others are joined with all
    shares = prefix.groupBy("h", "component").agg(F.count(F.lit(1)).alias("k"))
    largest = stage.put(shares.groupBy("h").agg(F.max_by("component", F.struct("k", "component"))
                                                .alias("main"), F.count(F.lit(1)).alias("several"))
                        .where("several > 1"), "largest")
    marked = stage.put(prefix.join(largest.select("h", "main"), "h"), "marked")
    x = marked.where("component <> main").select("h", *(F.col(c).alias(f"x_{c}") for c in
                                                        ("node", "component", "n", "place")))
    # with t the threshold, similar sets share at least t / (1 + t) of their total size
    most = F.least(F.col("x_n") - F.col("x_place"), F.col("n") - F.col("place"))
    return x.join(marked, "h").where(
        (F.col("x_component") != F.col("component"))
        & ((F.col("component") == F.col("main")) | (F.col("x_node") < F.col("node")))
        & _fits(threshold, "x_n", "n")
        & (most * (100 + threshold) >= (F.col("x_n") + F.col("n")) * threshold)
    ).select(F.col("x_node").alias("a"), F.col("node").alias("b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: int = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per row: id, n_shingles, component_id, kept (the row's id is its group's), row_key."""
    return _grouped_rows(docs, id_col, text_col, threshold, bands, rows).drop("_component")


def _grouped_rows(docs: DataFrame, id_col: str, text_col: str, threshold: int, bands: int = BANDS,
                  rows: int = ROWS, row_col: str | None = None) -> DataFrame:
    """As near_duplicates, with _component: the group itself, whatever its ids (null for
    texts without words), and the long column ``row_col``, if given, as it is."""
    stage = Staging(docs.sparkSession, "near-duplicates")
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        row_key(id_col, text_col).alias("key"), text.alias("text"),
                        *([row_col] if row_col else []))
    carried = [c for c in found.columns if c != "text"]
    sketched = stage.put(found.mapInArrow(
        tidy(_sketch_rows(bands, rows, carried)),
        "".join(f"{c} long, " for c in carried) + SKETCHED), "sketches")
    classes = stage.put(
        sketched.where("n_shingles > 0").groupBy("d1", "d2")
        .agg(F.min("doc_id").alias("first_id"), F.min("key").alias("key"),
             F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id()), "classes")

    banded = classes.select("node", "n", F.explode("bands").alias("bucket"))
    buckets = stage.put(
        banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"),
                                     F.min(F.struct("n", "node")).alias("centre"))
        .where("size > 1").select("bucket", "size", F.col("centre.node").alias("centre"),
                                  F.col("centre.n").alias("centre_n")), "buckets")
    members = stage.put(banded.join(buckets, "bucket"), "members")

    needed = stage.put(members.select("node").distinct().join(
        classes.select("node", "key", "d1", "d2"), "node"), "needed")
    # few texts share a bucket: most others are left out before the shuffle
    maybe = docs.sparkSession.sparkContext.broadcast(
        bitmap(needed.select(F.col("key").alias("h")), FILTER_BITS))

    @F.arrow_udf("boolean")
    def may_be_needed(key: pa.Array) -> pa.Array:
        return pa.array(in_bitmap(maybe.value, key.to_numpy(zero_copy_only=False)))
    texts = stage.put(found.select("key", "text").where(may_be_needed("key")).join(needed, "key")
                      .select("node", "d1", "d2", "text")
                      .mapInArrow(tidy(_own_text), "node long, text string"), "texts")
    maybe.destroy()  # the driver and all executors would hold it until garbage collection

    verifier = Verifier(stage, texts, threshold)
    links = verifier.check(
        members.where((F.col("node") != F.col("centre")) & _fits(threshold, "n", "centre_n"))
        .select(F.col("centre").alias("a"), F.col("node").alias("b")), "centre")

    # buckets that still hold several components
    components = connected_components(stage, "first", links)
    members = stage.put(_with_components(members, components), "members-1")
    mixed = stage.put(
        members.groupBy("bucket").agg(
            F.min("component").alias("c1"), F.max("component").alias("c2"),
            F.min(F.struct(F.xxhash64("node"), "node", "n", "component")).alias("second"))
        .where("c1 <> c2").select("bucket", F.col("second.node").alias("second"),
                                  F.col("second.n").alias("second_n"),
                                  F.col("second.component").alias("second_component")), "mixed")
    members = stage.put(members.join(mixed, "bucket"), "members-2")
    small = members.where(F.col("size") <= SMALL_BUCKET)
    others = small.select("bucket", F.col("node").alias("b"), F.col("n").alias("b_n"),
                          F.col("component").alias("b_component"))
    inside = small.join(others, "bucket").where(
        (F.col("node") < F.col("b")) & (F.col("component") != F.col("b_component"))
        & _fits(threshold, "n", "b_n")).select(F.col("node").alias("a"), "b")
    large = members.where(F.col("size") > SMALL_BUCKET)
    star = large.where((F.col("component") != F.col("second_component"))
                       & _fits(threshold, "n", "second_n")).select(
        F.col("second").alias("a"), F.col("node").alias("b"))
    links = verifier.check(inside.union(star), "second")

    # large buckets that still do: exact, by prefixes
    components = connected_components(stage, "second", links, components)
    rest = _with_components(large.select("bucket", "node"), components)
    rest = stage.put(rest, "rest")
    open_buckets = rest.groupBy("bucket").agg(F.min("component").alias("c1"),
                                              F.max("component").alias("c2")).where("c1 <> c2")
    nodes = stage.put(rest.join(open_buckets.select("bucket"), "bucket")
                      .select("node", "component").distinct(), "open-nodes")
    if nodes.take(1):
        links = verifier.check(_prefix_pairs(stage, texts, nodes, threshold), "prefix")
        components = connected_components(stage, "third", links, components)

    grouped = stage.put(_with_components(classes.select("node", "d1", "d2", "first_id"), components),
                        "grouped")
    firsts = grouped.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = stage.put(grouped.join(firsts, "component").select(
        "d1", "d2", F.col("component").alias("_component"), "component_id"), "named")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return (sketched.select(*carried, "n_shingles", "d1", "d2").join(named, ["d1", "d2"], "left")
            .select(F.col("doc_id").alias(id_col), "n_shingles", own.alias("component_id"),
                    F.col("doc_id").eqNullSafe(own).alias("kept"), F.col("key").alias("row_key"),
                    "_component", *([row_col] if row_col else [])))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               threshold: int = THRESHOLD) -> DataFrame:
    """The documents without their near-duplicates: of every group the row with the
    smallest id stays, with all its columns. Texts without words are duplicates of nothing, not
    even of each other: every such row stays, with or without id. Rows are told apart by a
    number of their own, so columns may have any name and type."""
    stage = Staging(docs.sparkSession, "keep-first")
    rows = numbered_rows(stage, docs)
    doc = F.col("doc")
    alone = F.when(F.col("n_shingles") == 0, F.col("row"))
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("id"), "row_key", "row"))
    with dropped_after():  # of the grouping's tables only the rows that stay are needed
        found = _grouped_rows(rows.select("row", doc[id_col].alias("doc_id"), doc[text_col].alias("text")),
                              "doc_id", "text", threshold, row_col="row")
        # by the group itself: its smallest id may be null or also occur in another group
        chosen = stage.put(found.groupBy("_component", alone.alias("alone")).agg(first.alias("first"))
                           .select("first.row"), "chosen")
    return rows.join(beside(chosen), "row", "left_semi").select("doc.*")
