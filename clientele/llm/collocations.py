"""Phrase collocations by multikey quicksort of suffix pointers.

Texts are lower-cased (A-Z) and split at ``[.,;:!?\\x0A-\\x0D]`` into pieces, pieces at space
and tab into words. Within a language (null: ``und``), a phrase of 2 to ``MAX_WORDS`` words
is a candidate if it occurs ``least`` times or more; overlapping occurrences count. Cutting
it after its first k words gives l = f(first part), r = f(rest) and the score
floor(1000 * a * n / (l * r)), n being the number of words of the language; its lowest
cut counts. A candidate whose words lie inside a longer candidate that is as frequent is
dropped; of the others, the best ``top`` of each language are ranked.

Counting. A suffix pointer is a word position; its key is the words from there to the end
of the piece or to the first infrequent pair of words, ``MAX_WORDS`` at most.
1. Words are counted exactly. A bitmap of fixed size holds the hashes of those that occur
   ``least`` times. In a key a word is its 64-bit hash (language included); a check over all
   words makes sure that no frequent word shares its hash with any other word, else another
   hash function is taken, so keys stand for words exactly.
2. Neighbouring frequent words are counted as pairs, by a hash: 4 bytes within one of the
   ranges that its leading bits name. A bitmap holds the hashes that add up to ``least``.
   All pairs of a phrase occur as often as the phrase or more, so a key may end where a pair is
   missing there, and pointers that do not begin with a pair are left out; pairs that share a
   hash only let more pass. Equal keys of a block are added up there.
3. Keys are routed by their leading words: the key order is cut into ranges of about
   ``ROUTE_KEYS`` keys, at keys of a sample. The cuts are whole keys, so a word or pair that
   leads a third of all keys takes as many ranges as its keys need. A block sends its keys of one
   range as one packed row.
4. In a range, multikey three-way quicksort splits the pointers by the word at the current
   depth into less, equal and greater; the weight of an equal part is the count of a
   phrase, and the part goes on one word deeper. Parts that weigh less than ``least`` are
   abandoned, unless they hold the first or last key of the range, where the neighbour may hold
   the rest; what is found is added up by phrase.

Scale. Four reads of the texts, one of them only of the sample. What is shuffled, one after the
other, is the distinct words, about 5 bytes for each distinct pair of a block, and about 20
compressed bytes for each distinct key of a block; of the last two nothing is staged but the
frequent ones, and a range is all that a task holds at a time. The sample, 32 keys a range, only
balances the ranges. The cuts are broadcast: 40 bytes for every ``ROUTE_KEYS`` keys, a few MB
for a TB of text. When words or pairs outgrow their bitmap more keys pass, and their
counts decide. Scores are joins on (language, phrase) between candidates, arithmetic is in decimals
of 38 digits. The best of a language are picked per (language, salt) first, so a language with
all rows is no hot key.

Defined results. Null text: no words. Null language: ``und``, together with rows that say so.
Repeated rows count each. Empty table: empty result. Extra columns: ignored. Texts are used
whole, however long. Equal scores: higher a, then the phrase in byte order.
"""

from __future__ import annotations

from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientele.llm.bitmap import bitmap, in_bitmap
from clientele.llm.staging import Staging
from clientele.llm.words import mix
from clientele.llm.workers import tidy
from clientele.operators.ranking import global_row_number

MAX_WORDS = 5
LEAST = 100
TOP = 2000
UNKNOWN_LANGUAGE = "und"
BLOCK_BYTES = 4 << 20
WORD_BITS = 1 << 26  # 8 MB
PAIR_BITS = 1 << 27  # 16 MB
PAIR_ROUTE = 2_000_000  # pairs of a range, repeated ones included
ROUTE_KEYS = 500_000
SAMPLED_KEYS = 32  # for every route
SAMPLED_TEXTS = 8  # the sample comes from one text in so many
MOST_TASKS = 20_000  # beyond that, tasks take several routes, one after the other
SALTS = 32
_END = 0  # no word; the hash of none of the frequent words
_LOCAL_BITS = 21  # words of a block, numbered

# every piece separator becomes a line feed, both word separators a space
_SEPARATORS = bytes.maketrans(b".,;:!?\x0a\x0b\x0c\x0d\t", b"\n" * 10 + b" ")
_ONLY_WORDS = bytes.maketrans(b".,;:!?\x0a\x0b\x0c\x0d\t", b" " * 11)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """(language, lower-cased texts) in blocks of about ``BLOCK_BYTES``."""
    waiting: dict[str, list[bytes]] = defaultdict(list)
    size: dict[str, int] = defaultdict(int)
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            raw = text.as_buffer().to_pybytes().lower()  # bytes: A-Z only
            if size[lang] and size[lang] + len(raw) > BLOCK_BYTES:
                yield lang, waiting.pop(lang)
                size[lang] = 0
            waiting[lang].append(raw)
            size[lang] += len(raw)
    yield from waiting.items()


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for lang, texts in _texts(batches):
        counts: Counter = Counter()
        for raw in texts:
            counts.update(_split(raw.translate(_ONLY_WORDS)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(counts), pa.string()),
             pa.array([w.decode("utf-8") for w in counts], pa.string()),
             pa.array(list(counts.values()), pa.int64())], names=["lang", "phrase", "f"])


def _split(piece: bytes) -> list[bytes]:
    """Words of a piece without tabs and line ends."""
    return [w for w in piece.split(b" ") if w]


def word_hashes(lang: str, words: list[bytes], seed: int) -> np.ndarray:
    """Spark's ``xxhash64(number, lang, word)``, whose number hashes to ``seed``."""
    seed = xxhash.xxh64_intdigest(lang.encode("utf-8"), seed)
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words], dtype=np.uint64)


def _numbered(lang: str, texts: list[bytes], frequent: np.ndarray, seed: int, depth: int
              ) -> tuple[np.ndarray, np.ndarray]:
    """The words of a block as numbers in the order of their hashes, 0 for infrequent ones and
    between pieces, and the hash of every number."""
    given: defaultdict[bytes, int] = defaultdict()
    given.default_factory = given.__len__
    numbers = array("i")
    for raw in texts:
        for piece in raw.translate(_SEPARATORS).split(b"\n"):
            words = _split(piece)
            if len(words) > 1:
                numbers.extend(map(given.__getitem__, words))
                numbers.append(-1)
    hashes = word_hashes(lang, list(given), seed)
    known = in_bitmap(frequent, hashes)
    # frequent words are numbered from 1 in the order of their hashes, others and gaps are 0
    rank = np.zeros(len(hashes) + 1, dtype=np.int64)
    order = np.flatnonzero(known)[np.argsort(hashes[known])]
    rank[order] = np.arange(1, len(order) + 1)
    at = np.zeros(len(numbers) + depth, dtype=np.int64)
    at[:len(numbers)] = rank[np.frombuffer(numbers, dtype=np.int32)]  # -1 is the last rank: 0
    return at, np.append(np.uint64(_END), hashes[order])


def _pair_codes(at: np.ndarray, hash_of: np.ndarray, places: np.ndarray, range_bits: int) -> np.ndarray:
    """Hashes of ``range_bits`` + 32 bits of the pairs that begin at ``places``."""
    first, second = hash_of[at[places]], hash_of[at[places + 1]]
    return mix(first * np.uint64(3) + mix(second)) >> np.uint64(32 - range_bits)


def _pair_places(at: np.ndarray) -> np.ndarray:
    return np.flatnonzero((at[:-1] > 0) & (at[1:] > 0))


def block_keys(lang: str, texts: list[bytes], frequent: np.ndarray, seed: int, depth: int,
               pairs: tuple[np.ndarray, int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of a block, one per row in their order, and their weights. ``pairs``: the
    bitmap of the frequent pairs and the bits that name a range; without it all pairs pass."""
    at, hash_of = _numbered(lang, texts, frequent, seed, depth)
    places = _pair_places(at)
    if pairs is not None:
        places = places[in_bitmap(pairs[0], _pair_codes(at, hash_of, places, pairs[1]))]
    begins = np.zeros(len(at), dtype=bool)
    begins[places] = True
    columns = [at[places], at[places + 1]]
    going = np.ones(len(places), dtype=bool)
    for d in range(2, depth):
        going &= begins[places + d - 1]
        columns.append(np.where(going, at[places + d], 0))
    if len(hash_of) <= 1 << _LOCAL_BITS:  # three numbers in a long
        packed = []
        for lo in range(0, depth, 3):
            part = np.zeros(len(places), dtype=np.int64)
            for c in columns[lo:lo + 3]:
                part = part << _LOCAL_BITS | c
            packed.append(part)
    else:
        packed = columns
    sequence = np.lexsort(packed[::-1])
    fresh = np.ones(len(places), dtype=bool)
    fresh[1:] = np.any([p[sequence[1:]] != p[sequence[:-1]] for p in packed], axis=0)
    first = np.flatnonzero(fresh)
    keys = np.stack([hash_of[c[sequence[first]]] for c in columns], axis=1)
    return keys, np.diff(np.append(first, len(places)))


PACKED_PAIRS = "route long, codes binary, counts binary"


def packed_pairs(frequent, seed: int, range_bits: int):
    """The distinct pairs of a block, one row for every range that they fall into."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in _texts(batches):
            at, hash_of = _numbered(lang, texts, frequent.value, seed, 2)
            codes, counts = np.unique(_pair_codes(at, hash_of, _pair_places(at), range_bits), return_counts=True)
            routes, first = np.unique(codes >> np.uint64(32), return_index=True)
            slices = [slice(*x) for x in zip(first, [*first[1:], len(codes)])]
            low, counts = codes.astype(np.uint32), counts.astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(routes.astype(np.int64)), pa.array([low[x].tobytes() for x in slices], pa.binary()),
                 pa.array([counts[x].tobytes() for x in slices], pa.binary())], names=["route", "codes", "counts"])
    return run


def count_pairs(least: int):
    """Hash and count of the pairs of a range that add up to ``least``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for route, parts in _routes(batches, "codes", "counts"):
            codes = np.concatenate([np.frombuffer(c, dtype=np.uint32) for c, _ in parts])
            counts = np.concatenate([np.frombuffer(n, dtype=np.int32) for _, n in parts])
            order = np.argsort(codes)
            codes = codes[order]
            first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
            sums = np.add.reduceat(counts[order].astype(np.int64), first)
            kept = sums >= least
            yield pa.RecordBatch.from_arrays(
                [pa.array(codes[first[kept]].astype(np.int64) | route << 32), pa.array(sums[kept])], names=["h", "f"])
    return run


def in_order(keys: np.ndarray) -> np.ndarray:
    """Keys as byte strings that compare as the keys do."""
    return np.ascontiguousarray(keys.astype(">u8")).view(f"S{8 * keys.shape[1]}").ravel()


def _given(pairs) -> tuple[np.ndarray, int]:
    return pairs[0].value, pairs[1]


def sample_keys(frequent, pairs, seed: int, depth: int, one_in: int):
    """Every ``one_in``-th key or so, by its hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in _texts(batches):
            keys, _ = block_keys(lang, texts, frequent.value, seed, depth, _given(pairs))
            mixed = mix((keys * (np.arange(depth, dtype=np.uint64) * np.uint64(2) + np.uint64(1))).sum(axis=1))
            keys = keys[mixed % np.uint64(one_in) == 0]
            yield pa.RecordBatch.from_arrays([pa.array(in_order(keys).tolist(), pa.binary())], names=["key"])
    return run


PACKED = "route long, words binary, keys binary, weights binary"


def _coded(keys: np.ndarray) -> tuple[bytes, bytes]:
    """The distinct words of some keys, and the keys as places among them, column by column
    (neighbours are alike there, and compress well). The places are short where 2 bytes do."""
    words, places = np.unique(keys, return_inverse=True)
    size = np.uint16 if len(words) < 1 << 16 else np.uint32
    return words.tobytes(), places.reshape(keys.shape).T.astype(size).tobytes()


def _decoded(words: bytes, places: bytes, depth: int) -> np.ndarray:
    distinct = np.frombuffer(words, dtype=np.uint64)
    size = np.uint16 if len(distinct) < 1 << 16 else np.uint32
    return distinct[np.frombuffer(places, dtype=size).reshape(depth, -1).T]


def packed_keys(frequent, pairs, cuts, seed: int, depth: int):
    """The distinct keys of a block, one row for every route that they fall into."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in _texts(batches):
            keys, weights = block_keys(lang, texts, frequent.value, seed, depth, _given(pairs))
            if not len(keys):
                continue
            borders = np.concatenate([[0], np.searchsorted(in_order(keys), cuts.value), [len(keys)]])
            routes = np.flatnonzero(np.diff(borders))
            slices = [slice(borders[r], borders[r + 1]) for r in routes]
            coded = [_coded(keys[s]) for s in slices]
            yield pa.RecordBatch.from_arrays(
                [pa.array(routes, pa.int64()), pa.array([c[0] for c in coded], pa.binary()),
                 pa.array([c[1] for c in coded], pa.binary()),
                 pa.array([weights[s].astype(np.int32).tobytes() for s in slices], pa.binary())],
                names=["route", "words", "keys", "weights"])
    return run


def quicksort_counts(keys: np.ndarray, weights: np.ndarray, least: int,
                     open_keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Multikey three-way quicksort of pointers to rows of ``keys`` (words as numbers, 0 behind
    the end): (a row, words, weight) of every prefix of two words or more whose rows weigh
    ``least`` or include one of the rows ``open_keys``.
    """
    depth = keys.shape[1]
    is_open = np.zeros(len(keys), dtype=bool)
    is_open[open_keys] = True
    stack = [(np.arange(len(keys)), 0)]
    while stack:
        rows, d = stack.pop()
        if not len(rows) or (weights[rows].sum() < least and not is_open[rows].any()):
            continue  # abandoned
        word = keys[rows, d]
        pivot = np.sort(word[[0, len(word) // 2, -1]])[1]
        stack.append((rows[word < pivot], d))
        stack.append((rows[word > pivot], d))
        equal = rows[word == pivot]
        if pivot == _END:
            continue
        weight = int(weights[equal].sum())
        if weight < least and not is_open[equal].any():
            continue
        if d > 0:
            yield int(equal[0]), d + 1, weight
        if d + 1 < depth:
            stack.append((equal, d + 1))


def _end_of(keys: np.ndarray, least_or_most) -> int:
    """A row with the first or last of the keys."""
    rows = np.arange(len(keys))
    for d in range(keys.shape[1]):
        word = keys[rows, d]
        rows = rows[word == least_or_most(word)]
    return int(rows[0])


def _routes(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple[int, list[tuple]]]:
    """One route after the other with the columns ``names`` of its rows; rows come sorted by route."""
    route, parts = None, []
    for batch in batches:
        for r, *part in zip(*(batch.column(c).to_pylist() for c in ("route", *names))):
            if r != route and parts:
                yield route, parts
                parts = []
            route = r
            parts.append(tuple(part))
    if parts:
        yield route, parts


def _by_route(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys and weights of one route after the other."""
    for _, parts in _routes(batches, "words", "keys", "weights"):
        yield (np.concatenate([_decoded(d, k, depth) for d, k, _ in parts]),
               np.concatenate([np.frombuffer(w, dtype=np.int32) for _, _, w in parts]).astype(np.int64))


def count_phrases(least: int, depth: int):
    """Counts of the phrases of the routes; those of a route's first and last key may be partial."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, weights in _by_route(batches, depth):
            found = list(quicksort_counts(keys, weights, least, np.array([_end_of(keys, np.min), _end_of(keys, np.max)])))
            yield pa.RecordBatch.from_arrays(
                [pa.array([keys[i, :n].view(np.int64).tolist() for i, n, _ in found], pa.list_(pa.int64())),
                 pa.array([w for _, _, w in found], pa.int64())], names=["key", "a"])
    return run


def _hash_function(words: DataFrame, least: int) -> int:
    """A number for which ``xxhash64(number, lang, word)`` tells every frequent word from all others."""
    number = 0
    while True:
        hashed = words.select(F.xxhash64(F.lit(number), "lang", "phrase").alias("h"), "f")
        shared = (hashed.groupBy("h").agg(F.count(F.lit(1)).alias("words"), F.max("f").alias("f"))
                  .where((F.col("f") >= least) & ((F.col("words") > 1) | (F.col("h") == _END))))
        if not shared.take(1):
            return number
        number += 1


def frequent_phrases(stage: Staging, rows: DataFrame, least: int = LEAST, max_words: int = MAX_WORDS
                     ) -> tuple[DataFrame, DataFrame]:
    """Words (lang, phrase, f), all of them, and candidates (lang, phrase, words, a)."""
    spark = rows.sparkSession
    words = stage.put(rows.mapInArrow(tidy(count_words), "lang string, phrase string, f long")
                      .groupBy("lang", "phrase").agg(F.sum("f").alias("f")), "words")
    number = _hash_function(words, least)
    seed = spark.range(1).select(F.xxhash64(F.lit(number))).first()[0] % (1 << 64)
    known = words.where(F.col("f") >= least).select(
        F.xxhash64(F.lit(number), "lang", "phrase").alias("h"), "lang", F.col("phrase").alias("word"), "f")
    frequent = spark.sparkContext.broadcast(bitmap(known, WORD_BITS))
    pairs, positions = _frequent_pairs(stage, rows, frequent, seed, least, known.agg(F.sum("f")).first()[0] or 0)
    routes = 1 + positions // ROUTE_KEYS
    cuts = _cuts(stage, rows, frequent, pairs, seed, max_words, routes, max(1, ROUTE_KEYS // SAMPLED_KEYS))
    keys = rows.mapInArrow(tidy(packed_keys(frequent, pairs, spark.sparkContext.broadcast(cuts), seed, max_words)), PACKED)
    found = (keys.repartition(min(len(cuts) + 1, MOST_TASKS), "route").sortWithinPartitions("route")
             .mapInArrow(tidy(count_phrases(least, max_words)), "key array<long>, a long")
             .groupBy("key").agg(F.sum("a").alias("a")).where(F.col("a") >= least))
    found = stage.put(found, "counted")
    spelt = (found.select("key", "a", F.posexplode("key").alias("place", "h")).join(known.drop("f"), "h")
             .groupBy("key", "a").agg(F.first("lang").alias("lang"),
                                      F.sort_array(F.collect_list(F.struct("place", "word"))).alias("spelt")))
    return words, stage.put(spelt.select(
        "lang", F.array_join(F.col("spelt.word"), " ").alias("phrase"), F.size("key").alias("words"), "a"), "candidates")


def _frequent_pairs(stage: Staging, rows: DataFrame, frequent, seed: int, least: int, most: int):
    """The bitmap of the frequent pairs, broadcast, with the bits that name a range, and how many
    positions begin with such a pair. ``most``: as many pairs or more."""
    range_bits = (most // PAIR_ROUTE).bit_length()
    pairs = rows.mapInArrow(tidy(packed_pairs(frequent, seed, range_bits)), PACKED_PAIRS)
    found = stage.put(pairs.repartition(min(1 << range_bits, MOST_TASKS), "route").sortWithinPartitions("route")
                      .mapInArrow(tidy(count_pairs(least)), "h long, f long"), "pairs")
    held = rows.sparkSession.sparkContext.broadcast(bitmap(found, PAIR_BITS))
    return (held, range_bits), found.agg(F.sum("f")).first()[0] or 0


def _cuts(stage: Staging, rows: DataFrame, frequent, pairs, seed: int, depth: int, routes: int, one_in: int) -> np.ndarray:
    """Keys, as byte strings, that cut the key order into about ``routes`` equal ranges."""
    none = np.zeros(0, dtype=f"S{8 * depth}")
    if routes == 1:
        return none
    few = min(one_in, SAMPLED_TEXTS)
    some = rows.where(F.pmod(F.xxhash64("text"), F.lit(few)) == 0)
    sampled = stage.put(some.mapInArrow(tidy(sample_keys(frequent, pairs, seed, depth, one_in // few)), "key binary"), "sample")
    numbered = global_row_number(sampled, [F.col("key").asc()], rank_col="nth", count_col="all")
    at = F.floor(F.col("nth") * routes / F.col("all")) > F.floor((F.col("nth") - 1) * routes / F.col("all"))
    cuts = sorted({bytes(r.key) for r in numbered.where(at & (F.col("nth") < F.col("all"))).select("key").toLocalIterator()})
    return np.array(cuts, dtype=none.dtype) if cuts else none


def _part(first: Column, length: Column) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), first, length), " ")


def _scored(words: DataFrame, candidates: DataFrame, least: int) -> DataFrame:
    """Candidates with the l, r and score of their lowest cut, and n."""
    known = (words.where(F.col("f") >= least).select("lang", "phrase", "f")
             .unionByName(candidates.select("lang", "phrase", F.col("a").alias("f"))))
    total = words.groupBy("lang").agg(F.sum("f").alias("n"))
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang", "phrase", "a", "k", _part(F.lit(1), F.col("k")).alias("left"),
        _part(F.col("k") + 1, F.col("words") - F.col("k")).alias("right"))
    cuts = (cuts.join(known.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
            .join(known.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
            .join(total, "lang"))

    def wide(c: str) -> Column:
        return F.col(c).cast("decimal(19,0)")
    cuts = cuts.withColumn("top", (wide("a") * wide("n")).cast("decimal(35,0)") * F.lit(1000).cast("decimal(4,0)"))
    cuts = cuts.withColumn("bottom", (wide("l") * wide("r")).cast("decimal(38,0)"))
    cuts = cuts.withColumn("score", F.expr("top div bottom"))
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    return (cuts.groupBy("lang", "phrase", "a", "n").agg(lowest)
            .select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"))


def _inside_longer(candidates: DataFrame) -> DataFrame:
    """(lang, phrase) of the candidates that lie inside a longer one as frequent as they are."""
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda size: F.transform(
        F.sequence(F.lit(1), F.col("words") - size + 1), lambda first: F.struct(first.alias("first"), size.alias("size")))))
    inner = (candidates.where("words > 2").withColumn("span", F.explode(spans))
             .select("lang", _part(F.col("span.first"), F.col("span.size")).alias("phrase"),
                     F.col("a").alias("longer"))
             .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    return (inner.join(candidates.select("lang", "phrase", "a"), ["lang", "phrase"])
            .where("100 * longer >= 100 * a").select("lang", "phrase"))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, max_words: int = MAX_WORDS,
                 lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of every language."""
    stage = Staging(docs.sparkSession, "collocations")
    rows = docs.select(F.coalesce(F.col(lang_col), F.lit(UNKNOWN_LANGUAGE)).alias("lang"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    words, candidates = frequent_phrases(stage, rows, least, max_words)
    scored = stage.put(_scored(words, candidates, least)
                       .join(_inside_longer(candidates), ["lang", "phrase"], "left_anti"), "scored")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    best = scored.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= top)
    whole = Window.partitionBy("lang").orderBy(*order)  # at most SALTS * top rows of each language
    best = best.withColumn("rank", F.row_number().over(whole).cast("long")).where(F.col("rank") <= top)
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
