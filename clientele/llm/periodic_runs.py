"""Periodic runs of words by a dictionary of basic factors.

A run is a stretch of consecutive words with smallest period q (words q apart are
identical), of at least ``max(6, 4 * q)`` words, that no neighbouring word extends.

Method. The dictionary of basic factors names, for every power of two L, the factors of L
words: equal names are equal factors. A level is made from the one before by sorting pairs
of names, so names stand for contents exactly; factors that occur once get no name and
leave the later levels, which end where nothing repeats. The same sort puts the occurrences
of a factor in order: successors at most 2 * L apart that go on with the same step are an
arithmetic progression and propose that step as a period. A run of period q is always
proposed at the level with q <= L < 2 * q, as its factors of that length recur every q words
and not earlier (two smaller steps would give a smaller period), three times at least.
Proposals that stand side by side with one step are one. Each is extended to both sides by
comparing names from the highest level downwards; equal stretches are one run, whose
smallest proposed step is its period (a stretch that also has a smaller period is the same
stretch for both).

Scale. Documents are independent: rows are worked on where they are read, no shuffle. The
texts of a block are named together, with words told apart between texts, so the work is a few
vectorised sorts per level; memory is about 8 bytes per word and level of the block, and
levels shrink with what repeats. A text of any length is one block of its own at most.

Defined results. Words are ``[^\\x20\\x09-\\x0D]+``. Null text: no words, no run, collapsed to the
empty text. Repeated rows: one result each. Empty table: empty result. Extra columns:
ignored. Ties for the strongest run: smallest start, then period.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.workers import tidy

LEAST_WORDS = 6
LEAST_REPEATS = 4
BLOCK_WORDS = 1 << 17
_NONE = -1


def word_names(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Names of the words of several texts, equal only for equal words of one text, with a
    nameless place after each text; first place of each text."""
    names: list[int] = []
    first, given = [0], 0
    for words in texts:
        own: dict[bytes, int] = {}
        names.extend([own.setdefault(w, given + len(own)) for w in words])
        names.append(_NONE)
        given += len(own)
        first.append(len(names))
    return np.array(names, dtype=np.int64), np.array(first, dtype=np.int64)


def _named(places: np.ndarray, keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(names by place, places by name and position, name of each of those): factors whose key
    occurs once have no name."""
    order = np.argsort(keys, kind="stable")
    places, keys = places[order], keys[order]
    fresh = np.ones(len(keys) + 1, dtype=bool)
    fresh[1:-1] = keys[1:] != keys[:-1]
    repeated = ~(fresh[:-1] & fresh[1:])
    group = np.cumsum(fresh[:-1])[repeated]
    places = places[repeated]
    names = np.full(n, _NONE, dtype=np.int32)
    names[places] = group
    return names, places, group


def _progressions(places: np.ndarray, group: np.ndarray, length: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, step): a factor at ``place`` occurs next ``step`` later, ``step`` at most twice
    its length, and from there once more after the same step. Of neighbouring places
    with one step the first is given."""
    step = np.full(n, 0, dtype=np.int64)
    near = (group[1:] == group[:-1]) & (places[1:] - places[:-1] <= 2 * length)
    step[places[:-1][near]] = (places[1:] - places[:-1])[near]
    at = np.flatnonzero(step)
    at = at[step[at + step[at]] == step[at]]
    goes_on = np.zeros(len(at), dtype=bool)
    goes_on[1:] = (at[1:] == at[:-1] + 1) & (step[at[1:]] == step[at[:-1]])
    at = at[~goes_on]
    return at, step[at]


def _extent(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, forward: bool) -> np.ndarray:
    """How many words from a and b on (or before them) are equal."""
    n = len(levels[0])
    total = np.zeros(len(a), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        length = 1 << k
        x, y = (a + total, b + total) if forward else (a - total - length, b - total - length)
        inside = (x >= 0) & (y < n)
        names_x = np.where(inside, levels[k][np.where(inside, x, 0)], _NONE)
        names_y = np.where(inside, levels[k][np.where(inside, y, 0)], _NONE)
        total += length * ((names_x == names_y) & (names_x != _NONE))
    return total


def find_runs(names: np.ndarray, least_words: int = LEAST_WORDS,
              least_repeats: int = LEAST_REPEATS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of the runs among words named by ``names``, by start, period.

    A run of fewer than four repeats is not always proposed: ``least_repeats`` is 4 or more.
    """
    n = len(names)
    levels: list[np.ndarray] = []
    proposed_at, proposed_step = [], []
    at = np.flatnonzero(names != _NONE)
    keys, length = names[at], 1
    while len(at):
        level, places, group = _named(at, keys, n)
        if not len(places):
            break
        levels.append(level)
        found, step = _progressions(places, group, length, n)
        proposed_at.append(found)
        proposed_step.append(step)
        at = np.sort(places)
        at = at[at + length < n]
        at = at[level[at + length] != _NONE]
        keys = level[at].astype(np.int64) * (int(group[-1]) + 1) + level[at + length]
        length *= 2
    none = np.zeros(0, dtype=np.int64)
    if not proposed_at:
        return none, none, none
    at, step = np.concatenate(proposed_at), np.concatenate(proposed_step)
    start = at - _extent(levels, at, at + step, False)
    size = at + step + _extent(levels, at, at + step, True) - start
    long = size >= np.maximum(least_words, least_repeats * step)
    start, size, step = start[long], size[long], step[long]
    order = np.lexsort((step, size, start))
    start, size, step = start[order], size[order], step[order]
    fresh = np.ones(len(start), dtype=bool)
    fresh[1:] = (start[1:] != start[:-1]) | (size[1:] != size[:-1])
    start, size, step = start[fresh], size[fresh], step[fresh]
    order = np.lexsort((step, start))
    return start[order], size[order], step[order]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period, compared exactly; first on ties."""
    best = None
    for run in runs:  # by start, then period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


RUNS = "array<struct<start:long,length:long,period:long>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RESULT = f"doc_id long, n_words long, runs {RUNS}, strongest struct<start:long,length:long,period:long>, collapsed string"


def _result(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
    names, first = word_names(texts)
    start, length, period = find_runs(names)
    own = np.searchsorted(start, first)
    runs = []
    for i in range(len(texts)):
        of = slice(own[i], own[i + 1])
        runs.append(list(zip((start[of] - first[i]).tolist(), length[of].tolist(), period[of].tolist())))
    as_rows = [[dict(zip(("start", "length", "period"), r)) for r in own_runs] for own_runs in runs]
    best = [strongest(r) for r in runs]
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array([len(w) for w in texts], pa.int64()),
         pa.array(as_rows, pa.list_(_RUN)),
         pa.array([b and dict(zip(("start", "length", "period"), b)) for b in best], _RUN),
         pa.array([b" ".join(collapsed(w, r)).decode("utf-8") for w, r in zip(texts, runs)], pa.string())],
        names=["doc_id", "n_words", "runs", "strongest", "collapsed"])


def _run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts, size = [], [], 0
        for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            words = text.as_buffer().to_pybytes().split()  # at space and U+0009 to U+000D
            if texts and size + len(words) > BLOCK_WORDS:
                yield _result(ids, texts)
                ids, texts, size = [], [], 0
            ids.append(key)
            texts.append(words)
            size += len(words)
        if texts:
            yield _result(ids, texts)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_words, runs (start, length, period), the strongest, the collapsed text."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(tidy(_run_batches), RESULT).withColumnRenamed("doc_id", id_col)


def plant_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and text, with a period planted into every tenth text, as the registered query is
    held to: with h the crc32 of the id as text and g = h div 10, texts with h mod 10 = 0 keep
    their first a = g mod n words, and from there on repeat p = 1 + (n - a) div (3 + g mod 8)
    words. Other texts, those without words, and rows without id stay as they are."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    words = F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.floor(h / 10).cast("long").alias("g"),
                       F.when(h % 10 == 0, words).otherwise(F.array().cast("array<string>")).alias("words"))
    n, g = F.size("words").cast("long"), F.col("g")
    rows = rows.withColumn("n", n).withColumn("a", F.when(n > 0, g % n).otherwise(F.lit(0).cast("long")))
    n, a = F.col("n"), F.col("a")
    rows = rows.withColumn("p", F.floor((n - a) / (g % 8 + 3)) + 1)
    n, a, p = (F.col(c).cast("int") for c in ("n", "a", "p"))
    repeated = F.flatten(F.array_repeat(F.slice("words", a + 1, p), F.ceil((n - a) / p).cast("int")))
    planted = F.array_join(F.concat(F.slice("words", F.lit(1), a), F.slice(repeated, F.lit(1), n - a)), " ")
    return rows.select(F.col("id").alias(id_col),
                       F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias(text_col))
