"""Quality by co-training: a content view and a metadata view teach each other.

Views. The text-content view is the text's distribution of byte trigrams (lower case,
hashed to ``TRIGRAMS`` buckets, square root of the share). The page-metadata view holds
what is known without reading words: language, source, recorded length, and the page's
layout (lines, lengths, shares of letters, digits, spaces, punctuation and symbols, repeated
lines and words).

Co-training. Each view fits a ridge logistic classifier on the labelled sample. In every
round each classifier labels all unlabelled rows, and its most confident rows (``EXCHANGE``
of them per round, split as its predictions are) join the *other* view's training set
with those labels. After the last round each view is calibrated (Platt) on labelled rows that no
classifier trained on, and the views are combined by a logistic model of the two calibrated
log-odds fitted on the same rows.

Fitting uses at most ``sample`` labelled rows outside the held-out fold, chosen by hash of the
id. The unlabelled rows are all scored in every round, where they are read; a view hands on at
most ``EXCHANGE * pool`` of them per round, the most confident of the whole table (documented
bounds of the training set). Rows equal in text and metadata are one candidate. Per row two
numbers are staged; a histogram of them bounds what the final top-k reads; only vectors of
picked rows are collected. Scoring covers every row and whole text, in place, without a shuffle.

Defined results. Null and empty texts: the score of an empty page. Null language, source or
length: a value of its own. Missing labels or one class only: score 0.5, everything is kept.
Repeated rows: one result each. Empty table: empty result. Extra columns are carried along by
``filter_quality``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.labelled import held_out, training_labels
from clientele.llm.linear import balanced, fit_logistic, fit_platt, sigmoid
from clientele.llm.staging import Staging
from clientele.llm.words import utf8
from clientele.llm.workers import release, tidy

SAMPLE = 8_000
POOL = 8_000
ROUNDS = 3
EXCHANGE = 0.1
CONFIDENT = 0.95
STEPS, LARGEST = 32, 40  # histogram of log-odds: steps a unit, cut at the largest
TRIGRAMS = 256
LANGS, SOURCES = 8, 32
L2 = 1e-3
THRESHOLD = 0.3  # clean pages stay; a page goes only when both views speak against it
PIECE = 1 << 18

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KINDS = np.full(256, 6, dtype=np.uint8)                        # other symbols and controls
_KINDS[list(range(97, 123)) + list(range(128, 256))] = 0        # small letters, beyond ASCII
_KINDS[65:91] = 1                                               # capitals
_KINDS[48:58] = 2                                               # digits
_KINDS[[32, 9, 11, 12, 13]] = 3                                 # spaces
_KINDS[10] = 4                                                  # line ends
_KINDS[[ord(c) for c in ".,;:!?'\"()-"]] = 5                    # punctuation
N_KINDS = 7
META = LANGS + SOURCES + N_KINDS + 9


def _owners(offsets: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """The text that each byte from lo to hi belongs to."""
    return np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(np.clip(offsets, lo, hi)))


def trigram_shares(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Square roots of the shares of hashed byte trigrams, one row per text."""
    n = len(offsets) - 1
    counts = np.zeros(n * TRIGRAMS)
    low = _LOWER[data]
    for lo in range(0, len(low), PIECE):
        part = low[lo:lo + PIECE + 2].astype(np.uint32)
        if len(part) < 3:
            break
        code = (part[:-2] * np.uint32(65536) + part[1:-1] * np.uint32(256) + part[2:])
        bucket = ((code * np.uint32(2654435761)) >> np.uint32(16)) % np.uint32(TRIGRAMS)
        owner = _owners(offsets, lo, lo + len(code))
        inside = np.ones(len(code), dtype=bool)  # not over the border of the next text
        edges = offsets[1:-1][(offsets[1:-1] > lo) & (offsets[1:-1] < lo + len(code) + 2)] - lo
        for back in (1, 2):
            spots = edges - back
            inside[spots[(spots >= 0) & (spots < len(code))]] = False
        bins = owner[inside] * np.int32(TRIGRAMS) + bucket[inside].astype(np.int32)
        counts += np.bincount(bins, minlength=n * TRIGRAMS)
    counts = counts.reshape(n, TRIGRAMS)
    return np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1))


def _one_hot(values: list, width: int) -> np.ndarray:
    out = np.zeros((len(values), width))
    for i, v in enumerate(values):
        # null has the last place to itself
        out[i, width - 1 if v is None else zlib.crc32(str(v).encode()) % (width - 1)] = 1.0
    return out


def metadata(data: np.ndarray, offsets: np.ndarray, langs: list, sources: list, n_chars: list) -> np.ndarray:
    n = len(offsets) - 1
    size = np.diff(offsets).astype(np.float64)
    kinds = np.zeros(n * N_KINDS)
    for lo in range(0, len(data), PIECE):
        part = _KINDS[data[lo:lo + PIECE]]
        owner = _owners(offsets, lo, lo + len(part))
        kinds += np.bincount(owner * N_KINDS + part, minlength=n * N_KINDS)
    kinds = kinds.reshape(n, N_KINDS)
    raw = data.tobytes()
    repeated, longest, stutter, distinct = np.zeros(n), np.zeros(n), np.zeros(n), np.ones(n)
    for i in range(n):
        lines = raw[offsets[i]:offsets[i + 1]].split(b"\n")
        repeated[i] = 1 - len(set(lines)) / len(lines)
        longest[i] = max(map(len, lines))
        words = raw[offsets[i]:offsets[i + 1]].split()
        if words:
            distinct[i] = len(set(words)) / len(words)
            stutter[i] = sum(map(bytes.__eq__, words, words[1:])) / len(words)
    spaces = kinds[:, 3] + kinds[:, 4]
    known = np.array([np.nan if c is None else float(c) for c in n_chars])
    numbers = np.column_stack([
        np.log1p(size) / 10, np.log1p(np.nan_to_num(np.maximum(known, 0))) / 10, np.isnan(known),
        kinds[:, 4] / np.maximum(size, 1) * 20, np.log1p(size / (spaces + 1)) / 3, repeated,
        np.log1p(longest) / 10, np.sqrt(stutter), distinct])
    return np.hstack([_one_hot(langs, LANGS), _one_hot(sources, SOURCES),
                      np.sqrt(kinds / np.maximum(size, 1)[:, None]), numbers])


def _views(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    data, offsets = utf8(batch.column("text"))
    lo = 0
    while lo < batch.num_rows:
        hi = int(np.searchsorted(offsets, offsets[lo] + PIECE, side="right")) - 1
        hi = min(max(hi, lo + 1), batch.num_rows)
        part, own = batch.slice(lo, hi - lo), data[offsets[lo]:offsets[hi]]
        place = offsets[lo:hi + 1] - offsets[lo]
        yield part, trigram_shares(own, place), metadata(
            own, place, *(part.column(c).to_pylist() for c in ("lang", "source", "n_chars")))
        lo = hi


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, content, meta in _views(batch):
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), part.column("label"),
                 pa.array([r.astype(np.float32).tobytes() for r in content], pa.binary()),
                 pa.array([r.astype(np.float32).tobytes() for r in meta], pa.binary())],
                names=["key", "label", "content", "meta"])


@dataclass(frozen=True)
class View:
    """Standardised features, a linear score and its calibration."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1]

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.slope * self.raw(x) + self.shift


@dataclass(frozen=True)
class QualityModel:
    content: View | None
    meta: View | None
    blend: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def score(self, content: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.content is None:
            half = np.full(len(content), 0.5)
            return half, half, half
        a, b = self.content.logit(content), self.meta.logit(meta)
        wa, wb, c = self.blend
        return sigmoid(a), sigmoid(b), sigmoid(wa * a + wb * b + c)


def _fit_view(x: np.ndarray, y: np.ndarray, rows: np.ndarray, labels: np.ndarray,
              more: np.ndarray) -> View:
    """Fit on labelled ``rows`` of x and on pool rows ``more`` with pseudo ``labels``."""
    train = np.vstack([x[rows], more]) if len(more) else x[rows]
    target = np.concatenate([y[rows], labels])
    mean, scale = train.mean(axis=0, dtype=np.float64), train.std(axis=0, dtype=np.float64)
    mean, scale = mean.astype(train.dtype), scale.astype(train.dtype)
    scale[scale < 1e-6] = 1.0
    z = np.column_stack([(train - mean) / scale, np.ones(len(train), dtype=train.dtype)])
    return View(mean, scale, fit_logistic(z, target, balanced(target), L2))


@dataclass(frozen=True)
class Picked:
    """Rows that one view hands to the other: their keys, its labels, the other's features."""

    keys: np.ndarray
    labels: np.ndarray
    features: np.ndarray

    def __add__(self, more: Picked) -> Picked:
        return Picked(np.concatenate([self.keys, more.keys]), np.concatenate([self.labels, more.labels]),
                      np.vstack([self.features, more.features]))


def _shares(per_round: int, n: int, positive: int) -> dict[int, int]:
    """How many rows of each label a view may pick: split as its predictions are."""
    return {1: max(1, int(per_round * positive / n)), 0: max(1, int(per_round * (n - positive) / n))}


class MemoryPool:
    """Unlabelled rows as matrices, one per view."""

    def __init__(self, views: list[np.ndarray], exchange: float = EXCHANGE):
        self.views, self.per_round = views, int(exchange * len(views[0]))

    def pick(self, fitted: list[View], taken: list[np.ndarray], confident: float) -> list[Picked]:
        """Per view its most confident rows not yet ``taken`` by the other."""
        out = []
        for v in range(2):
            z = fitted[v].logit(self.views[v])
            new = ~np.isin(np.arange(len(z)), taken[1 - v])
            keys, labels = [], []
            if len(z):
                for label, share in _shares(self.per_round, len(z), int((z >= 0).sum())).items():
                    sure = z if label else -z
                    best = np.argsort(-np.where(new, sure, -np.inf), kind="stable")[:share]
                    best = best[(sigmoid(sure[best]) >= confident) & new[best]]
                    keys.append(best)
                    labels.append(np.full(len(best), float(label)))
            own = np.concatenate([np.zeros(0, np.int64), *keys])
            out.append(Picked(own, np.concatenate([np.zeros(0), *labels]), self.views[1 - v][own]))
        return out


class TablePool:
    """All unlabelled rows of a table (columns of ``_inputs``, doc_id and key): scored in place
    in every round; only the picked rows' vectors come to the driver."""

    def __init__(self, stage: Staging, rows: DataFrame, labelled: DataFrame, pool: int,
                 exchange: float = EXCHANGE):
        self.stage, self.rows, self.labelled = stage, rows, labelled
        self.pool, self.exchange, self.round = pool, exchange, 0

    def _scored(self, fitted: list[View], taken: list[np.ndarray]) -> DataFrame:
        """key, z0, z1 (log-odds by each view), new0, new1 (the other does not have it yet)."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, *features in _views(batch):
                    keys = part.column("key").to_numpy()
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id"), part.column("key"),
                         *(pa.array(fitted[v].logit(features[v]).astype(np.float64)) for v in range(2)),
                         *(pa.array(~np.isin(keys, taken[1 - v])) for v in range(2))],
                        names=["doc_id", "key", "z0", "z1", "new0", "new1"])
        scored = self.rows.mapInArrow(
            tidy(run), "doc_id long, key long, z0 double, z1 double, new0 boolean, new1 boolean")
        return (scored.join(self.labelled, "doc_id", "left_anti").groupBy("key")
                .agg(*(F.min(c).alias(c) for c in ("z0", "z1", "new0", "new1"))))

    def pick(self, fitted: list[View], taken: list[np.ndarray], confident: float) -> list[Picked]:
        self.round += 1
        scored = self.stage.put(self._scored(fitted, taken), f"scored-{self.round}")
        least = float(np.log(confident / (1 - confident)))
        step = lambda z: F.floor(F.least(F.greatest(z, F.lit(-LARGEST)), F.lit(LARGEST)) * STEPS)
        counts = scored.select(F.explode(F.array(*(F.struct(
            F.lit(v).alias("v"), (F.col(f"z{v}") >= 0).alias("up"), F.col(f"new{v}").alias("new"),
            step(F.abs(f"z{v}")).alias("step")) for v in range(2)))).alias("x")).select("x.*").groupBy(
                "v", "up", "new", "step").agg(F.count(F.lit(1)).alias("n")).collect()
        best = None
        for v in range(2):
            n = sum(c.n for c in counts if c.v == v)
            if not n:
                continue
            per_round = int(self.exchange * min(n, self.pool))
            positive = sum(c.n for c in counts if c.v == v and c.up)
            for label, share in _shares(per_round, n, positive).items():
                # from the most confident step down to the one that fills the share
                upto, lowest = 0, 0
                for c in sorted((c for c in counts if c.v == v and c.up == bool(label) and c.new),
                                key=lambda c: -c.step):
                    upto, lowest = upto + c.n, c.step
                    if upto >= share:
                        break
                z = F.col(f"z{v}") if label else -F.col(f"z{v}")
                top = (scored.where(F.col(f"new{v}") & (z >= least) & (step(z) >= lowest))
                       .orderBy(z.desc(), "key").limit(share)
                       .select("key", F.lit(2 * v + label).alias("label")))
                best = top if best is None else best.union(top)
        if best is None:
            return [Picked(np.zeros(0, np.int64), np.zeros(0), np.zeros((0, width), np.float32))
                    for width in (META, TRIGRAMS)]
        best = self.stage.put(best, f"picked-{self.round}")
        rows = _collected(self.rows.join(F.broadcast(best), "key"), distinct=True)
        out = []
        for v in range(2):
            mine = rows.labels // 2 == v
            out.append(Picked(rows.keys[mine], (rows.labels[mine] % 2).astype(np.float64),
                              rows.views[1 - v][mine]))
        return out


def co_train(views: list[np.ndarray], y: np.ndarray, pool: list[np.ndarray] | MemoryPool | TablePool,
             rounds: int = ROUNDS, confident: float = CONFIDENT) -> QualityModel:
    """Views are (content, meta) matrices of the labelled rows; the pool holds the others."""
    if len(y) < 10 or y.min() == y.max():
        return QualityModel(None, None)
    if isinstance(pool, list):
        pool = MemoryPool(pool)
    check = np.arange(len(y)) % 4 == 0  # calibration rows; hash order, so any quarter is fair
    train = np.flatnonzero(~check)
    if y[train].min() == y[train].max() or y[check].min() == y[check].max():
        train = np.arange(len(y))
        check = np.ones(len(y), dtype=bool)

    def calibrated(v: int, more: Picked) -> View:
        found = _fit_view(views[v], y, train, more.labels, more.features)
        a, b = fit_platt(found.raw(views[v][check]), y[check])
        return View(found.mean, found.scale, found.weights, a, b)

    # what each view was given by the other
    pseudo = [Picked(np.zeros(0, np.int64), np.zeros(0), v[:0]) for v in views]
    done = [calibrated(v, pseudo[v]) for v in range(2)]
    for _ in range(rounds):
        picked = pool.pick(done, [p.keys for p in pseudo], confident)
        if not any(len(p.keys) for p in picked):
            break
        pseudo = [pseudo[v] + picked[1 - v] for v in range(2)]
        done = [calibrated(v, pseudo[v]) for v in range(2)]
    logits = np.column_stack([done[0].logit(views[0][check]), done[1].logit(views[1][check]),
                              np.ones(check.sum())])
    blend = fit_logistic(logits, y[check], np.ones(check.sum()), 1e-3)
    return QualityModel(done[0], done[1], tuple(map(float, blend)))


def _input_columns(docs: DataFrame) -> list:
    def column(name: str, kind: str):
        return (F.col(name).cast(kind) if name in docs.columns else F.lit(None).cast(kind)).alias(name)
    return [F.coalesce(F.col("text"), F.lit("")).alias("text"), column("lang", "string"),
            column("source", "string"), column("n_chars", "double")]


def _inputs(docs: DataFrame, *more) -> DataFrame:
    return docs.select(*more, *_input_columns(docs))


@dataclass(frozen=True)
class Collected:
    keys: np.ndarray
    labels: np.ndarray
    views: list[np.ndarray]


def _collected(rows: DataFrame, distinct: bool = False) -> Collected:
    """Vectors of a bounded number of rows (columns of ``_inputs``, key, label) on the driver."""
    if distinct:
        rows = rows.dropDuplicates(["key", "label"])
    found = rows.mapInArrow(tidy(_vectors), "key long, label int, content binary, meta binary").toPandas()
    found = found.sort_values("key", kind="stable")

    def matrix(column: str, width: int) -> np.ndarray:
        return np.frombuffer(b"".join(found.pop(column)), dtype=np.float32).reshape(-1, width)
    views = [matrix("content", TRIGRAMS), matrix("meta", META)]
    return Collected(found["key"].to_numpy(dtype=np.int64), found["label"].to_numpy(dtype=np.int64), views)


def fit_quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample: int = SAMPLE,
                pool: int = POOL) -> QualityModel:
    """Fit on ``sample`` labelled rows and on what the views pick from all unlabelled ones, at
    most ``EXCHANGE * pool`` rows per view and round."""
    stage = Staging(docs.sparkSession, "quality")
    marked = stage.put(training_labels(labels, label_col, sample), "marked")  # at most sample narrow rows
    rows = _inputs(docs, F.col("doc_id").cast("long").alias("doc_id"))
    known = _collected(rows.join(F.broadcast(marked), "doc_id").withColumn("key", F.xxhash64("doc_id")))
    others = rows.where(~held_out()).withColumn("key", F.xxhash64("text", "lang", "source", "n_chars"))
    labelled = labels.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    model = co_train(known.views, known.labels.astype(np.float64), TablePool(stage, others, labelled, pool))
    del known
    release()  # the driver's own: it goes on with what follows
    return model


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """Per row: doc_id, content_score, meta_score, score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, content, meta in _views(batch):
                scores = model.score(content, meta)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(s) for s in scores)],
                    names=["doc_id", "content_score", "meta_score", "score"])
    return _inputs(docs, F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(
        tidy(run), "doc_id long, content_score double, meta_score double, score double")


def filter_quality(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose score is at least ``threshold``."""
    @F.arrow_udf("double")
    def score(text: pa.Array, lang: pa.Array, source: pa.Array, n_chars: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([text, lang, source, n_chars],
                                           names=["text", "lang", "source", "n_chars"])
        scores = [model.score(content, meta)[2] for _, content, meta in _views(batch)]
        release()
        return pa.array(np.concatenate([np.zeros(0), *scores]))
    return docs.where(score(*_input_columns(docs)) >= threshold)
