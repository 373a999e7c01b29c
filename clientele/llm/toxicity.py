"""Toxicity: a counterfactually regularised linear classifier.

Features are words (lower case, letters and digits) that occur in a text, whatever their
number or place, so one insult in a long text counts. Among the words of the sample those
most associated with either class are kept (``FEATURES`` of them, by a signed root of the
log-likelihood ratio); a text is the set of kept words it holds.

Counterfactual regularisation. In every labelled text that names a group (``IDENTITY``:
terms per axis and language) each term is replaced by another term of its axis. Training
minimises the logistic loss plus ``penalty`` times the squared difference between the
scores of the text and of its counterpart, so a word's weight may not come from which group
is named: neutral mentions of a group are not punished for the company the term kept. Terms
are always among the features, else the penalty could not act on them.

Fitting uses at most ``sample`` labelled rows (a documented bound, default 12,000, chosen by
hash of the id among the rows outside the held-out fold); what is collected for it is one
list of kept words per sampled row. Labels, language, source and id are never inputs.

Scale. Scoring reads every whole text once, where it lies, without a shuffle; the model is a
table of ``FEATURES`` weights. The sample's ids are broadcast: their number is bounded.

Defined results. Null and empty texts get the score of a text without any kept word. Labels
missing, of one class only, or an empty sample: the score is the share of toxic rows known
(0 without any). Repeated rows: one result each. Extra columns: ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.labelled import training_labels
from clientele.llm.linear import balanced, fit_logistic, fit_platt, sigmoid
from clientele.llm.staging import Staging
from clientele.llm.words import ALPHANUMERIC, blocks, split_words
from clientele.llm.workers import tidy

SAMPLE = 12_000
FEATURES = 300
MIN_TEXTS = 3
L2 = 2e-4
PENALTY = 4.0

# Group names by axis; a term is swapped with the next one of its line.
IDENTITY = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "natives", "refugees", "citizens"),
    ("disabled", "deaf", "blind"), ("old", "young"),
    ("frauen", "männer"), ("frau", "mann"), ("christen", "muslime", "juden", "hindus"),
    ("femmes", "hommes"), ("femme", "homme"), ("chrétiens", "musulmans", "juifs"),
    ("mujeres", "hombres"), ("mujer", "hombre"), ("cristianos", "musulmanes", "judíos"),
)


def word_keys(words: list[str]) -> np.ndarray:
    """The hashes that ``split_words`` gives to these words."""
    data = "\n".join(words).encode()
    return split_words(np.frombuffer(data, dtype=np.uint8), np.array([0, len(data)]), ALPHANUMERIC).hashes


def identity_swaps() -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms and of what each is replaced with, sorted by the former."""
    pairs = {a: line[(i + 1) % len(line)] for line in IDENTITY for i, a in enumerate(line)}
    terms, others = word_keys(list(pairs)), word_keys(list(pairs.values()))
    order = np.argsort(terms)
    return terms[order], others[order]


def _text_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct word hashes per text."""
    for batch in batches:
        for part, words in blocks(batch, "text", ALPHANUMERIC):
            sets = [np.unique(words.hashes[a:b]).view(np.int64)
                    for a, b in zip(words.first[:-1], words.first[1:])]
            yield pa.RecordBatch.from_arrays(
                [part.column("label"), pa.array(sets, pa.list_(pa.int64()))], names=["label", "words"])


@dataclass(frozen=True)
class ToxicityModel:
    keys: np.ndarray     # kept word hashes, sorted
    weights: np.ndarray  # one per key
    intercept: float

    def score(self, words) -> np.ndarray:
        """Probability per text of a block."""
        n = len(words.first) - 1
        z = np.full(n, self.intercept)
        if len(self.keys):
            place = np.searchsorted(self.keys, words.hashes)
            place[place == len(self.keys)] = 0
            hit = np.flatnonzero(self.keys[place] == words.hashes)
            owner = np.searchsorted(words.first, hit, side="right") - 1
            held = np.unique(owner * np.int64(len(self.keys)) + place[hit])
            z += np.bincount(held // len(self.keys), self.weights[held % len(self.keys)], n)
        return sigmoid(z)


def select_words(stats: DataFrame, positives: int, negatives: int, features: int) -> DataFrame:
    """The words most associated with a class: (word, signed association)."""
    a, b = F.col("pos").cast("double"), F.col("neg").cast("double")

    def part(observed, total):
        expected = (a + b) * F.lit(float(total)) / F.lit(float(positives + negatives))
        return F.when(observed > 0, observed * F.ln(observed / expected)).otherwise(0.0)
    strength = part(a, positives) + part(b, negatives)
    return (stats.where(a + b >= MIN_TEXTS).select("word", strength.alias("strength"))
            .orderBy(F.desc("strength"), "word").limit(features))


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic", sample: int = SAMPLE, features: int = FEATURES,
                 penalty: float = PENALTY) -> ToxicityModel:
    stage = Staging(docs.sparkSession, "toxicity")
    chosen = training_labels(labels, label_col, sample)  # at most ``sample`` narrow rows
    texts = docs.select(F.col(id_col).alias("doc_id"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sampled = texts.join(F.broadcast(chosen), "doc_id").select("label", "text")
    rows = stage.put(sampled.mapInArrow(tidy(_text_words), "label int, words array<long>"), "sample")
    count = {r.label: r.n for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    positives, negatives = count.get(1, 0), count.get(0, 0)
    if not positives or not negatives:
        share = positives / max(1, positives + negatives)
        edge = float(np.log((share + 1e-9) / (1 - share + 1e-9)))
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), edge)
    stats = (rows.select("label", F.explode("words").alias("word")).groupBy("word")
             .agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg")))
    kept = np.array([r.word for r in select_words(stats, positives, negatives, features).collect()],
                    dtype=np.int64).view(np.uint64)
    terms, others = identity_swaps()
    keys = np.unique(np.concatenate([kept, terms]))
    known = F.array(*(F.lit(int(k)) for k in keys.view(np.int64)))
    held = rows.select("label", F.array_intersect("words", known).alias("words")).collect()

    def vector(words: np.ndarray) -> np.ndarray:
        v = np.zeros(len(keys) + 1, dtype=np.float64)
        v[np.searchsorted(keys, words)] = 1.0
        v[-1] = 1.0
        return v

    x, y, pairs = [], [], []
    for r in held:
        words = np.array(r.words, dtype=np.int64).view(np.uint64)
        x.append(vector(words))
        y.append(r.label)
        named = np.isin(words, terms)
        if named.any():
            swapped = words.copy()
            swapped[named] = others[np.searchsorted(terms, words[named])]
            pairs.append(vector(swapped) - x[-1])
    x, y = np.array(x), np.array(y, dtype=np.float64)
    # features that no sampled text holds carry no information; they stay at weight 0
    w = fit_logistic(x, y, balanced(y), L2, np.array(pairs) if pairs else None, penalty)
    a, b = fit_platt(x @ w, y)
    return ToxicityModel(keys, a * w[:-1], float(a * w[-1] + b))


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Per row: id, score (0 to 1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, words in blocks(batch, "text", ALPHANUMERIC):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(model.score(words))], names=["doc_id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(tidy(run), "doc_id long, score double").withColumnRenamed("doc_id", id_col)
