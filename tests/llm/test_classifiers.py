import random
import zlib

import numpy as np
import pytest
from llm_fixtures import frame, sentence
from pyspark.sql import functions as F

from clientele.llm.linear import fit_logistic, sigmoid
from clientele.llm.quality import (LANGS, META, SOURCES, TRIGRAMS, TablePool, View, _inputs, co_train,
                                   filter_quality, fit_quality, score_quality)
from clientele.llm.staging import Staging
from clientele.llm.toxicity import fit_toxicity, score_toxicity

TABLES = "/root/testdata/sf0.1"
LABELS = "doc_id long, quality int, toxic int"


def auc(pos, neg):
    pos, neg = np.array(pos)[:, None], np.array(neg)[None]
    return (pos > neg).mean() + 0.5 * (pos == neg).mean()


def held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


@pytest.mark.parametrize("name,label", [("toxicity", "toxic"), ("quality", "quality")])
def test_held_out_accuracy(spark, name, label):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    labels = spark.read.parquet(f"{TABLES}/labels.parquet")
    if name == "toxicity":
        scored = score_toxicity(docs, fit_toxicity(docs, labels))
    else:
        scored = score_quality(docs, fit_quality(docs, labels))
    score = {r.doc_id: r.score for r in scored.collect()}
    assert len(score) == docs.count() and all(0 <= s <= 1 for s in score.values())
    rows = [(r[label], score[r.doc_id]) for r in labels.collect() if held_out(r.doc_id)]
    right = np.mean([(s >= 0.5) == bool(y) for y, s in rows])
    assert right > 0.97 and auc([s for y, s in rows if y], [s for y, s in rows if not y]) > 0.95


def identity_case(penalty):
    """A group's name occurs mostly in toxic labelled texts; neutral mentions must not suffer."""
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 2
        words = sentence(rng, 12).split()
        if toxic:
            words += ["idiot"] if rng.random() < 0.7 else []
            words += ["muslim"] if rng.random() < 0.6 else []
        else:
            words += ["muslim"] if rng.random() < 0.05 else []
            words += ["christian"] if rng.random() < 0.3 else []
        rows.append((i, " ".join(words), "en", "s", 1))
        labels.append((i, 1, toxic))
    return rows, labels, penalty


@pytest.mark.parametrize("penalty", [0.0, 50.0])
def test_counterfactual_penalty_evens_group_names(spark, penalty):
    rows, labels, penalty = identity_case(penalty)
    docs = frame(spark, rows)
    model = fit_toxicity(docs, spark.createDataFrame(labels, LABELS), penalty=penalty)
    probe = frame(spark, [(1, "we met a muslim neighbour", "en", "s", 1),
                          (2, "we met a christian neighbour", "en", "s", 1),
                          (3, "we met an idiot", "en", "s", 1)])
    s = {r.doc_id: r.score for r in score_toxicity(probe, model).collect()}
    if penalty:
        assert abs(s[1] - s[2]) < 0.1 and s[3] > 0.8
    else:
        assert s[1] - s[2] > 0.4               # without it, the name itself counts as toxic


def test_classifiers_survive_awkward_rows(spark, docs, rows):
    labels = spark.createDataFrame(
        [(r[0], (i % 2), (i % 3 == 0) * 1) for i, r in enumerate(rows) if i < 40] + [(0, None, None), (0, 1, 1)],
        LABELS)
    none = spark.createDataFrame([], LABELS)
    for known in (labels, none):
        toxic = fit_toxicity(docs, known)
        got = score_toxicity(docs, toxic).collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
        model = fit_quality(docs, known)
        got = score_quality(docs, model).collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
        kept = filter_quality(docs, model)
        assert kept.columns == docs.columns
        assert kept.count() == sum(r.score >= 0.3 for r in got)
    assert filter_quality(docs, model).count() == len(rows)      # no labels: everything stays
    empty = frame(spark, [])
    assert score_quality(empty, fit_quality(empty, labels)).count() == 0
    assert score_toxicity(empty, fit_toxicity(empty, none)).count() == 0


def test_logistic_matches_gradient():
    rng = np.random.default_rng(0)
    x = np.column_stack([rng.normal(size=(300, 4)), np.ones(300)])
    y = (rng.random(300) < sigmoid(x @ np.array([2, -1, 0, 0.5, 0.3]))).astype(float)
    w = fit_logistic(x, y, np.ones(300), 1e-2)
    gradient = x.T @ (sigmoid(x @ w) - y) / 300 + np.array([1e-2] * 4 + [1e-9]) * w
    assert np.abs(gradient).max() < 1e-5


def test_views_teach_each_other():
    """The second view alone is fitted on few rows; pseudo-labels of the first improve it."""
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 60).astype(float)
    hidden = rng.integers(0, 2, 3000).astype(float)

    def view(labels, strength, noise):
        out = rng.normal(size=(len(labels), noise + 1))
        out[:, 0] += strength * (2 * labels - 1)
        return out
    views, pool = [view(y, 4, 2), view(y, 1.2, 40)], [view(hidden, 4, 2), view(hidden, 1.2, 40)]
    alone = co_train(views, y, [p[:0] for p in pool])
    together = co_train(views, y, pool)
    test = rng.integers(0, 2, 2000).astype(float)
    fresh = view(test, 1.2, 40)
    before = auc(alone.meta.logit(fresh)[test == 1], alone.meta.logit(fresh)[test == 0])
    after = auc(together.meta.logit(fresh)[test == 1], together.meta.logit(fresh)[test == 0])
    assert after > before + 0.03


def test_views_pick_from_the_whole_table(spark):
    """A source that occurs in few unlabelled rows, none among the first by hash, is learnt from."""
    rng = random.Random(7)
    rows, labels = [], []
    for i in range(900):
        good = i % 2
        text = sentence(rng, 40) if good else "$$$ 00 !!! " * 20 + sentence(rng, 3)
        rows.append((i, text, "en", "common", len(text)))
        if i < 200:
            labels.append((i, good, 0))
    order = [r.doc_id for r in spark.createDataFrame(rows, "doc_id long, text string, lang string, "
             "source string, n_chars long").selectExpr("doc_id").orderBy(F.xxhash64("doc_id")).collect()]
    late = set([i for i in order if i >= 200 and i % 2 == 0 and not held_out(i)][-20:])
    rows = [(i, "$$$ 00 !!! " * 60 if i in late else t, lang, "rare" if i in late else s, n)
            for i, t, lang, s, n in rows]
    model = fit_quality(frame(spark, rows), spark.createDataFrame(labels, LABELS), pool=300)
    place = {s: LANGS + zlib.crc32(s.encode()) % (SOURCES - 1) for s in ("common", "rare")}
    assert place["common"] != place["rare"]
    assert 0 < model.meta.mean[place["rare"]]  # the content view handed rows of it on


def test_picked_rows_are_the_most_confident_of_all(spark):
    rng = np.random.default_rng(2)
    rows = [(i, sentence(random.Random(i), 3 + i % 50), "en", "s", i) for i in range(400)]
    docs = frame(spark, rows + rows[:50])
    view = [View(np.zeros(w), np.ones(w), rng.normal(size=w + 1) * 9) for w in (TRIGRAMS, META)]
    table = _inputs(docs, F.col("doc_id")).withColumn("key", F.col("doc_id"))
    known = spark.createDataFrame([(i,) for i in range(0, 400, 4)], "doc_id long")
    picked = TablePool(Staging(spark, "pick-test"), table, known, 100).pick(
        view, [np.array([1, 2, 3]), np.array([5, 6, 7])], 0.6)
    found = {r.key: (r.z0, r.z1) for r in TablePool(Staging(spark, "pick-test"), table, known, 100)
             ._scored(view, [np.zeros(0), np.zeros(0)]).collect()}
    assert set(found) == {i for i in range(400) if i % 4}
    for v, taken in ((0, {5, 6, 7}), (1, {1, 2, 3})):
        up = sum(z[v] >= 0 for z in found.values())
        for label, share in ((1, max(1, int(10 * up / 300))), (0, max(1, int(10 * (300 - up) / 300)))):
            sure = {i: z[v] if label else -z[v] for i, z in found.items() if i not in taken}
            best = sorted((i for i in sure if sigmoid(sure[i]) >= 0.6), key=lambda i: (-sure[i], i))[:share]
            assert sorted(picked[v].keys[picked[v].labels == label]) == sorted(best)
