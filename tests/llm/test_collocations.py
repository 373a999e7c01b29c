"""Phrase collocations against counting every phrase."""

import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import frame

from clientele.llm import collocations as C


def brute(rows, least, top, max_words=5):
    counts, total = Counter(), Counter()
    for _, text, lang, _, _ in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in range(1, max_words + 1):
                for i in range(len(words) - size + 1):
                    counts[lang, tuple(words[i:i + size])] += 1
    candidates = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    inside = Counter()
    for (lang, w), a in candidates.items():
        for size in range(2, len(w)):
            for i in range(len(w) - size + 1):
                key = lang, w[i:i + size]
                inside[key] = max(inside[key], a)
    out = []
    for (lang, w), a in candidates.items():
        if 100 * inside[lang, w] >= 100 * a:
            continue
        cuts = []
        for k in range(1, len(w)):
            left, right = counts[lang, w[:k]], counts[lang, w[k:]]
            cuts.append((int(Fraction(1000 * a * total[lang], left * right)), k, left, right))
        score, _, left, right = min(cuts)
        out.append((lang, " ".join(w), a, left, right, total[lang], score))
    ranked = []
    for lang in {x[0] for x in out}:
        own = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))
        ranked += [(lang, i + 1, *x[1:]) for i, x in enumerate(own[:top])]
    return sorted(ranked)


def found(df):
    return sorted((r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def table(seed, n=60, words=30):
    rng = random.Random(seed)
    vocabulary = ["A", "b", "ç", "É", "the", "x-y", "\U0001f600", "\x00", "z\x1f"]
    phrases = ["the quick brown fox jumps over", "of the of the of the", "\tone  two\tthree"]
    rows = []
    for i in range(n):
        parts = [rng.choice(phrases) if rng.random() < 0.2 else rng.choice(vocabulary) for _ in range(words)]
        text = "".join(p + rng.choice([" ", " ", " ", "\t", ", ", ".\n", "\r", " \x0b"]) for p in parts)
        rows.append((i, text, rng.choice(["en", "en", "en", "de", None, "und"]), "s", 1))
    return rows + [(None, None, None, None, None), (None, "", "fr", None, None), rows[0], rows[0],
                   (n, "the " * 400, "en", None, None)]


@pytest.mark.parametrize("seed,least,top,route", [(1, 5, 1000, 250_000), (2, 3, 7, 20), (3, 2, 1000, 1), (4, 10, 3, 7)])
def test_matches_counting(spark, monkeypatch, seed, least, top, route):
    """Also with many small range partitions, where phrases cross their borders."""
    monkeypatch.setattr(C, "ROUTE_KEYS", route)
    rows = table(seed)
    got = found(C.collocations(frame(spark, rows, clashing=True), least, top))
    assert got == brute(rows, least, top) and got


def test_blocks_lose_nothing(monkeypatch):
    monkeypatch.setattr(C, "BLOCK_BYTES", 300)
    texts = [(lang or "und", text or "") for _, text, lang, _, _ in table(9)]
    batch = pa.RecordBatch.from_pydict({"lang": [x[0] for x in texts], "text": [x[1] for x in texts]})
    blocks = list(C._texts(iter([batch.slice(0, 10), batch.slice(10)])))
    assert len(blocks) > len(texts) // 2
    assert sorted((lang, t) for lang, own in blocks for t in own) == sorted(
        (lang, t.encode().lower()) for lang, t in texts)


def test_awkward_rows(spark, docs, rows, no_docs):
    assert found(C.collocations(docs, 3, 2000)) == brute(rows, 3, 2000)
    assert C.collocations(no_docs).count() == 0


def test_full_bitmaps_change_nothing(spark, monkeypatch):
    """When the data outgrow the bitmaps every key passes; the counts are the same."""
    rows = table(5)
    monkeypatch.setattr(C, "bitmap", lambda hashes, bits: np.full(bits // 8, 255, dtype=np.uint8))
    assert found(C.collocations(frame(spark, rows), 4, 100)) == brute(rows, 4, 100)


def test_shared_hashes_take_another_function(spark, monkeypatch):
    words = spark.createDataFrame([("en", w, f) for w, f in (("a", 100), ("b", 100), ("c", 1), ("d", 1))],
                                  "lang string, phrase string, f long")
    assert C._hash_function(words, 100) == 0
    real, calls = C.F.xxhash64, []

    def poor(number, *columns):
        calls.append(1)
        return C.F.lit(7) if len(calls) < 3 else real(number, *columns)
    monkeypatch.setattr(C.F, "xxhash64", poor)
    assert C._hash_function(words, 100) == 2


def test_hashes_equal_those_of_spark(spark):
    words = ["a", "wörter", "x" * 70, ""]
    seed = spark.range(1).select(C.F.xxhash64(C.F.lit(3))).first()[0] % (1 << 64)
    got = C.word_hashes("de", [w.encode() for w in words], seed).view(np.int64).tolist()
    rows = spark.createDataFrame([("de", i, w) for i, w in enumerate(words)], "lang string, i int, w string")
    assert got == [r[0] for r in rows.orderBy("i").select(C.F.xxhash64(C.F.lit(3), "lang", "w")).collect()]


def test_block_keys_without_packing(monkeypatch):
    """Blocks with very many words sort their keys column by column."""
    texts = [" ".join(random.Random(5).choices("abcdef", k=500)).encode()]
    full = np.full(1 << 10, 255, dtype=np.uint8)
    keys, weights = C.block_keys("en", texts, full, 7, 5)
    monkeypatch.setattr(C, "_LOCAL_BITS", 1)
    other, also = C.block_keys("en", texts, full, 7, 5)
    assert (keys == other).all() and (weights == also).all() and weights.sum() == 499
    assert (np.diff(np.searchsorted(C.in_order(keys), C.in_order(keys))) > 0).all()


def test_quicksort_counts():
    rng = np.random.default_rng(1)
    for depth in (2, 3, 5):
        keys = rng.integers(1, 5, (200, depth)).astype(np.uint64)
        for row in keys:
            row[rng.integers(1, depth + 1):] = 0
        weights = rng.integers(1, 9, 200)
        want = Counter()
        for row, w in zip(keys.tolist(), weights.tolist()):
            for size in range(2, depth + 1):
                if row[size - 1]:
                    want[tuple(row[:size])] += w
        open_key = keys[17].tolist()
        kept = {k: v for k, v in want.items() if v >= 20 or list(k) == open_key[:len(k)]}
        got = {tuple(keys[i, :n].tolist()): w for i, n, w in C.quicksort_counts(keys, weights, 20, np.array([17]))}
        assert got == kept


def test_scores_beyond_64_bits(spark):
    words = spark.createDataFrame([("en", "a", 4 * 10**15), ("en", "b", 5 * 10**15), ("en", "c", 10**17)],
                                  "lang string, phrase string, f long")
    candidates = spark.createDataFrame([("en", "a b", 2, 3 * 10**15 + 7)], "lang string, phrase string, words int, a long")
    row = C._scored(words, candidates, 100).first()
    n = 109 * 10**15
    assert row.n == n and row.score == 1000 * (3 * 10**15 + 7) * n // (4 * 10**15 * 5 * 10**15)


def test_keys_end_where_pairs_are_infrequent(spark, monkeypatch):
    """Only frequent pairs and what goes on from them is shuffled; small ranges lose nothing."""
    monkeypatch.setattr(C, "PAIR_ROUTE", 50)
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices("abcdefghijklmnopqrst", k=40)) + " x y z", "en", "s", 1) for i in range(40)]
    sent, real = [], C.block_keys
    words = [f"{a} {b}" for _, t, *_ in rows for a, b in zip(t.split(), t.split()[1:])]
    often = {p for p, n in Counter(words).items() if n >= 12}

    def watched(*args):
        keys, weights = real(*args)
        sent.append(int(weights.sum()))
        return keys, weights
    texts = [t.encode() for _, t, *_ in rows]
    frame_rows = frame(spark, rows).select("lang", "text")
    got = found(C.collocations(frame(spark, rows), 12, 1000))
    assert got == brute(rows, 12, 1000) and "x y z" in {r[2] for r in got}
    stage = C.Staging(spark, "pairs-test")
    every = spark.sparkContext.broadcast(np.full(C.WORD_BITS // 8, 255, dtype=np.uint8))
    (held, bits), positions = C._frequent_pairs(stage, frame_rows, every, 7, 12, len(words))
    assert bits > 3 and positions == sum(words.count(p) for p in often)
    watched("en", texts, every.value, 7, 5, (held.value, bits))
    watched("en", texts, every.value, 7, 5)
    assert sent == [positions, len(words)] and positions < len(words) / 2
