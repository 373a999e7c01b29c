"""Periodic runs against a search over all periods."""

import hashlib
import random
import re
import time
import zlib

import pytest
from llm_fixtures import frame

from clientele.llm import queries
from clientele.llm.periodic_runs import find_runs, periodic_runs, plant_runs, strongest, word_names

SMALL = "/root/testdata/sf0.001"


def brute_runs(words: list) -> list[tuple]:
    """All periods tried; of equal stretches the smallest period counts."""
    n, period_of = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                period_of.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, length, q) for (s, length), q in period_of.items())


def found_runs(texts: list[list]) -> list[list[tuple]]:
    names, first = word_names(texts)
    runs = list(zip(*(x.tolist() for x in find_runs(names))))
    return [[(s - lo, n, q) for s, n, q in runs if lo <= s < hi] for lo, hi in zip(first, first[1:])]


@pytest.mark.parametrize("seed", range(6))
def test_runs_match_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(1, 4)):
            n, letters = rng.randint(0, 70), rng.randint(1, 4)
            words = [b"%d" % rng.randrange(letters) for _ in range(n)]
            if n and rng.random() < 0.6:
                a = rng.randrange(n)
                p = rng.randint(1, max(1, (n - a) // 4))
                words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
                if rng.random() < 0.3:
                    words[rng.randrange(n)] = b"x"
            texts.append(words)
        assert found_runs(texts) == [brute_runs(w) for w in texts]


def test_known_runs():
    assert found_runs([[b"a"] * 6, [b"a"] * 5, [b"a", b"b"] * 4, [b"a", b"b"] * 3 + [b"a"], []]) == [
        [(0, 6, 1)], [], [(0, 8, 2)], [], []]
    # a run of runs: (aab aab aab aab) and its doubled word
    assert found_runs([[b"a", b"a", b"b"] * 5]) == [[(0, 15, 3)]]
    # equal words in neighbouring texts are no run
    assert found_runs([[b"a"] * 3, [b"a"] * 3]) == [[], []]


def test_strongest_is_exact():
    big = 10**17
    assert strongest([(0, 4 * big + 1, big), (1, 4 * big + 2, big), (2, 8, 2)]) == (1, 4 * big + 2, big)
    assert strongest([(3, 8, 2), (0, 16, 4)]) == (3, 8, 2) and strongest([]) is None


def test_long_texts_take_linear_time():
    rng = random.Random(1)
    for words in ([b"a"] * 300_000, [b"a", b"b", b"c"] * 100_000, [b"%d" % rng.randrange(2) for _ in range(300_000)]):
        began = time.perf_counter()
        found_runs([words])
        assert time.perf_counter() - began < 10


def planted(doc_id, text) -> list[str]:
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def kept_words(words, runs):
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    return [w for i, w in enumerate(words) if i not in dropped]


def test_planting(spark, docs, rows):
    want = sorted((str(r[0]), planted(r[0], r[1])) for r in rows)
    got = sorted((str(r.doc_id), re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in plant_runs(docs).collect())
    assert got == want
    many = [(i, "a b c d e f g h i j\tk l", None, None, None) for i in range(300)]
    for r in plant_runs(frame(spark, many, clashing=True)).collect():
        assert re.findall(r"[^\x20\x09-\x0D]+", r.text) == planted(r.doc_id, many[0][1])


def test_rows(spark, docs, rows, no_docs):
    found = periodic_runs(docs).collect()
    text = {r[0]: r[1] for r in rows if r[0] is not None}
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id is None:
            continue
        words = (text[r.doc_id] or "").encode().split()
        runs = [tuple(x) for x in r.runs]
        assert r.n_words == len(words)
        if len(words) < 2000:
            assert runs == brute_runs(words)
        assert r.collapsed.encode() == b" ".join(kept_words(words, runs))
        assert (r.strongest is None) == (not runs)
    assert any(r.runs for r in found)
    assert periodic_runs(no_docs).count() == 0


def test_query_matches_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    found = queries.op12_periodic_runs(spark, SMALL).collect()
    assert len(found) == len(docs) and any(r.n_runs for r in found)
    for r in found:
        words = planted(r.doc_id, docs[r.doc_id])
        if len(words) > 3000:
            continue  # the search over all periods would take minutes
        runs = brute_runs(words)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert r.n_runs == len(runs)
        assert r.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(kept_words(words, runs)).encode()).hexdigest()
        best = max(runs, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=(None,) * 3)
        assert (r.start, r.length, r.period) == best
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
