"""Exact and near duplicates against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import frame, sentence, shingles, with_odd_columns

from clientele.llm.components import connected_components
from clientele.llm.exact_dedup import ContentTable, exact_dedup, grace_aggregate
from clientele.llm.minhash_dedup import (BANDS, ROWS, keep_first, near_duplicates, set_digest,
                                         shingle_sets, sketches)
from clientele.llm.staging import Staging
from clientele.llm.words import NOT_SPACE, blocks


def squeezed(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def test_exact_dedup_matches_brute_force(docs, rows):
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(squeezed(t), []).append((-len(t or ""), i is None, i))
    found = exact_dedup(docs).collect()
    assert len(found) == len(rows)
    want = sorted((str(i), str(min(groups[squeezed(t)])[2]), len(groups[squeezed(t)]),
                   hashlib.sha256(squeezed(t).encode()).hexdigest()) for i, t, *_ in rows)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in found) == want
    for r in found:
        if r.kept:
            assert r.doc_id == r.keep_id


def test_exact_dedup_empty(no_docs):
    assert exact_dedup(no_docs).count() == 0


def grouped(rows, budget):
    out = {r[0]: tuple(r) for r in grace_aggregate(iter(rows), budget)}
    return out


def test_grace_recursion_gives_the_same_groups():
    rng = random.Random(1)
    rows = []
    for i in range(3000):
        text = "hot" if i % 3 == 0 else str(rng.randint(0, 400)) * 20
        rows.append((hashlib.sha256(text.encode()).hexdigest(), text, len(text), i, 1))
    whole = grouped(rows, 1 << 30)
    assert grouped(rows, 2_000) == whole       # several levels of spill files
    assert grouped(rows, 1) == whole           # buckets of one text
    assert sum(r[4] for r in whole.values()) == 3000


def test_table_refuses_equal_digests_of_different_texts():
    table = ContentTable()
    table.add(("0" * 64, "a", 1, 1, 1))
    with pytest.raises(ValueError):
        table.add(("0" * 64, "b", 1, 2, 1))


def brute_components(rows):
    sets = [shingles(t) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            k = len(sets[i] & sets[j])
            if k and 100 * k >= 75 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    smallest = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            smallest[root(i)] = min(smallest.get(root(i), r[0]), r[0])
    return [(r[0], len(sets[i]), smallest.get(root(i))) for i, r in enumerate(rows)]


def test_near_duplicates_match_brute_force(docs, rows):
    found = [(r.doc_id, r.n_shingles, r.component_id) for r in near_duplicates(docs).collect()]
    assert sorted(map(str, found)) == sorted(map(str, brute_components(rows)))


def crowd(seed=3):
    """Large buckets: a cluster of near copies, texts that share a long passage with it to
    every degree around the threshold, and chains of links."""
    rng = random.Random(seed)
    passage = sentence(rng, 80).split()
    texts = []
    for _ in range(120):
        copy = list(passage)
        for _ in range(rng.randint(0, 2)):
            copy[rng.randrange(80)] = "edit%d" % rng.randint(0, 999)
        texts.append(copy)
    for k in range(120):
        texts.append(passage + sentence(rng, 5 + k // 2).split())
    walk = sentence(rng, 90).split()
    for k in range(0, 80, 2):                  # neighbours are similar, ends are not
        texts.append(walk[k:] + [f"tail{j}" for j in range(k)])
    return [(i, " ".join(t), "en", "s", 1) for i, t in enumerate(texts)]


def test_near_duplicates_lose_no_link_in_large_buckets(spark):
    rows = crowd()
    found = [(r.doc_id, r.n_shingles, r.component_id) for r in
             near_duplicates(frame(spark, rows)).collect()]
    assert sorted(found) == sorted(brute_components(rows))


def test_keep_first_leaves_one_row_of_each_group(spark, docs, rows):
    kept = keep_first(docs)
    assert kept.columns == docs.columns
    found = [r.doc_id for r in kept.collect()]
    want = {c for i, n, c in brute_components(rows) if n} | {i for i, n, _ in brute_components(rows) if not n}
    assert sorted(map(str, set(found))) == sorted(map(str, want))
    assert found.count(0) == 1                 # the repeated row once


def test_keep_first_keeps_groups_whose_ids_are_null_or_repeat(spark):
    rng = random.Random(11)
    texts = [sentence(rng, 40) for _ in range(7)]
    near = texts[0] + " end"
    rows = [(None, texts[0], "en", "s", 1), (None, near, "en", "s", 1), (None, texts[1], "en", "s", 1),
            (None, texts[2], "en", "s", 1), (7, texts[3], "en", "s", 1), (7, texts[4], "en", "s", 1),
            (8, texts[5], "en", "s", 1), (None, texts[5], "en", "s", 1), (None, "", "en", "s", 1)]
    found = [(r.doc_id, r.text) for r in keep_first(frame(spark, rows)).collect()]
    first = [r for r in found if r[1] in (texts[0], near)]
    assert len(first) == 1
    assert sorted(map(str, found)) == sorted(map(str, [
        *first, (None, texts[1]), (None, texts[2]), (7, texts[3]), (7, texts[4]), (8, texts[5]), (None, "")]))


def test_keep_first_keeps_every_text_without_words(spark):
    rows = [(None, None, "en", "a", None), (None, "", "de", "b", 0), (None, "", "de", "b", 0),
            (None, " \n", "en", "a", 2), (4, "", "en", "a", 0), (4, "", "en", "a", 0), (5, "x y", "en", "a", 3)]
    found = keep_first(frame(spark, rows)).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, rows))


def test_keep_first_whatever_the_other_columns(spark, rows):
    docs = frame(spark, rows)
    odd = keep_first(with_odd_columns(docs))
    assert odd.columns == with_odd_columns(docs).columns
    assert sorted(map(str, odd.select(docs.columns).collect())) == sorted(
        map(str, keep_first(docs).collect()))
    assert {(r._row_key, r.row, r.doc) for r in odd.collect()} == {("x", "y", "z")}
    assert all(r.tags == {"a": r.doc_id} for r in odd.collect())


def test_near_duplicates_empty(no_docs):
    assert near_duplicates(no_docs).count() == 0


def test_connected_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201)]
    rng = random.Random(2)
    names = list(range(0, 400))
    rng.shuffle(names)
    df = spark.createDataFrame([(names[a], names[b]) for a, b in links], "a long, b long")
    found = {r.node: r.component for r in
             connected_components(Staging(spark, "test-components"), "t", df).collect()}
    for a, b in links:
        assert found[names[a]] == found[names[b]]
    assert len(set(found.values())) == 3


def test_more_links_continue_known_components(spark):
    """Links inside a component are no work; others join components and bring new nodes."""
    def frame_of(links):
        return spark.createDataFrame(links, "a long, b long")
    stage = Staging(spark, "test-more-links")
    first = [(i, i + 1) for i in range(20) if i % 5 != 4]
    known = connected_components(stage, "first", frame_of(first))
    assert connected_components(stage, "none", frame_of([(0, 4), (7, 5), (9, 9)]), known) is known
    more = [(4, 17), (3, 0), (30, 8), (40, 41), (41, 42), (17, 31)]
    found = {r.node: r.component for r in connected_components(stage, "more", frame_of(more), known).collect()}
    whole = {r.node: r.component for r in connected_components(stage, "whole", frame_of(first + more)).collect()}
    assert found.keys() == whole.keys()
    assert len(set(found.values())) == len(set(whole.values())) == len({(found[n], whole[n]) for n in found}) == 4


def batch_sets(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    return [s for _, w in blocks(batch, "text", NOT_SPACE, 1000) for s in shingle_sets(w)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\tÉé 中", max_size=60), min_size=1, max_size=8))
def test_shingle_sets_count_like_brute_force(texts):
    assert [len(s) for s in batch_sets(texts)] == [len(shingles(t)) for t in texts]
    a, b = batch_sets(texts), batch_sets([t.replace("\n", " \t") for t in texts])
    assert [set_digest(x) for x in a] == [set_digest(x) for x in b]


def test_sketches_fill_every_coordinate_and_estimate_similarity():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    other = base.copy()
    other[:100] = rng.integers(0, 1 << 63, 100, dtype=np.uint64)
    t = ROWS * BANDS
    s = sketches([np.unique(base), np.unique(other), base[:1], np.unique(base[:3])], t)
    assert (s != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
    assert abs((s[0] == s[1]).mean() - 300 / 500) < 0.12
    alone = sketches([np.unique(base[:3])], t)
    assert (alone[0] == s[3]).all()            # independent of the other sets of a block
