import random
import re
import time
import zlib
from collections import Counter, defaultdict

import pytest
from llm_fixtures import frame, sentence, with_odd_columns
from pyspark.sql import functions as F

from clientele.llm import mixing
from clientele.llm.mixing import mix_sources, source_targets, take_mix
from clientele.llm.selection import crossing_keys
from clientele.llm.sharding import TIE_BITS, kd_shards, shard_documents
from clientele.llm.staging import CLEANUP, Staging, dropped_after, row_key


def n_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def water_fill(sizes):
    """sizes: source -> tokens; the law, by repeated sharing of the excess."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    budget, fixed = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        if not free:
            return fixed
        rest = budget - sum(fixed.values())
        want = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if want[s] > 2 * sizes[s]]
        if not over:
            return fixed | want
        fixed |= {s: 2.0 * sizes[s] for s in over}


def corpus(n=400, seed=4):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = "hot" if i % 3 == 0 else rng.choice(["a", "b", "É", "z", None, "empty"])
        text = None if source == "empty" else sentence(rng, int(rng.lognormvariate(3, 1)))
        rows.append((i, text, "en", source, 1))
    return rows


def test_mix_meets_targets(spark):
    rows = corpus()
    found = mix_sources(frame(spark, rows, clashing=True)).collect()
    sizes = Counter()
    for _, t, _, s, _ in rows:
        sizes[s] += n_words(t)
    want = water_fill(sizes)
    taken, by_id = Counter(), {r[0]: r for r in rows}
    for r in found:
        assert r.size == n_words(by_id[r.doc_id][1]) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], rel=1e-9, abs=1e-6)
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    for s, t in want.items():
        assert taken[s] <= t + 1e-6 and taken[s] >= 0.97 * t - 5, (s, taken[s], t)
    again = mix_sources(frame(spark, rows).repartition(7)).collect()
    assert sorted((r.doc_id, r.copies) for r in again) == sorted((r.doc_id, r.copies) for r in found)


def test_rates_solve_the_dual(spark):
    """Rates are exponential tilts of size, capped, and meet the constraint exactly."""
    found = mix_sources(frame(spark, corpus())).collect()
    by = defaultdict(list)
    for r in found:
        if r.size:
            by[r.source].append(r)
    for own in by.values():
        assert sum(r.rate * r.size for r in own) == pytest.approx(own[0].target, rel=1e-4)
        tilts = {round(__import__("math").log(r.rate) / r.size, 7) for r in own if r.rate < 2 - 1e-9}
        assert len(tilts) <= 1 or max(tilts) - min(tilts) < 1e-6


def test_take_mix_repeats_rows(spark, docs, rows):
    plan = Counter()
    for r in mix_sources(docs).collect():
        plan[str((r.doc_id, r.source))] += r.copies
    mixed = take_mix(docs)
    assert mixed.columns == docs.columns
    got = Counter(str((r.doc_id, r.source)) for r in mixed.collect())
    assert got == Counter({k: v for k, v in plan.items() if v})


def test_mix_empty(spark, no_docs):
    assert mix_sources(no_docs).count() == 0
    nothing = frame(spark, [(1, None, "en", "a", 0), (2, "", None, None, None)])
    assert [(r.target, r.taken) for r in mix_sources(nothing).collect()] == [(0.0, 0), (0.0, 0)]


def test_source_targets_many_sources(spark):
    sizes = {f"s{i:02d}": (i * 37) % 100 + 1 for i in range(40)}
    df = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, tokens long")
    got = {r.source: r.target for r in source_targets(df, (5.0, 2.0, 1.0), 1.5, 2.0).collect()}
    want = water_fill(sizes)
    assert all(got[s] == pytest.approx(want[s]) for s in sizes)


def test_crossing_keys(spark):
    rng = random.Random(8)
    data = [(g, rng.randint(-5, 5) * 10 ** rng.randint(0, 17), rng.randint(0, 9)) for g in (1, 2)
            for _ in range(300)]
    goals = [(g, t, float(goal)) for g in (1, 2) for t, goal in enumerate((0, 1, 500.5, 900, 1e9))]
    got = {(r.g, r.target): r for r in crossing_keys(
        Staging(spark, "test-selection"), "x", spark.createDataFrame(data, "g int, key long, w long"),
        spark.createDataFrame(goals, "g int, target int, goal double")).collect()}
    for g, t, goal in goals:
        rows = sorted((k, w) for x, k, w in data if x == g)
        before, cut = 0, None
        for k in sorted({k for k, _ in rows}):
            here = sum(w for x, w in rows if x == k)
            if before + here > goal:
                cut = k
                break
            before += here
        if cut is None:
            assert (g, t) not in got
        else:
            assert (got[g, t].cut, got[g, t].before) == (cut, before)


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_crossing_keys_shuffle_twice_a_pass(spark, monkeypatch):
    """What the driver keeps of a query grows with its shuffles; groups without goal or null stay out."""
    plans, put = [], Staging.put
    monkeypatch.setattr(Staging, "put", lambda self, df, *a: plans.append(executed(df)) or put(self, df, *a))
    rows = spark.createDataFrame([(1, 3, 2), (1, 5000, 4), (1, 9000, 1), (2, 7, 9), (None, 1, 1)],
                                 "g int, key long, w long")
    goals = spark.createDataFrame([(1, 0, 2.0), (1, 1, 6.5), (None, 0, 0.5)], "g int, target int, goal double")
    got = crossing_keys(Staging(spark, "test-shuffles"), "x", rows, goals, 24).collect()
    assert sorted((r.g, r.target, r.cut, r.before, r.at_cut) for r in got) == [
        (1, 0, 5000, 2.0, 4.0), (1, 1, 9000, 6.0, 1.0)]
    assert len(plans) == 2 and max(p.count("Exchange hashpartitioning") for p in plans) == 2


def test_source_targets_number_the_sources_once(spark):
    """Every step of the level reads a staged table, not the numbering again."""
    df = spark.createDataFrame([("a", 10), (None, 5), ("b", 0)], "source string, tokens long")
    found = source_targets(df, (5.0, 2.0, 1.0), 1.5, 2.0)
    assert "Window" not in executed(found) and "Exchange" not in executed(found)
    assert {(r.source, r.weight) for r in found.collect()} == {("a", 5.0), ("b", 2.0), (None, 1.0)}


def test_shards_are_even_and_gapless(spark):
    rng = random.Random(6)
    rows = [(i, sentence(rng, rng.randint(1, 200)), rng.choice(["en", "de", None]),
             "hot" if i % 3 else rng.choice("abcd"), rng.randint(0, 1000)) for i in range(600)]
    rows += [(1000 + i, "copy " * 30, "en", "hot", 5) for i in range(300)]
    found = kd_shards(frame(spark, rows, clashing=True), shards=8).collect()
    text = {r[0]: r[1].encode() for r in rows}
    bytes_, slots = Counter(), defaultdict(list)
    for r in found:
        assert r.size == len(text[r.doc_id]) + 1 and r.text_crc32 == zlib.crc32(text[r.doc_id])
        bytes_[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert set(bytes_) == set(range(8)) and len(found) == len(rows)
    assert max(bytes_.values()) - min(bytes_.values()) < 3 * max(map(len, text.values()))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_split_texts_with_a_common_beginning(spark):
    rows = [(i, "x" * 99, "en", f"https://site{i % 4}.example", 1) for i in range(400)]
    source = {r[0]: r[3] for r in rows}
    found = Counter((r.shard, source[r.doc_id]) for r in
                    kd_shards(frame(spark, rows), dims=("source",), shards=4).collect())
    assert sum(n for n in found.values() if n >= 98) >= 392


@pytest.mark.parametrize("shards", [1, 3])
def test_shards_of_awkward_rows(docs, rows, shards):
    found = shard_documents(docs, shards=shards)
    assert sorted(set(found.columns)) == sorted(docs.columns)
    got = found.collect()
    assert sorted(str((r.doc_id, r.text, r.source)) for r in got) == sorted(
        str((r[0], r[1], r[3])) for r in rows)
    for s in {r.shard for r in got}:
        own = [r.slot for r in got if r.shard == s]
        assert sorted(own) == list(range(len(own)))


def test_shards_by_target_bytes_and_empty(spark, no_docs):
    rows = [(i, "x" * 99, "en", "s", 1) for i in range(64)]
    found = kd_shards(frame(spark, rows), target_bytes=800).collect()
    assert Counter(Counter(r.shard for r in found).values()) == {8: 8}
    assert kd_shards(no_docs, shards=8).count() == 0


def brute_tree(rows, leaves):
    """rows: (name, size, tie, values); name -> leaf, splitting one node after the other."""
    wide = [max(1, max(r[3][d] for r in rows) - min(r[3][d] for r in rows)) for d in range(len(rows[0][3]))]
    out, nodes = {}, [(0, leaves, rows)]
    while nodes:
        first, k, own = nodes.pop()
        if k == 1 or not own:
            out |= {r[0]: first for r in own}
            continue
        spread = [(max(r[3][d] for r in own) - min(r[3][d] for r in own)) / w for d, w in enumerate(wide)]
        d = spread.index(max(spread))
        own = sorted(own, key=lambda r: (r[3][d], r[2]))
        goal, before, at = sum(r[1] for r in own) * (k // 2) / k, 0, 0
        while before + own[at][1] <= goal:
            before, at = before + own[at][1], at + 1
        at += before + own[at][1] - goal < goal - before
        nodes += [(first, k // 2, own[:at]), (first + k // 2, k - k // 2, own[at:])]
    return out


@pytest.mark.parametrize("leaves", [1, 5, 8])
def test_tree_equals_brute_force(spark, leaves):
    rng = random.Random(leaves)
    rows = [(i, sentence(rng, rng.randint(0, 60)), rng.choice(["en", "de", None]),
             "hot" if i % 3 == 0 else rng.choice(["a", "É", "z"]), rng.choice([None, -5, 0, 7, rng.randint(-99, 999)]))
            for i in range(300)]
    docs = frame(spark, rows).withColumn("ratio", F.col("doc_id") % 7 / 10)
    ties = {r.doc_id: r.tie for r in docs.select("doc_id", row_key("doc_id", "text").bitwiseAND(
        F.lit((1 << TIE_BITS) - 1)).alias("tie")).collect()}

    def ranks(values):
        order = {v: i for i, v in enumerate(sorted(set(values) - {None}), 1)}
        return [order.get(v, 0) for v in values]
    least = min(r[4] for r in rows if r[4] is not None)
    dims = zip(ranks([r[2] for r in rows]), ranks([r[3] for r in rows]),
               [0 if r[4] is None else r[4] - least + 1 for r in rows], ranks([r[0] % 7 / 10 for r in rows]))
    want = brute_tree([(r[0], len(r[1].encode()) + 1, ties[r[0]], v) for r, v in zip(rows, dims)], leaves)
    found = kd_shards(docs, ("lang", "source", "n_chars", "ratio"), shards=leaves).collect()
    assert {r.doc_id: r.shard for r in found} == want


def test_fractions_and_extreme_numbers_split(spark):
    rows = [(i, "x" * 9, "en", "s", (-(1 << 63), 0, (1 << 63) - 1, None)[i % 4]) for i in range(80)]
    found = {r.doc_id: r.shard for r in kd_shards(frame(spark, rows), ("n_chars",), shards=4).collect()}
    for value, shard in ((3, 0), (0, 1), (1, 2), (2, 3)):   # null first
        assert {s for i, s in found.items() if i % 4 == value} == {shard}
    part = frame(spark, rows).withColumn("part", F.col("doc_id") % 2 / 4)
    found = {r.doc_id: r.shard for r in kd_shards(part, ("part",), shards=2).collect()}
    assert all(s == i % 2 for i, s in found.items())


def test_leaves_are_near_the_target(spark):
    rng = random.Random(9)
    rows = [(i, sentence(rng, rng.randint(1, 40)), "en", "hot" if i % 3 else rng.choice("abc"), rng.randint(0, 99))
            for i in range(900)]
    sizes = Counter()
    for r in kd_shards(frame(spark, rows), target_bytes=6000).collect():
        sizes[r.shard] += r.size
    assert len(sizes) == -(-sum(sizes.values()) // 6000)
    longest = max(len(r[1]) + 1 for r in rows)
    assert all(abs(n - 6000) < 3 * longest + 6000 / len(sizes) for n in sizes.values())


def test_mix_and_shards_whatever_the_other_columns(spark, docs, rows):
    docs = frame(spark, rows)
    odd = with_odd_columns(docs)
    mixed, plain = take_mix(odd), take_mix(docs)
    assert mixed.columns == odd.columns
    assert Counter(map(str, mixed.select(docs.columns).collect())) == Counter(map(str, plain.collect()))
    placed = shard_documents(odd, shards=3)
    assert placed.columns == [*odd.columns, "shard", "slot"]
    got = placed.collect()
    assert Counter(str(tuple(r[c] for c in docs.columns)) for r in got) == Counter(map(str, map(tuple, rows)))
    assert len({(r.shard, r.slot) for r in got}) == len(rows)
    assert {(r._row_key, r.doc, r.copies) for r in got} == {("x", "z", "c")}


def test_mix_tells_of_sources_that_do_not_converge(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_STEPS", 1)
    with pytest.warns(UserWarning, match="did not meet their target within 1 "):
        mix_sources(frame(spark, corpus()))


def test_staged_tables_go_also_after_an_error(spark):
    import os

    kept = Staging(spark, "test-kept")
    kept.put(spark.range(3), "t")
    with pytest.raises(KeyError), dropped_after():
        gone = Staging(spark, "test-gone")
        gone.put(spark.range(3), "t")
        raise KeyError
    exists = lambda s: os.path.exists(s.path.removeprefix("file:"))
    assert exists(kept) and not exists(gone)


def test_shards_keep_no_table_of_an_earlier_level(spark):
    """Of the staged tables with a row per document, only the last is left when the tree is done."""
    from pathlib import Path

    docs = spark.createDataFrame([(i, "t" * (i % 50), f"s{i % 3}", "en", i % 50) for i in range(400)],
                                 "doc_id long, text string, source string, lang string, n_chars long")
    placed = kd_shards(docs, shards=8)
    assert sorted(r.slot for r in placed.where("shard = 0").collect()) == list(range(placed.where("shard = 0").count()))
    assert placed.count() == 400
    folder = Path(placed.inputFiles()[0].removeprefix("file://")).parent.parent
    tables = [t for t in folder.iterdir() if spark.read.parquet(str(t)).count() == 400]
    assert [t.name for t in tables] == ["placed"]


def test_shuffles_behind_a_staged_table_go(spark):
    """Their files would add up over the tables of a job."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return {n for n in disk.getAllFiles().mkString("\n").split("\n") if "shuffle_" in n}
    before, setting = shuffles(), spark.conf.get(CLEANUP, None)
    stage = Staging(spark, "cleanup-test")
    for k in range(2):
        put = stage.put(spark.range(1000).repartition(3).groupBy((F.col("id") % 7).alias("k")).count(), f"t{k}")
        assert sum(r[0] for r in put.select("count").collect()) == 1000
    deadline = time.time() + 20  # files go in the background
    while shuffles() - before and time.time() < deadline:
        time.sleep(0.2)
    assert not shuffles() - before
    assert spark.conf.get(CLEANUP, None) == setting
