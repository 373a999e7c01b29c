"""The pipeline's stages, each against brute force on its own input."""

import re
from collections import Counter
from pathlib import Path

import corpus_pipeline
import pytest
from llm_fixtures import frame
from test_dedup import brute_components
from test_decontaminate import brute as brute_hits

from clientele.llm.decontaminate import drop_contaminated
from clientele.llm.minhash_dedup import keep_first
from clientele.llm.mixing import mix_sources, take_mix
from clientele.llm.quality import fit_quality, score_quality
from clientele.llm.sharding import shard_documents
from clientele.llm.staging import Staging

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


TARGET = 60_000  # above the largest document


@pytest.fixture(scope="module")
def steps(spark):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(corpus_pipeline, "TARGET_BYTES", TARGET)
        yield run_steps(spark)


def run_steps(spark):
    stage = Staging(spark, "pipeline-test")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = {"documents": docs}
    for name, step in corpus_pipeline.STAGES:
        docs = out[name] = stage.put(step(spark, docs, SMALL), name)
    return out


def rows_of(df):
    return [tuple(r) for r in df.select(*COLUMNS).collect()]


def test_quality_keeps_what_scores_well(spark, steps):
    docs = steps["documents"]
    model = fit_quality(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    good = {r.doc_id for r in score_quality(docs, model).collect() if r.score >= 0.3}
    assert steps["quality"].columns == COLUMNS
    assert {r[0] for r in rows_of(steps["quality"])} == good
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    clean = [i for i, q in quality.items() if q == 1]
    assert sum(i in good for i in clean) >= 0.97 * len(clean)


def test_one_document_of_each_group_stays(steps):
    before, after = rows_of(steps["quality"]), rows_of(steps["near_dedup"])
    want = {i if n == 0 else c for i, n, c in brute_components(before)}
    assert sorted(r[0] for r in after) == sorted(want) and set(after) <= set(before)


def test_contaminated_documents_go(spark, steps):
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    before = rows_of(steps["near_dedup"])
    clean = [r for r, hit in zip(before, brute_hits(before, items)) if hit[2] == 0]
    assert sorted(map(str, rows_of(steps["decontaminate"]))) == sorted(map(str, clean))


def test_mix_takes_copies(steps):
    before = steps["decontaminate"]
    plan = {r.doc_id: r.copies for r in mix_sources(before).collect()}
    got = Counter(rows_of(steps["mix"]))
    assert got == Counter({r: plan[r[0]] for r in rows_of(before) if plan[r[0]]})
    words = lambda rows: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows)
    assert words(got.elements()) == pytest.approx(1.5 * words(rows_of(before)), rel=0.03)


def test_every_copy_has_its_slot(steps):
    shards = steps["shard"]
    assert shards.columns == [*COLUMNS, "shard", "slot"]
    assert Counter(rows_of(shards)) == Counter(rows_of(steps["mix"]))
    bytes_, slots = Counter(), {}
    for r in shards.collect():
        bytes_[r.shard] += len((r.text or "").encode()) + 1
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len(slots) == -(-sum(bytes_.values()) // TARGET) > 4
    largest = max(len((r[1] or "").encode()) for r in rows_of(shards))
    assert max(bytes_.values()) - min(bytes_.values()) < 3 * largest


@pytest.mark.parametrize("step", ["near_dedup", "decontaminate", "mix", "shard"])
def test_only_what_a_stage_returns_stays_staged(spark, step):
    """The tables behind it would add up over the stages; the rows are those of the whole job."""
    docs = frame(spark, [(i, f"w{i} and some more words {i % 7} {i // 2}", "en", f"s{i % 3}", 30) for i in range(60)])
    items = spark.createDataFrame([(1, "w4 and some more words 4 2")], "item_id long, text string")
    run = {"near_dedup": keep_first, "decontaminate": lambda d: drop_contaminated(d, items),
           "mix": take_mix, "shard": lambda d: shard_documents(d, shards=4)}[step]
    shared = Path(Staging(spark, "none").path.removeprefix("file:")).parent
    before = {*shared.iterdir(), shared / "tables"}  # tables: the sources' and values' ranks
    result = run(docs)
    new = set(shared.iterdir()) - before
    assert len(new) == 1 and sorted(p.name for p in new.pop().iterdir()) == sorted(
        ["numbered-rows", {"near_dedup": "chosen", "decontaminate": "hit", "mix": "copies", "shard": "places"}[step]])
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=merge" in plan  # memory does not grow with the rows, whatever their files' size
    want = Counter({i: 1 for i in range(60) if step != "decontaminate" or i != 4})
    if step == "mix":
        want = Counter({r.doc_id: r.copies for r in mix_sources(docs).collect() if r.copies})
    assert Counter(r.doc_id for r in result.collect()) == want
