"""Registered queries: against SQL where there is some, and the contracts' columns."""

import zlib

import pytest
from oracle_compare import run

import __spark_entry__ as entry
from clientele.llm import queries

SMALL = "/root/testdata/sf0.001"


def test_queries_with_sql_match(spark):
    found = run(spark, SMALL, list(queries.oracle_sql()), verbose=False)
    assert found and set(found.values()) == {"MATCH"}, found


def test_every_operator_is_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.queries())
    assert numbers == list(range(1, 14)) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name,columns", [
    ("op2_toxicity", {"doc_id", "held_out", "score", "predicted"}),
    ("op5_kd_shards", {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"}),
    ("op7_mix_sources", {"doc_id", "size", "source_size", "target", "taken"}),
    ("op8_secrets", {"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"}),
    ("op10_token_counts", {"doc_id", "n_bytes", "n_tokens", "over_limit"}),
])
def test_contract_columns(spark, name, columns):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = queries.queries()[name](spark, SMALL).collect()
    assert columns <= set(rows[0].asDict()) and len(rows) == docs.count()
    if name == "op2_toxicity":
        for r in rows:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
            assert r.predicted == int(r.score >= 0.5)
    if name == "op10_token_counts":
        import public_tokenizers
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
        text = {r.doc_id: r.text or "" for r in docs.collect()}
        ids = sorted(text)
        want = {i: len(e.ids) for i, e in zip(ids, t.encode_batch([text[i] for i in ids],
                                                                  add_special_tokens=False))}
        assert {r.doc_id: r.n_tokens for r in rows} == want
        assert all(r.over_limit == (r.n_tokens > 2048) for r in rows)
