"""Registered queries of the subpackage: each runs one operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.llm import oracle
from clientele.llm.collocations import collocations
from clientele.llm.decontaminate import decontaminate
from clientele.llm.exact_dedup import exact_dedup
from clientele.llm.labelled import held_out
from clientele.llm.minhash_dedup import near_duplicates
from clientele.llm.mixing import mix_sources
from clientele.llm.periodic_runs import periodic_runs, plant_runs
from clientele.llm.pii import find_personal_data
from clientele.llm.quality import THRESHOLD, fit_quality, score_quality
from clientele.llm.secret_scan import scan_secrets
from clientele.llm.sharding import kd_shards
from clientele.llm.staging import Staging, read_table
from clientele.llm.token_counts import TokenizerSpec, token_counts
from clientele.llm.toxicity import fit_toxicity, score_toxicity
from clientele.llm.warc import read_warc, write_warc

TOKEN_LIMIT = 2048
SHARDS = 8


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents")).drop("row_key")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, read_table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(read_table(spark, sf_dir, "documents"),
                          read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Staging(spark, "archives").path
    write_warc(read_table(spark, sf_dir, "pages"), path)
    return read_warc(spark, path, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards(read_table(spark, sf_dir, "documents"), shards=SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = fit_quality(docs, read_table(spark, sf_dir, "labels"))
    return score_quality(docs, model).withColumn("kept", F.col("score") >= THRESHOLD)


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", *_span_digest(("assign", "access", "hex")), "closed_layers")


def _span_digest(kinds: tuple[str, ...]) -> list[Column]:
    """Columns over ``findings``: counts of the base ones by kind, their hash, all spans."""
    base = F.filter("findings", lambda f: f["base"])

    def count(kind: str):
        return F.size(F.filter(base, lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(findings):
        return F.array_join(F.transform(findings, lambda f: F.concat_ws(
            ":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ",")

    return [*map(count, kinds), F.sha2(joined(base), 256).alias("base_sha256"),
            joined(F.col("findings")).alias("spans")]


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    spec = TokenizerSpec(public_tokenizers.path("word_bpe_49k.json"), by_piece=True)
    return token_counts(read_table(spark, sf_dir, "documents"), spec).withColumn(
        "over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", *_span_digest(("email", "ip", "card", "phone")))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(plant_runs(read_table(spark, sf_dir, "documents")))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")),
        F.lit("\n"))), "")
    best = F.col("strongest")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"),
        best["length"].alias("length"), best["period"].alias("period"),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_near_duplicates": op1_near_duplicates,
        "op2_toxicity": op2_toxicity,
        "op3_decontaminate": op3_decontaminate,
        "op4_warc": op4_warc,
        "op5_kd_shards": op5_kd_shards,
        "op6_quality": op6_quality,
        "op7_mix_sources": op7_mix_sources,
        "op8_secrets": op8_secrets,
        "op9_exact_dedup": op9_exact_dedup,
        "op10_token_counts": op10_token_counts,
        "op11_personal_data": op11_personal_data,
        "op12_periodic_runs": op12_periodic_runs,
        "op13_collocations": op13_collocations,
    }


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
