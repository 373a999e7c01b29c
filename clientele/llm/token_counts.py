"""Token counts with a digest cache.

The cache is a Parquet table of (content digest, tokenizer digest) -> n_tokens. A run
digests the normalised content of every row, looks the pairs up, encodes one text per
distinct missing digest, appends the new counts to the cache and answers every row from
it. The tokenizer digest covers the vocabulary file, the library's version and the
normalisation, so a changed tokenizer never reads old counts.

Method details. ``word_bpe`` tokenizers split at white space before anything else and
drop it, so runs of white space are collapsed for the digest, and a text's count is the
sum over its white-space separated pieces (added special tokens hold no white space and
are found inside a piece as in a whole text). Pieces repeat much more than texts do, but
most different ones come only once: a worker hands those of a text that it meets first to
the library as one string, which costs half as much, and counts a piece on its own when it
comes again, for a bounded memo. Other tokenizers get whole texts and an unchanged content.

Scale. Texts are normalised and digested once, into a staged table of a few numbers per row.
Duplicates are found there; only one text per missing digest is
shuffled and encoded, so a group of copies with a third of all rows is encoded once. The
answer joins narrow rows with the written cache, between two plain shuffles that Spark
can split when one digest is hot.

Defined results. Null text: empty, 0 tokens. Very long texts: whole, never truncated.
Repeated rows: one result row each. Empty table: empty result, cache unchanged. Extra
columns: ignored, whatever their names. Two runs that append the same digest at once add
equal rows; lookups take each digest once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.llm.staging import Staging, row_key
from clientele.llm.workers import tidy

CACHE_SCHEMA = "digest binary, tokenizer binary, n_tokens long"
MEMO_PIECES = 600_000
MET_BITS = 24  # a byte each; different pieces on one byte only get into the memo earlier
AT_ONCE, JOINED = 4096, 64  # pieces of a call to the library, and of a joined string in it
# a single space stays as it is, and is not matched: most runs are one
WHITE_SPACE_RUN = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class TokenizerSpec:
    """A vocabulary file and how to read it. ``by_piece``: counts add up over pieces
    separated by white space (only for tokenizers that drop white space)."""

    path: str
    by_piece: bool = False

    def digest(self) -> bytes:
        import sentencepiece
        import tokenizers

        with open(self.path, "rb") as f:
            content = hashlib.sha256(f.read()).hexdigest()
        library = (f"sentencepiece {sentencepiece.__version__}" if self.path.endswith(".model")
                   else f"tokenizers {tokenizers.__version__}")
        return hashlib.sha256(f"{library}|{content}|{self.by_piece}".encode()).digest()

    def normalised(self, text: Column) -> Column:
        text = F.coalesce(text, F.lit(""))
        return F.trim(F.regexp_replace(text, WHITE_SPACE_RUN, " ")) if self.by_piece else text

    def counter(self):
        """A function from a list of texts to their token counts."""
        if self.path.endswith(".model"):
            import sentencepiece

            processor = sentencepiece.SentencePieceProcessor(model_file=self.path)
            return lambda texts: [len(x) for x in processor.encode(texts, num_threads=1)]
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(self.path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return lambda texts: [len(x) for x in
                              tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


# Per worker process: the loaded tokenizer, its memo of pieces and the marks of those met.
_LOADED: dict = {}


def _loaded(spec: TokenizerSpec):
    if spec not in _LOADED:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task owns one core
        _LOADED.clear()
        _LOADED[spec] = (spec.counter(), {}, bytearray(1 << MET_BITS if spec.by_piece else 0))
    return _LOADED[spec]


def count_texts(spec: TokenizerSpec, texts: list[str]) -> list[int]:
    count, memo, met = _loaded(spec)
    if not spec.by_piece:
        return count(texts)
    if len(memo) > MEMO_PIECES:
        memo.clear()
        met[:] = bytes(len(met))
    split = [t.split(" ") for t in texts]
    new = [[p for p in pieces if p not in memo] for pieces in split]
    mask = len(met) - 1
    again = list({p for pieces in new for p in pieces if met[hash(p) & mask]})
    for lo in range(0, len(again), AT_ONCE):
        memo.update(zip(again[lo:lo + AT_ONCE], count(again[lo:lo + AT_ONCE])))
    totals = [sum(map(memo.get, pieces, repeat(0))) for pieces in split]
    joined, owners = [], []
    for i, pieces in enumerate(new):
        first = [p for p in pieces if p not in memo]
        for p in first:
            met[hash(p) & mask] = 1
        for lo in range(0, len(first), JOINED):
            joined.append(" ".join(first[lo:lo + JOINED]))
            owners.append(i)
    step = AT_ONCE // JOINED
    for lo in range(0, len(joined), step):
        for i, n in zip(owners[lo:lo + step], count(joined[lo:lo + step])):
            totals[i] += n
    return totals


def _encode(spec: TokenizerSpec):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                digests = part.column(0).to_pylist()
                # repeated rows arrive side by side; one of them is encoded
                fresh = [i for i, d in enumerate(digests) if d != (digests[i - 1] if i else last)]
                last = digests[-1]
                part = part.take(pa.array(fresh, pa.int64()))
                counts = count_texts(spec, part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts, pa.int64())], names=["digest", "n_tokens"])
    return run


def cached_counts(spark: SparkSession, cache_path: str, tokenizer: bytes) -> DataFrame:
    """digest, n_tokens of one tokenizer; empty when there is no cache yet."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(cache_path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hadoop):
        return spark.createDataFrame([], "digest binary, n_tokens long")
    return (spark.read.schema(CACHE_SCHEMA).parquet(cache_path)
            .where(F.col("tokenizer") == F.lit(bytearray(tokenizer)))
            .select("digest", "n_tokens"))


def token_counts(docs: DataFrame, spec: TokenizerSpec, cache_path: str | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_bytes (UTF-8), n_tokens. New counts are appended to ``cache_path``.

    Without ``cache_path`` the run gets a cache of its own in the shared folder.
    """
    spark = docs.sparkSession
    cache_path = cache_path or Staging(spark, "token-cache").path
    tokenizer = spec.digest()
    content = spec.normalised(F.col(text_col))
    digest = F.unhex(F.sha2(content, 256))
    stage = Staging(spark, "token-counts")
    rows = stage.put(docs.select(
        F.col(id_col).alias("row_id"), row_key(id_col, text_col).alias("row"), digest.alias("digest"),
        F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_bytes")), "rows")
    known = cached_counts(spark, cache_path, tokenizer)
    misses = (rows.groupBy("digest").agg(F.min("row").alias("row"))
              .join(known, "digest", "left_anti"))
    texts = docs.select(row_key(id_col, text_col).alias("row"), content.alias("content"))
    # the digest says which text is meant, should two rows share a key
    chosen = (misses.join(texts, "row").select("digest", "content")
              .where(F.unhex(F.sha2("content", 256)) == F.col("digest")))
    fresh = (chosen.mapInArrow(tidy(_encode(spec)), "digest binary, n_tokens long")
             .dropDuplicates(["digest"])  # repeated rows bring their text more than once
             .withColumn("tokenizer", F.lit(bytearray(tokenizer))))
    (fresh.select("digest", "tokenizer", "n_tokens")
     .write.mode("append").option("compression", "zstd").parquet(cache_path))
    # concurrent runs may have appended a digest twice; staged, so that a digest that many
    # rows share can be split in the join
    counts = stage.put(cached_counts(spark, cache_path, tokenizer).groupBy("digest")
                       .agg(F.max("n_tokens").alias("n_tokens")), "counts")
    return rows.join(counts, "digest").select(F.col("row_id").alias(id_col), "n_bytes", "n_tokens")
