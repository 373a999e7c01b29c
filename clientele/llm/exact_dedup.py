"""Exact deduplication by Grace hashing.

Texts are equal when they are identical after deleting every white-space character
(space and U+0009 to U+000D). Of equal texts, the row with the most code points in its
original text stays; among those, the one with the smallest id.

Method. Every input partition first aggregates its own rows, then the partial rows are
shuffled by the digest of the normalised text and aggregated once more. Both steps run
the same Grace scheme inside a task: rows go into an open-addressing table that compares
complete contents; when the table outgrows its budget, the task deals the rows to spill
files by further digest bits and treats each file by itself, recursively, until a bucket
fits. Spill files live in the task's temporary folder, are read only by that task and are
removed with it, so a lost executor costs a rerun of the task and nothing else.

Scale. Texts cross the network once, and a group of copies that holds a third of all rows
sends one row per input partition, because the first aggregation runs before the shuffle.
Memory per task is the table's budget plus one Arrow batch. The final join of all rows
with the surviving groups is on narrow rows and between two plain shuffles, so Spark may
split a hot digest.

Defined results. Null text: treated as empty; all empty texts (and texts of white space
only) are one group. Null id: sorts after every other id. Repeated rows with one id:
each counts towards the group's size, and each copy of the surviving (id, length) is
flagged as kept. Empty table: empty result. Extra columns: ignored, whatever their names.
"""

from __future__ import annotations

import pickle
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.llm.staging import Staging
from clientele.llm.workers import tidy

WHITE_SPACE = " \t\n\x0b\x0c\r"
SPILL_FILES = 16
DIGEST_HEX_DIGITS = 64

PARTIAL = "digest string, content string, best_len long, best_id long, size long"


def normalised(text: Column) -> Column:
    """The text without white space; null becomes empty."""
    return F.translate(F.coalesce(text, F.lit("")), WHITE_SPACE, "")


class ContentTable:
    """Open addressing with linear probing; a slot matches only on the complete content."""

    def __init__(self) -> None:
        self.rows: list[list] = []
        self.bytes = 0
        self._slots = [-1] * 64

    def _slot(self, digest: str, content: str, slots: list[int]) -> int:
        mask = len(slots) - 1
        at = int(digest[-12:], 16) & mask
        while slots[at] >= 0:
            row = self.rows[slots[at]]
            if row[0] == digest:
                if row[1] != content:
                    raise ValueError(f"two texts share the SHA-256 digest {digest}")
                return at
            at = (at + 1) & mask
        return at

    def add(self, row) -> None:
        digest, content, length, row_id, size = row
        at = self._slot(digest, content, self._slots)
        if self._slots[at] >= 0:
            held = self.rows[self._slots[at]]
            if precedes(length, row_id, held[2], held[3]):
                held[2], held[3] = length, row_id
            held[4] += size
            return
        self._slots[at] = len(self.rows)
        self.rows.append([digest, content, length, row_id, size])
        self.bytes += len(content) + 200
        if 2 * len(self.rows) > len(self._slots):
            self._grow()

    def _grow(self) -> None:
        slots = [-1] * (2 * len(self._slots))
        for i, row in enumerate(self.rows):
            slots[self._slot(row[0], row[1], slots)] = i
        self._slots = slots


def precedes(length: int, row_id: int | None, other_length: int, other_id: int | None) -> bool:
    """More code points first, then the smaller id; null ids last."""
    if length != other_length:
        return length > other_length
    if row_id is None or other_id is None:
        return row_id is not None and other_id is None
    return row_id < other_id


def grace_aggregate(rows: Iterable, budget: int, level: int = 0) -> Iterator[list]:
    """One row per distinct content. ``level`` counts the digest digits already used."""
    rows = iter(rows)
    table = ContentTable()
    for row in rows:
        table.add(row)
        if table.bytes > budget and len(table.rows) > 1 and level < DIGEST_HEX_DIGITS:
            break
    else:
        yield from table.rows
        return
    with tempfile.TemporaryDirectory(prefix="grace-") as folder:
        names = [f"{folder}/{i}" for i in range(SPILL_FILES)]
        files = [open(name, "wb") for name in names]
        try:
            for source in (table.rows, rows):
                for row in source:
                    pickle.dump(row, files[int(row[0][level], 16)], pickle.HIGHEST_PROTOCOL)
        finally:
            for f in files:
                f.close()
        del table
        for name in names:
            yield from grace_aggregate(_read_spill(name), budget, level + 1)


def _read_spill(name: str) -> Iterator:
    with open(name, "rb") as f:
        while True:
            try:
                yield pickle.load(f)
            except EOFError:
                return


def _batches(rows: Iterable, columns: list[tuple[str, pa.DataType, int]],
             max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[1]) + 100
        if size > max_bytes:
            yield _batch(held, columns)
            held, size = [], 0
    if held:
        yield _batch(held, columns)


def _batch(rows: list, columns: list[tuple[str, pa.DataType, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for _, t, i in columns],
                                      names=[n for n, _, _ in columns])


def _task(budget: int, with_content: bool):
    columns = [("digest", pa.string(), 0), ("content", pa.string(), 1),
               ("best_len", pa.int64(), 2), ("best_id", pa.int64(), 3), ("size", pa.int64(), 4)]
    if not with_content:
        columns = [c for c in columns if c[0] != "content"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for b in batches:
                for lo in range(0, b.num_rows, 512):
                    yield from zip(*(c.to_pylist() for c in b.slice(lo, 512).columns))
        yield from _batches(grace_aggregate(rows(), budget), columns)
    return run


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     memory_bytes: int = 64 << 20) -> DataFrame:
    """One row per distinct normalised text: digest, best_len, best_id, size.

    ``memory_bytes`` bounds the contents that one task holds in its table.
    """
    text = F.col(text_col)
    records = docs.select(
        F.sha2(normalised(text), 256).alias("digest"), normalised(text).alias("content"),
        F.length(F.coalesce(text, F.lit(""))).cast("long").alias("best_len"),
        F.col(id_col).cast("long").alias("best_id"), F.lit(1).cast("long").alias("size"))
    partial = records.mapInArrow(tidy(_task(memory_bytes, True)), PARTIAL)
    return partial.repartition("digest").mapInArrow(
        tidy(_task(memory_bytes, False)), PARTIAL.replace("content string, ", ""))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                memory_bytes: int = 64 << 20) -> DataFrame:
    """One row per input row: id, digest of the normalised text, keep_id, group_size, kept."""
    stage = Staging(docs.sparkSession, "exact-dedup")
    groups = stage.put(duplicate_groups(docs, id_col, text_col, memory_bytes), "groups")
    text = F.col(text_col)
    keys = docs.select(F.col(id_col).alias("row_id"),
                       F.sha2(normalised(text), 256).alias("digest"),
                       F.length(F.coalesce(text, F.lit(""))).cast("long").alias("row_len"))
    return keys.join(groups, "digest").select(
        F.col("row_id").alias(id_col), F.col("best_id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("row_id").eqNullSafe(F.col("best_id"))
         & (F.col("row_len") == F.col("best_len"))).alias("kept"),
        F.col("digest").alias("text_sha256"))
