"""Deterministic sharded WARC writer and its reader.

Method. Pages are range-sorted by id into shards of about equal payload bytes; each task
writes its shards in order, one gzip member per record, and rolls to a new file once the
compressed size reaches a limit. Headers, record ids and digests are made anew from the
content. A file is written under a temporary name and renamed when closed; the manifest
table, which Spark commits as a whole, lists the files of the attempts that succeeded, and
the reader opens nothing else. Equal pages, parameters and library versions give equal
files, byte for byte, whatever the number of tasks or attempts: shard borders are exact
weighted quantiles, not samples.

Equal payloads of at least ``min_revisit`` bytes: the one with the smallest id is written
as a response, the others as revisits that refer to it.

Scale. Which pages are revisits is decided on (id, digest) rows. These decisions and the
payloads then meet in one shuffle by shard (the decision sorts right before its page), so
payloads cross the network once. A task holds one record at a time. The shard borders are
longs, one per shard.

Files are written with pyarrow's file systems, below a folder that all executors reach.

Defined results. Null html: an empty payload. Null url: no target URI; control characters
and spaces in urls are percent-encoded. Null id: sorts last, spread over the last shards by
content. Repeated rows of one id and payload: the first is the response, the others revisit
that id. Empty table: no file, an empty manifest and an empty result. Extra columns:
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.llm.selection import crossing_keys, key_bits
from clientele.llm.staging import Staging
from clientele.llm.workers import tidy

MIN_REVISIT = 100
SHARD_BYTES = 256 << 20
ROLL_BYTES = 64 << 20
GZIP_LEVEL = 6
READ_CHUNK = 1 << 20
# Names of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DEFAULT_DATE = "1970-01-01T00:00:00Z"
RECORD_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

MANIFEST = "file string, shard long, part int, records long, bytes long, sha256 string"
RECORDS = ("page_id long, url string, record_type string, payload_bytes long, "
           "payload_digest string, refers_to long, payload binary")


def open_store(path: str):
    """A pyarrow file system and the path inside it."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path)


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(RECORD_SPACE, f'{page_id}:{digest}')}>"


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None,
                 revisit: bool, date: str) -> bytes:
    digest = hashlib.sha256(payload).hexdigest()
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    head = [VERSION, f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: {record_id(page_id, digest + ('r' if revisit else ''))}",
            f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~' + chr(39))}")
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}",
                 f"WARC-Refers-To: {record_id(refers_to, digest)}"]
        if refers_to is not None:
            head.append(f"X-Refers-To-Page-ID: {refers_to}")
    head += [f"WARC-Payload-Digest: sha256:{digest}",
             f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
             "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class ArchiveFile:
    """One archive under a temporary name until it is closed and renamed."""

    def __init__(self, store, folder: str, shard: int, part: int):
        self.store, self.shard, self.part = store, shard, part
        self.name = f"pages-{shard:08d}-{part:05d}.warc.gz"
        self.path = posixpath.join(folder, self.name)
        self.temporary = posixpath.join(folder, f".{self.name}.{uuid.uuid4().hex}")
        self.out = store.open_output_stream(self.temporary, compression=None)
        self.records = self.bytes = 0
        self.digest = hashlib.sha256()

    def add(self, record: bytes) -> None:
        packer = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
        member = packer.compress(record) + packer.flush()
        self.out.write(member)
        self.digest.update(member)
        self.records += 1
        self.bytes += len(member)

    def commit(self) -> tuple:
        self.out.close()
        self.store.move(self.temporary, self.path)
        return (self.name, self.shard, self.part, self.records, self.bytes,
                self.digest.hexdigest())

    def abandon(self) -> None:
        self.out.close()
        self.store.delete_file(self.temporary)


@dataclass(frozen=True)
class Writer:
    folder: str
    roll_bytes: int
    date: str

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by (shard, place, digest, kind): a decision (kind 0) stands
        right before the pages it speaks of."""
        store, folder = open_store(self.folder)
        done, current, decision, seen = [], None, None, None
        try:
            for batch in batches:
                ids, urls, refers, digests, kinds, shards = (
                    batch.column(c).to_pylist()
                    for c in ("page_id", "url", "refers_to", "digest", "kind", "shard"))
                payloads = batch.column("payload")
                for i, kind in enumerate(kinds):
                    key = (ids[i], digests[i])
                    if kind == 0:
                        decision = (key, refers[i])
                        continue
                    if current is not None and (current.shard != shards[i]
                                                or current.bytes >= self.roll_bytes):
                        done.append(current.commit())
                        part = current.part + 1 if current.shard == shards[i] else 0
                        current = None
                    else:
                        part = 0
                    if current is None:
                        current = ArchiveFile(store, folder, shards[i], part)
                    decided = decision is not None and decision[0] == key
                    # the first page of an id that refers to itself is the response
                    revisit = decided and (decision[1] != ids[i] or seen == key)
                    seen = key
                    current.add(record_bytes(ids[i], urls[i], payloads[i].as_py(),
                                             decision[1] if revisit else None, revisit, self.date))
            if current is not None:
                done.append(current.commit())
                current = None
        finally:
            if current is not None:
                current.abandon()
        kinds_of = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string())
        names = ["file", "shard", "part", "records", "bytes", "sha256"]
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[k] for d in done], t) for k, t in enumerate(kinds_of)], names=names)


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
               payload_col: str = "html", min_revisit: int = MIN_REVISIT,
               shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES,
               date: str = DEFAULT_DATE) -> DataFrame:
    """Write all pages below ``path``; returns the committed manifest.

    There are as many shards as ``shard_bytes`` asks for, at least one per shuffle partition.
    """
    spark = pages.sparkSession
    stage = Staging(spark, "warc")
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        payload.cast("binary").alias("payload"),
        F.unhex(F.sha2(payload.cast("binary"), 256)).alias("digest"))
    # null ids sort last, spread by content
    spread = F.lit(1 << 62) + F.xxhash64("digest").bitwiseAND(F.lit((1 << 61) - 1))
    rows = rows.withColumn("place", F.coalesce("page_id", spread))

    keys = stage.put(rows.select("page_id", "place", "digest",
                                 F.octet_length("payload").cast("long").alias("n")), "keys")
    firsts = (keys.where(F.col("n") >= min_revisit).groupBy("digest")
              .agg(F.min(F.struct(F.col("page_id").isNull(), "page_id")).alias("first"),
                   F.count(F.lit(1)).alias("size"))
              .where("size > 1").select("digest", F.col("first.page_id").alias("refers_to")))
    firsts = stage.put(firsts, "firsts")
    decisions = (keys.select("page_id", "place", "digest").join(firsts, "digest")
                 .select("page_id", "place", "digest", "refers_to").distinct())

    known = keys.agg(F.sum("n").alias("n"), F.min("place").alias("lo"), F.max("place").alias("hi")).first()
    total, lowest = known.n or 0, known.lo or 0
    bits = key_bits((known.hi or 0) - lowest)
    if bits > 60:  # a difference of extreme ids could leave 64 bits: the ids as they are
        bits, lowest = 72, 0
    shards = max(-(-total // shard_bytes), int(spark.conf.get("spark.sql.shuffle.partitions")))
    goals = spark.range(1, shards).select(
        F.lit(0).alias("g"), F.col("id").cast("int").alias("target"),
        (F.col("id") * F.lit(total / shards)).alias("goal"))
    placed = keys.select(F.lit(0).alias("g"), (F.col("place") - F.lit(lowest)).alias("key"),
                         F.col("n").alias("w"))
    cuts = crossing_keys(stage, "cut", placed, goals, bits)
    borders = np.array(sorted(r.cut + lowest for r in cuts.select("cut").distinct().collect()),
                       dtype=np.int64)

    @F.pandas_udf("long")
    def shard_of(place: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(borders, place.to_numpy(), side="right"))

    empty = [F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload")]
    told = decisions.select("page_id", "place", "digest", "refers_to", *empty,
                            F.lit(0).alias("kind"))
    content = rows.select("page_id", "place", "digest", F.lit(None).cast("long").alias("refers_to"),
                          "url", "payload", F.lit(1).alias("kind"))
    dealt = (told.unionByName(content).withColumn("shard", shard_of("place"))
             .repartitionById(shards, F.col("shard").cast("int"))
             .sortWithinPartitions("shard", "place", "digest", "kind", "url"))
    store, folder = open_store(path)
    store.create_dir(f"{folder}/records", recursive=True)
    manifest = dealt.mapInArrow(tidy(Writer(f"{path}/records", roll_bytes, date)), MANIFEST)
    manifest.write.parquet(f"{path}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def members(stream) -> Iterator[bytes]:
    """The gzip members of a file, one at a time."""
    unpacker, out = None, []
    while chunk := stream.read(READ_CHUNK):
        while chunk:
            unpacker = unpacker or zlib.decompressobj(31)
            out.append(unpacker.decompress(chunk))
            chunk = unpacker.unused_data
            if unpacker.eof:
                yield b"".join(out)
                unpacker, out = None, []
    if unpacker is not None:
        raise ValueError("the archive ends inside a record")


def parse_record(data: bytes, with_payload: bool) -> tuple:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != VERSION:
        raise ValueError(f"not a record: {lines[0][:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    if hashlib.sha256(block).hexdigest() != fields["WARC-Block-Digest"].removeprefix("sha256:"):
        raise ValueError(f"block digest differs in {fields['WARC-Record-ID']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = fields["WARC-Type"]
    size = int(http.rpartition(b"Content-Length: ")[2])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "response" and (len(payload) != size
                               or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload digest differs in {fields['WARC-Record-ID']}")
    number = {k: int(fields[k]) if k in fields else None
              for k in ("X-Page-ID", "X-Refers-To-Page-ID")}
    return (number["X-Page-ID"], fields.get("WARC-Target-URI"), kind, size, digest,
            number["X-Refers-To-Page-ID"], payload if with_payload and kind == "response" else None)


@dataclass(frozen=True)
class Reader:
    folder: str
    with_payload: bool

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = open_store(self.folder)
        for batch in batches:
            for name, n in zip(batch.column("file").to_pylist(), batch.column("records").to_pylist()):
                held, size, count = [], 0, 0
                with store.open_input_stream(f"{folder}/{name}", compression=None) as stream:
                    for member in members(stream):
                        held.append(parse_record(member, self.with_payload))
                        count += 1
                        size += 200 + (len(member) if self.with_payload else 0)
                        if size > 8 << 20:
                            yield _records(held)
                            held, size = [], 0
                if count != n:
                    raise ValueError(f"{name} holds {count} records, the manifest says {n}")
                if held:
                    yield _records(held)


def _records(held: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())
    names = [c.split()[0] for c in RECORDS.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([h[k] for h in held], t) for k, t in enumerate(kinds)], names=names)


def read_warc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of all files in the manifest, digests verified."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (manifest.select("file", "records").repartition(tasks, "file")
            .mapInArrow(tidy(Reader(f"{path}/records", with_payload)), RECORDS))
