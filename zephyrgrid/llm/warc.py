"""A deterministic sharded WARC writer and its reader.

Records are ordered by page id.  The id range is cut into ``BINS`` equal steps,
bytes per step are summed and runs of steps become shards of about equal size; a
step too heavy for one shard is dealt by hash over several.  The table of steps
is bounded, so it is broadcast.  All of this depends on the data alone, so every
run writes the same bytes to the same names, whatever the partitioning.

One task writes the shards it was dealt one after the other, record by record:
each record is a gzip member of its own, and a file is rolled when the next
record would take it past ``file_bytes`` compressed.  Headers are regenerated:
record ids and digests come from the content and the date is a parameter.  A file
is written under a temporary name and renamed when whole.  A retried or
speculative task renames equal bytes to the same name.  The manifest is written
last, through Spark's committer; readers open what it names and nothing else, so
a failed job leaves nothing behind that can be read.

Of equal payloads the record with the largest page id is the response, the
others revisit it.  Who revisits whom is settled on (page id, digest) pairs and
travels to the writer as rows of its own, sorted right before the page they
concern, so a payload shuffles once and a payload that a third of all pages
share is never gathered.

Defined cases: null html is an empty payload; payloads below ``revisit_bytes``
are always responses; of repeated rows of the responding page the first written
is the response and the rest revisit it; a null page id is the smallest and is
left out of the headers; control characters, blanks and percent signs of a URL
are percent-encoded and a null URL is left out; an empty table gives an empty
manifest.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage, shared_directory
from .common import salted_join

BINS = 4096
LEAST_SHARD, MOST_SHARD, SHARDS_AIM = 2 << 20, 1 << 30, 1024
FILE_BYTES = 256 << 20
REVISIT_BYTES = 0
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "file string, shard bigint, roll bigint, records bigint, bytes bigint, sha1 string"


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return pafs.FileSystem.from_uri(uri)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member; the compressor writes no time stamp."""
    lines = [*headers, ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def _identity(*parts) -> str:
    digest = hashlib.sha1("\n".join(map(str, parts)).encode()).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=digest[:16], version=5)}>"


def page_record(page_id, url, payload: bytes, copy: int, revisit: bool, refers_to, date: str = DATE) -> bytes:
    """The record of one page; ``refers_to`` is the page id of the response that a revisit repeats."""
    digest = base32_sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _identity(page_id, digest, copy)), ("WARC-Date", date)]
    if url is not None:
        headers.append(("WARC-Target-URI", quote(url, safe=SAFE)))
    headers += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if page_id is not None:
        headers.append(("X-Page-Id", str(page_id)))
    if revisit:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _identity(refers_to, digest, 0))]
        if refers_to is not None:
            headers.append(("X-Refers-To-Page-Id", str(refers_to)))
    return _record(headers, http if revisit else http + payload)


SAFE = "!\"#$&'()*+,-./:;<=>?@[\\]^_`{|}~"


class _Roller:
    """Writes the files of one shard at a time; finished files are listed in ``done``."""

    def __init__(self, root: str, file_bytes: int):
        self.fs, self.path = file_system(root)
        self.limit, self.done, self.sink = file_bytes, [], None
        self.own = f"{self.path}/_temporary/{uuid.uuid4().hex}"
        self.shard = self.roll = None

    def start(self, shard: int) -> None:
        self.close()
        self.shard, self.roll = shard, 0

    def write(self, data: bytes) -> None:
        if self.sink is not None and self.bytes + len(data) > self.limit:
            self.close()
            self.roll += 1
        if self.sink is None:
            self.name = f"part-{self.shard:06d}-{self.roll:04d}.warc.gz"
            self.fs.create_dir(self.own, recursive=True)
            self.sink = self.fs.open_output_stream(f"{self.own}/{self.name}", compression=None)
            self.records, self.bytes, self.sum = 0, 0, hashlib.sha1()
            info = _record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", _identity("info", self.name)), ("WARC-Date", DATE),
                            ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
            self._put(info)
        self._put(data)
        self.records += 1

    def _put(self, data: bytes) -> None:
        self.sink.write(data)
        self.bytes += len(data)
        self.sum.update(data)

    def close(self) -> None:
        if self.sink is None:
            return
        self.sink.close()
        self.sink = None
        self.fs.create_dir(f"{self.path}/archives", recursive=True)
        self.fs.move(f"{self.own}/{self.name}", f"{self.path}/archives/{self.name}")
        self.done.append((f"archives/{self.name}", self.shard, self.roll, self.records, self.bytes, self.sum.hexdigest()))

    def flush(self) -> pa.RecordBatch:
        rows, self.done = self.done, []
        kinds = [pa.string(), *[pa.int64()] * 4, pa.string()]
        names = ["file", "shard", "roll", "records", "bytes", "sha1"]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def _write_batches(root: str, file_bytes: int, revisit_bytes: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = _Roller(root, file_bytes)
        decided, previous, copy, shard = None, None, 0, None
        for batch in batches:
            for row in zip(*[c for c in batch.columns]):
                at, page_id, digest, refers, is_page, url, payload = (x.as_py() for x in row)
                key = page_id, digest
                if not is_page:
                    decided = key, refers
                    continue
                if at != shard:
                    roller.start(at)
                    shard, previous = at, None
                copy = copy + 1 if key == previous else 0
                if decided is not None and decided[0] == key:
                    revisit, target = True, decided[1]
                else:
                    revisit, target = copy > 0 and len(payload) >= revisit_bytes, page_id
                previous = key
                roller.write(page_record(page_id, url, payload, copy, revisit, target if revisit else None, date))
            if roller.done:
                yield roller.flush()
        roller.close()
        yield roller.flush()

    return run


def _shards(narrow: DataFrame, shard_bytes: int | None) -> tuple[DataFrame, Column]:
    """(bin, first, ways) and the expression of a row's bin."""
    facts = narrow.agg(F.min("page_id").alias("low"), F.max("page_id").alias("high"), F.sum("size").alias("bytes")).first()
    low, high = facts["low"] or 0, facts["high"] or 0
    size = shard_bytes or min(max((facts["bytes"] or 0) // SHARDS_AIM, LEAST_SHARD), MOST_SHARD)
    share = (F.col("page_id").cast("double") - F.lit(float(low))) / F.lit(float(high) - float(low) + 1.0)
    bin_of = F.coalesce(F.least(F.floor(share * BINS), F.lit(BINS - 1)), F.lit(0)).cast("int")
    held = narrow.groupBy(bin_of.alias("bin")).agg(F.sum("size").alias("bytes"))
    before = F.coalesce(F.sum("bytes").over(Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return held.select("bin", F.floor(before / size).alias("first"), F.greatest(F.lit(1), F.floor(F.col("bytes") / size)).cast("int").alias("ways")), bin_of


def write(pages: DataFrame, root: str, shard_bytes: int | None = None, file_bytes: int = FILE_BYTES,
          revisit_bytes: int = REVISIT_BYTES, date: str = DATE) -> str:
    """Write the archives and then the manifest below ``root``, a folder all executors share; returns the manifest's path."""
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("digest"))
    narrow = cut_lineage(rows.select("page_id", "digest", F.octet_length("payload").cast("bigint").alias("size")))
    same = narrow.where(F.col("size") >= revisit_bytes)
    groups = same.groupBy("digest").agg(F.max("page_id").alias("refers"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    decided = salted_join(same.select("page_id", "digest").distinct(), groups, ["digest"]).where("NOT (page_id <=> refers)")
    bins, bin_of = _shards(narrow, shard_bytes)
    both = decided.select("page_id", "digest", "refers", F.lit(False).alias("is_page"), F.lit(None).cast("string").alias("url"),
                          F.lit(None).cast("binary").alias("payload")).unionByName(
        rows.withColumns({"refers": F.lit(None).cast("bigint"), "is_page": F.lit(True)}))
    dealt = both.withColumn("bin", bin_of).join(F.broadcast(bins), "bin").select(
        (F.col("first") + F.pmod(F.xxhash64("page_id", "digest"), F.col("ways"))).alias("shard"),
        "page_id", "digest", "refers", "is_page", "url", "payload")
    ordered = dealt.repartition("shard").sortWithinPartitions("shard", "page_id", "digest", "is_page", "url")
    written = ordered.mapInArrow(_write_batches(root, file_bytes, revisit_bytes, date), MANIFEST)
    written.write.mode("errorifexists").parquet(f"{root}/manifest")
    return f"{root}/manifest"


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of a compressed archive; one record is in memory at a time."""
    rest, member, parts = b"", zlib.decompressobj(31), []
    while True:
        data = rest or stream.read(1 << 20)
        if not data:
            break
        parts.append(member.decompress(data))
        rest = member.unused_data
        if member.eof:
            head, _, body = b"".join(parts).partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            headers = dict(line.split(": ", 1) for line in lines[1:])
            yield headers, body[:int(headers["Content-Length"])]
            member, parts = zlib.decompressobj(31), []
    if parts and any(parts):
        raise ValueError("the archive ends within a record")


def _read_batches(root: str, with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = file_system(root)
        for batch in batches:
            for file in batch.column("file").to_pylist():
                found = []
                with fs.open_input_stream(f"{path}/{file}", compression=None) as stream:
                    for headers, block in records(stream):
                        if headers["WARC-Block-Digest"] != f"sha1:{base32_sha1(block)}":
                            raise ValueError(f"{file}: a block does not match its digest")
                        kind = headers["WARC-Type"]
                        if kind == "warcinfo":
                            continue
                        http, _, payload = block.partition(b"\r\n\r\n")
                        digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                        if kind == "response" and digest != base32_sha1(payload):
                            raise ValueError(f"{file}: a payload does not match its digest")
                        size = int(http.decode().rpartition("Content-Length: ")[2])
                        ids = [int(headers[k]) if k in headers else None for k in ("X-Page-Id", "X-Refers-To-Page-Id")]
                        url = headers.get("WARC-Target-URI")
                        found.append((ids[0], None if url is None else unquote(url), size, digest, kind, ids[1],
                                      payload if with_payload and kind == "response" else None))
                        if len(found) >= (256 if with_payload else 8192):
                            yield _found(found)
                            found = []
                yield _found(found)

    return run


def _found(rows) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def read(spark: SparkSession, root: str, with_payload: bool = True) -> DataFrame:
    """The records of the committed archives, checked against their digests; a revisit has no payload."""
    manifest = spark.read.parquet(f"{root}/manifest")
    files = manifest.select("file").repartition("file")
    return files.mapInArrow(_read_batches(root, with_payload), "page_id bigint, url string, payload_bytes bigint, payload_digest string, "
                            "record_type string, refers_to bigint, payload binary")


def fresh_root(spark: SparkSession) -> str:
    return f"{shared_directory(spark)}/warc-{uuid.uuid4().hex}"
